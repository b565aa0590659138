"""dealcast: opportunity analytics as lazy Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and adds
no action of its own, unless its docstring says so (model fitting, writes).
"""

__version__ = "0.1.0"
