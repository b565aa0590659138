"""Result tables that take each batch once (S11, ST2).

A batch of rows has a commit key (a stream's epoch, a period). Writing it has
two steps: the rows go to a folder of their own attempt, then one row for each
key, with the attempt's name, goes to the ledger as a single file. A reader
takes rows only of attempts that the ledger names for their key, the first by
name if two writers raced. So a batch that is written again after it was
committed adds nothing, a writer that fails between the two steps leaves rows
that nobody sees, and the next writer of the key writes them anew.

Rows carry their key in the column ``commit_key``; null is no key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dealcast.session import delete_path, path_exists

KEY, ATTEMPT = "commit_key", "attempt"
LEDGER_BROADCAST = 1_000_000  # committed keys that may be broadcast (60 MB)
_LEDGER = StructType([StructField(KEY, StringType()), StructField(ATTEMPT, StringType())])


class CommittedTable:
    """A table at ``path`` whose rows have the columns of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path = spark, path
        self.schema = StructType([f for f in schema.fields if f.name not in (KEY, ATTEMPT)])

    def committed(self) -> DataFrame:
        """(commit_key, attempt): one row a committed key."""
        if not path_exists(self.spark, f"{self.path}/ledger"):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(f"{self.path}/ledger").groupBy(KEY).agg(F.min(ATTEMPT).alias(ATTEMPT))

    def _known(self) -> DataFrame:
        keys = self.committed()
        return F.broadcast(keys) if keys.limit(LEDGER_BROADCAST + 1).count() <= LEDGER_BROADCAST else keys

    def commit(self, rows: DataFrame, key: Column | str) -> str | None:
        """Write the rows whose key isn't committed yet. A text is the key of
        the whole batch, which is committed even if it has no rows; a column
        gives each row its own. Returns the attempt, or None if there was
        nothing to write."""
        if isinstance(key, str):
            if self.committed().where(F.col(KEY) == key).limit(1).count():
                return None
            new, keys = rows.withColumn(KEY, F.lit(key)), None
        else:
            keyed = rows.withColumn(KEY, key.cast("string"))
            new = keyed.where(F.col(KEY).isNotNull()).join(self._known().select(KEY), KEY, "left_anti")
        attempt = uuid.uuid4().hex
        folder = f"{self.path}/rows/{ATTEMPT}={attempt}"
        new.select(*self.schema.names, KEY).write.parquet(folder)
        if isinstance(key, str):
            keys = self.spark.createDataFrame([(key,)], f"{KEY} string")
        else:
            keys = self.spark.read.schema(f"{KEY} string").parquet(folder).distinct()
            if keys.isEmpty():
                return None
        self._enter(keys.withColumn(ATTEMPT, F.lit(attempt)))
        return attempt

    def _enter(self, keys: DataFrame) -> None:
        """One file, so that the keys of an attempt become visible together."""
        keys.select(KEY, ATTEMPT).coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")

    def read(self) -> DataFrame:
        """Committed rows, with their key. Folders of attempts that no key names
        are pruned at run time (``attempt`` is a partition column)."""
        whole = StructType([*self.schema.fields, *_LEDGER.fields])
        if not path_exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], whole).drop(ATTEMPT)
        rows = self.spark.read.schema(whole).parquet(f"{self.path}/rows")
        return rows.join(self._known(), [KEY, ATTEMPT]).select(*self.schema.names, KEY)

    def drop_attempts(self) -> int:
        """Delete the folders of attempts without a committed key; only while
        nobody writes. Returns how many."""
        if not path_exists(self.spark, f"{self.path}/rows"):
            return 0
        written = self.spark.read.schema(_LEDGER).parquet(f"{self.path}/rows").select(ATTEMPT).distinct()
        gone = [r.attempt for r in written.join(self.committed(), ATTEMPT, "left_anti").collect()]  # a name an attempt
        for attempt in gone:
            delete_path(self.spark, f"{self.path}/rows/{ATTEMPT}={attempt}")
        return len(gone)
