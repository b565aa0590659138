"""Fitted encoders and scalers as artefacts.

Training fits the codes of label columns and the mean and deviation of numeric
ones, and saves both as tables of one version; scoring another period loads them
and only transforms: nothing is fitted again, and the new data's own values have
no say.

A label that training has not seen gets the code of the first class, 0. Null is
a class of its own, the last one, if training saw it; else it is unseen too. A
number that is null stays null; a column that was constant is divided by 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealcast.operators.encode import stacked_codes, stacked_ranks
from dealcast.session import materialize, path_exists

CODES_BROADCAST = 1_000_000  # codes of a column that may be broadcast (40 MB)


class Encoders:
    """Fitted state: ``codes`` (column, value, code) and ``scales`` (column,
    mean, deviation), both written tables."""

    def __init__(self, codes: DataFrame, scales: DataFrame):
        self.codes, self.scales = codes, scales

    @classmethod
    def fit(cls, df: DataFrame, labels: Sequence[str], numbers: Sequence[str], growing: Sequence[str] = ()) -> "Encoders":
        """``growing`` names the labels whose values grow with the data; they are
        ranked in a distributed way."""
        spark, codes = df.sparkSession, None
        text = df.select(*[F.col(c).cast("string").alias(c) for c in labels])
        for group, rank in (([c for c in labels if c not in growing], stacked_codes), ([c for c in labels if c in growing], stacked_ranks)):
            if group:
                own = rank(text, group)
                if rank is stacked_ranks:  # it has a null class for every column: keep those that occur
                    seen = text.agg(*[F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).alias(c) for c in group]).first()
                    own = own.where(F.col("_value").isNotNull() | F.col("_column").isin(*[c for c in group if seen[c]], ""))
                own = own.select(F.col("_column").alias("column"), F.col("_value").alias("value"), F.col("_code").alias("code"))
                codes = own if codes is None else codes.unionByName(own)
        if codes is None:
            codes = spark.createDataFrame([], "column string, value string, code int")
        pairs = ", ".join(f"'{c}', avg(CAST(`{c}` AS DOUBLE)), stddev_pop(CAST(`{c}` AS DOUBLE))" for c in numbers)
        scales = spark.createDataFrame([], "column string, mean double, deviation double")
        if numbers:
            one = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(numbers)],
                         *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(numbers)])
            pairs = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(numbers))
            scales = one.select(F.expr(f"stack({len(numbers)}, {pairs}) AS (column, mean, deviation)"))
        return cls(materialize(codes), materialize(scales))

    def save(self, path: str, version: str) -> None:
        """Write one version; saving it again replaces it whole."""
        for name, table in (("codes", self.codes), ("scales", self.scales)):
            table.write.mode("overwrite").parquet(f"{path}/{name}/version={version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: str) -> "Encoders":
        folders = [f"{path}/{name}/version={version}" for name in ("codes", "scales")]
        if not all(path_exists(spark, f) for f in folders):
            raise ValueError(f"no version {version} in {path}")
        return cls(spark.read.schema("column string, value string, code int").parquet(folders[0]),
                   spark.read.schema("column string, mean double, deviation double").parquet(folders[1]))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<label>_encoded`` and ``<number>_scaled`` of every fitted
        column. Each label is one join with its codes, which are broadcast if
        they are few (counted); the scales are a row a column, so literals."""
        out = df
        sizes = {r["column"]: r["n"] for r in self.codes.groupBy("column").agg(F.count("*").alias("n")).collect()}  # a row a column
        for c in sorted(sizes):
            own = self.codes.where(F.col("column") == c).select(F.col("value").alias("_class"), F.col("code").alias("_code"))
            own = F.broadcast(own) if sizes[c] <= CODES_BROADCAST else own
            out = out.join(own, F.col(c).cast("string").eqNullSafe(F.col("_class")), "left").withColumn(
                f"{c}_encoded", F.coalesce("_code", F.lit(0))).drop("_class", "_code")
        scales = {r["column"]: r for r in self.scales.collect()}  # a row a column
        return out.withColumns({f"{c}_scaled": (F.col(c) - F.lit(r.mean)) / F.lit(r.deviation or 1.0) for c, r in sorted(scales.items())})
