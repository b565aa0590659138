"""Delimited text files as they come: each in its own encoding, bad lines kept
apart (S1, S4, C5, V4).

The lines are read once as bytes, in splits of any size. A file whose lines are
all valid UTF-8 is UTF-8; of the others, one with a byte of 0x80 to 0x9F that
windows-1252 assigns, and none that it doesn't, is windows-1252, and the rest is
ISO-8859-1. Every line is decoded by its file's encoding and parsed by the
declared schema. A line with too few or too many fields, or with a field that
its column's type can't hold, goes to the reject table with its file and the
reason; nothing becomes null silently.

A record is one line: line ends within quotes are not supported. An empty line
is skipped, and so are lines that equal the header.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Bytes 0x80 to 0x9F of windows-1252 (without the five that it leaves open).
CP1252_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_OPEN = "\x81\x8d\x8f\x90\x9d"
FILES_BROADCAST = 200_000  # files whose encodings may be broadcast (40 MB)


def raw_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, line): lines as they are stored; the text source doesn't decode."""
    return spark.read.text(path if isinstance(path, str) else list(path)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def _latin(line: Column) -> Column:
    return F.decode(line.cast("binary"), "ISO-8859-1")


def file_encodings(lines: DataFrame) -> DataFrame:
    """(file, encoding): one row a file, from partial counts of its splits."""
    text = _latin(F.col("line"))
    seen = lines.groupBy("file").agg(
        F.min(F.is_valid_utf8("line")).alias("utf8"),
        F.max(text.rlike(f"[{CP1252_BYTES}]")).alias("extra"),
        F.max(text.rlike(f"[{CP1252_OPEN}]")).alias("open"))
    return seen.select("file", F.when(F.col("utf8"), "utf-8").when(F.col("extra") & ~F.col("open"), "windows-1252").otherwise("iso-8859-1").alias("encoding"))


def decoded_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, encoding, line): every line by its file's encoding, without a
    UTF-8 mark at its beginning."""
    from dealcast.session import materialize
    lines = raw_lines(spark, path)
    known = materialize(file_encodings(lines))
    if known.limit(FILES_BROADCAST + 1).count() <= FILES_BROADCAST:
        known = F.broadcast(known)
    text = _latin(F.col("line"))
    line = (F.when(F.col("encoding") == "utf-8", F.regexp_replace(F.col("line"), "^﻿", ""))
            .when(F.col("encoding") == "windows-1252", F.translate(text, CP1252_BYTES, CP1252_CHARS)).otherwise(text))
    return lines.join(known, "file").select("file", "encoding", line.alias("line"))


def parsed(lines: DataFrame, schema: StructType, sep: str = ",") -> DataFrame:
    """``lines`` with ``row`` (by the schema, null for a rejected line) and
    ``reason`` (null for a good one): the number of fields, or the first column
    that can't hold its field."""
    corrupt = "_corrupt"
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "timestampFormat": "yyyy-MM-dd HH:mm:ss", "dateFormat": "yyyy-MM-dd"}
    typed = StructType([*[StructField(f.name, f.dataType) for f in schema.fields], StructField(corrupt, StringType())])
    texts = StructType([*[StructField(f.name, StringType()) for f in schema.fields], StructField(corrupt, StringType())])
    got = lines.withColumns({"_typed": F.from_csv("line", typed.simpleString()[7:-1].replace(":", " "), options),
                             "_texts": F.from_csv("line", texts.simpleString()[7:-1].replace(":", " "), options)})
    wrong = F.lit(None).cast("string")
    for f in reversed(schema.fields):
        own = F.col("_texts")[f.name]
        wrong = F.when(own.isNotNull() & F.col("_typed")[f.name].isNull(), F.concat(F.lit(f"{f.name}: no {f.dataType.simpleString()}"))).otherwise(wrong)
    reason = F.when(F.col("_texts")[corrupt].isNotNull(), F.lit("wrong number of fields")).otherwise(wrong)
    row = F.struct(*[F.col("_typed")[f.name].alias(f.name) for f in schema.fields])
    return got.withColumn("reason", reason).withColumn("row", F.when(F.col("reason").isNull(), row)).drop("_typed", "_texts")


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType, sep: str = ",", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows with the schema's columns, rejects with file, line and reason).
    Both come from one written table, so the files are parsed once."""
    from dealcast.session import materialize
    lines = decoded_lines(spark, path).where(F.length(F.trim("line")) > 0)
    if header:
        lines = lines.where(F.lower(F.col("line")) != sep.join(schema.names).lower())
    both = materialize(parsed(lines, schema, sep))
    return both.where(F.col("reason").isNull()).select("row.*"), both.where(F.col("reason").isNotNull()).select("file", "line", "reason")
