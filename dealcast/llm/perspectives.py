"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users. The mask marks what the
speaker is trained to say: its texts and their end marks. Turns of the role
``system`` stay system turns; that role is no participant.

    <|system|>\\n...<|end|>\\n<|user name=ann|>\\n...<|end|>\\n<|assistant|>\\n...<|end|>\\n

A rendering has blocks of ``block`` turns, so a conversation of any length is
whole and no row or task holds more than a block's turns. Turns are numbered by
slices of (conversation, turn): each slice counts its own rows, and the one
conversation that it may continue gets the number of rows before it. Equal rows
are counted before, and a row that stands for many is dealt out over its blocks.

Defined results: turns are ordered by turn (null first), then role and text; a
repeated row is rendered as often as it is there; a null role is the speaker
``unknown``; null text is empty; rows without a conversation id are one
conversation, whose id is null; ``<|`` in a text or name becomes ``< |``, so
that nothing in a text passes for a mark. A conversation of system turns only
gives no rows. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from dealcast.llm import common as C

BLOCK = 256
SYSTEM, UNKNOWN = "system", "unknown"
_END = "<|end|>"


def _safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def numbered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, slices: int | None = None) -> DataFrame:
    """(key, conv_id, turn, role, text, n, pos): distinct rows, how many each
    stands for, and its first position in the conversation."""
    n = slices or C.partitions(conversations.sparkSession)
    rows = conversations.select(F.coalesce(F.col(conv_id).cast("string"), F.lit("\u0000")).alias("key"), F.col(conv_id).alias("conv_id"),
                                F.col(turn).alias("turn"), _safe(F.coalesce(F.col(role), F.lit(UNKNOWN))).alias("role"), _safe(F.col(text)).alias("text"))
    counted = rows.groupBy("key", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    cut = C.materialize(counted.repartitionByRange(n, F.col("key"), *order).withColumn("_slice", F.spark_partition_id()))
    before = Window.partitionBy("_slice", "key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_own", F.coalesce(F.sum("n").over(before), F.lit(0)))
    first = cut.groupBy("_slice").agg(F.min("key").alias("key"))  # a row a slice
    held = (cut.join(F.broadcast(first.select("key").distinct()), "key", "left_semi").groupBy("key", "_slice").agg(F.sum("n").alias("n")))
    earlier = Window.partitionBy("key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.withColumn("_before", F.sum("n").over(earlier)).where(F.col("_before").isNotNull()).select("key", "_slice", "_before")
    return (local.join(F.broadcast(carried), ["key", "_slice"], "left")  # at most two rows a slice
            .select("key", "conv_id", "turn", "role", "text", "n", (F.col("_own") + F.coalesce("_before", F.lit(0))).alias("pos")))


def perspectives(conversations: DataFrame, block: int = BLOCK, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", slices: int | None = None) -> DataFrame:
    """conv_id, perspective, block, n_turns, rendered and mask (start and end of
    each trained piece, in characters of the block's text, end excluded)."""
    turns = C.materialize(numbered_turns(conversations, conv_id, turn, role, text, slices))
    speakers = turns.where(F.col("role") != SYSTEM).select("key", F.col("role").alias("perspective")).distinct()
    last = F.col("pos") + F.col("n") - 1
    dealt = (turns.withColumn("block", F.explode(F.sequence(F.floor(F.col("pos") / block), F.floor(last / block))))
             .withColumn("at", F.greatest("pos", F.col("block") * block))
             .withColumn("many", F.least(last, F.col("block") * block + block - 1) - F.col("at") + 1))
    # at most ``block`` turns a group
    blocks = (dealt.groupBy("key", "block")
              .agg(F.min("conv_id").alias("conv_id"), F.sum("many").alias("n_turns"), F.sort_array(F.collect_list(F.struct("at", "role", "text", "many"))).alias("turns")))
    each = blocks.join(speakers, "key")
    whole = F.flatten(F.transform("turns", lambda t: F.array_repeat(t, t["many"].cast("int"))))

    def piece(t: Column) -> Column:
        own = t["role"] == F.col("perspective")
        head = (F.when(own, F.lit("<|assistant|>\n")).when(t["role"] == SYSTEM, F.lit("<|system|>\n"))
                .otherwise(F.concat(F.lit("<|user name="), t["role"], F.lit("|>\n"))))
        return F.struct(own.alias("own"), F.length(head).alias("lead"), F.concat(head, t["text"], F.lit(_END + "\n")).alias("line"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        end = acc["at"] + F.length(p["line"])
        span = F.struct((acc["at"] + p["lead"]).alias("start"), (end - 1).alias("end"))
        return F.struct(end.alias("at"), F.when(p["own"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    lines = each.withColumn("pieces", F.transform(whole, piece))
    return lines.select("conv_id", "perspective", F.col("block").cast("long").alias("block"), F.col("n_turns").cast("long").alias("n_turns"),
                        F.array_join(F.transform("pieces", lambda p: p["line"]), "").alias("rendered"),
                        F.aggregate("pieces", start, step, lambda a: a["spans"]).alias("mask"))


def digest(rendered: DataFrame) -> DataFrame:
    """The registered query's columns: the mask as text."""
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return rendered.withColumn("mask", F.array_join(spans, ","))
