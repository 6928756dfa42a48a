"""Sharding by weighted rendezvous hashing, and gapless slots within each shard.

Every shard draws a number from the record's key and its own number; the record goes
to the shard with the smallest ``-ln(draw) / weight``.  Adding a shard can only make
the new shard win, so no record moves between old shards.  Nothing but built-in
functions is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of md5 taken as a draw: a double holds them exactly.
DRAW_BITS = 52
#: Ranges of the slot order's hash per shard; their counts (shards x this) are broadcast.
SLOT_RANGES = 4096


def draw(text: Column) -> Column:
    """A number of DRAW_BITS bits from md5, the same on every platform."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard 0 .. len(weights)-1 of a key; a null key counts as the empty text.

    Shards of weight 0 get nothing.  Equal scores (never seen in practice) go to the
    smaller shard.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be non-negative, one at least positive")
    text = F.coalesce(key.cast("string"), F.lit(""))
    shards = F.array(
        *[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights) if w > 0]
    )
    scored = F.transform(
        shards,
        lambda s: F.struct(
            (-F.log((draw(F.concat_ws(":", text, s["shard"])) + F.lit(0.5)) / F.lit(2.0**DRAW_BITS)) / s["weight"]).alias(
                "score"
            ),
            s["shard"].alias("shard"),
        ),
    )
    return F.array_min(scored)["shard"]


def with_slots(df: DataFrame, shard: str, order: Column, ties: Sequence[str], slot: str = "slot") -> DataFrame:
    """Adds a gapless number from 0 within each shard, in the order of a hash of ``order``.

    No shard is ever in one task: rows are numbered within ranges of the hash, and each
    range starts after the rows of the ranges before it (their counts are shards x
    SLOT_RANGES rows whatever the input's size, hence the broadcast).  Rows that agree in
    ``order`` are numbered by ``ties``; rows that agree there too are interchangeable.
    """
    names = {n: n + "__rendezvous" for n in ("hash", "range", "count", "before")}
    spot = draw(F.concat(F.lit("slot:"), F.coalesce(order.cast("string"), F.lit(""))))
    ranged = df.withColumn(names["hash"], spot).withColumn(
        names["range"], F.shiftright(F.col(names["hash"]), DRAW_BITS - SLOT_RANGES.bit_length() + 1)
    )
    from pyspark.sql import Window

    counts = ranged.groupBy(shard, names["range"]).agg(F.count("*").alias(names["count"]))
    earlier = Window.partitionBy(shard).orderBy(names["range"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(shard).alias("s__rendezvous"),
        F.col(names["range"]).alias("r__rendezvous"),
        F.coalesce(F.sum(names["count"]).over(earlier), F.lit(0)).alias(names["before"]),
    )
    within = Window.partitionBy(shard, names["range"]).orderBy(names["hash"], *ties)
    return (
        ranged.join(
            F.broadcast(starts),
            (F.col(shard) == F.col("s__rendezvous")) & (F.col(names["range"]) == F.col("r__rendezvous")),
        )
        .withColumn(slot, F.col(names["before"]) + F.row_number().over(within) - 1)
        .drop("s__rendezvous", "r__rendezvous", *names.values())
    )


def shards(docs: DataFrame, n_shards: int = 8, weights: Sequence[float] | None = None) -> DataFrame:
    """One row per document with its shard, its slot there and the shard one more shard gives it.

    ``size``: UTF-8 bytes of the text plus 1.  ``grown_shard``: the shard with one more
    shard of weight 1.  Null texts count as empty, null ids as the empty key; repeated rows get
    slots of their own in the same shard; an empty table gives no rows.  Other columns are
    not looked at.
    """
    weights = list(weights or [1.0] * n_shards)
    if len(weights) != n_shards:
        raise ValueError("one weight per shard")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), weights).alias("shard"),
        shard_of(F.col("doc_id"), [*weights, 1.0]).alias("grown_shard"),
    )
    return with_slots(rows, "shard", F.col("doc_id"), ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
