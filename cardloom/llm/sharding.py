"""Rendezvous hashing of stable record keys over weighted shards.

Every shard draws a score from the key and its own number and the best score wins, so
the shard depends on the key and the shards alone, and a new shard takes rows only
into itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.shared import gapless, pieces_for, same_text


def score(key: Column, shard: int, weight: float) -> Column:
    """``-ln(u) / weight`` of a uniform draw from key and shard: the lowest score wins."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; shards of weight 0 get nothing.

    Equal keys share a shard; all NULL keys share one too.  Raises without a positive weight.
    """
    drawn = [F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    if not drawn:
        raise ValueError("a shard needs a positive weight")
    best = drawn[0] if len(drawn) == 1 else F.least(*drawn)
    return best["shard"]


def shard_records(
    docs: DataFrame,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per record: key, size, text_crc32, shard, slot and grown_shard (NULL without ``grown``).

    Size is the UTF-8 bytes of the text (NULL: none) plus 1.  Slots of a shard count from 0
    in an order that is stable for the same rows.  Repeated rows each get a slot; an empty
    table gives no rows; other columns of ``docs`` do not matter.
    """
    data = F.encode(same_text(text), "UTF-8")
    target = F.lit(None).cast("int") if grown is None else rendezvous(F.col(key), grown)
    rows = docs.select(
        F.col(key),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        target.alias("grown_shard"),
    )
    return gapless(rows, ["shard"], [key, "text_crc32", "size"], "slot", pieces_for(docs.select(key).count()))
