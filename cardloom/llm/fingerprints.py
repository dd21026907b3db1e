"""Bottom-k sketches of word shingle hashes.

A sketch is the ascending array of the ``k`` smallest distinct hashes of a text's shingles of
five words.  Sketches of parts merge into that of the whole set; two of them estimate
resemblance and containment, one the number of distinct shingles.  Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.shared import key_cells, same_text, small_table

K = 128
WORDS = 5
ROWS_PER_BUCKET = 4_000


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def word_hashes(text: Column) -> Column:
    """Hashes of the words in lower case; words are runs of other than blanks and control white space."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Distinct hashes of the runs of ``words`` words, sorted.

    A text with fewer words has one shingle of all its words; without words there is none.
    """

    def runs(h: Column) -> Column:
        last = F.size(h) - words
        run = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
        short = F.array(F.xxhash64(F.array_join(F.transform(h, lambda x: x.cast("string")), " ")))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(last < 0, short).otherwise(run)

    return F.sort_array(F.array_distinct(let(word_hashes(text), runs)))


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The bottom-k sketch of a text; NULL and texts without words give an empty sketch."""
    return F.slice(shingle_hashes(same_text(text), words), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(df: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """Sketches of parts merged by ``keys``.

    Every distinct hash counts once per key; first the smallest within slices of the hash
    range are kept, so no key brings all its parts to one task.
    """
    rows = df.select(*keys, F.explode_outer(column).alias("_h")).distinct()
    piece = Window.partitionBy(*keys, F.pmod(F.col("_h"), F.lit(64))).orderBy("_h")
    low = rows.withColumn("_n", F.row_number().over(piece)).where(F.col("_n") <= k)
    return low.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list("_h")), 1, k).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's sketch that both hold.

    Two empty sets are alike (1), an empty and another are not (0).
    """

    def share(u: Column) -> Column:
        both = F.size(F.array_intersect(u, F.array_intersect(a, b)))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u))

    return let(merge(a, b, k), share)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the k-th smallest hash."""
    last = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / last)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds too, 1 for an empty ``a``."""
    union = distinct_count(merge(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def as_text(a: Column) -> Column:
    """A sketch as one string of 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def in_order(docs: DataFrame, key: str, per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows with ``_bucket``, ranges of ``key`` of about ``per_bucket`` rows, each with a copy of the row after it.

    ``_copy`` marks the copies: the first row of a bucket stands at the end of the bucket
    before, the very first at the end of the last, so each row finds its successor
    within its bucket.  NULL keys come first.
    """
    cells = key_cells(docs, key, F.lit(1), per_bucket)
    count = len({c.bucket for c in cells.rows})
    table, seen = [], set()
    for c in cells.rows:
        first = c.bucket not in seen
        seen.add(c.bucket)
        table.append((c.cell, c.bucket, (c.bucket - 1) % count if first else None, c.first))
    bounds = small_table(docs.sparkSession, table, "_cell long, _bucket int, _before int, _first long")
    rows = docs.select(*docs.columns, F.col(key).alias("_k"), cells.column(F.col(key)).alias("_cell"))
    rows = rows.join(F.broadcast(bounds), "_cell")
    is_first = F.col("_before").isNotNull() & F.col("_k").eqNullSafe(F.col("_first"))
    own = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("c"))
    also = F.struct(F.col("_before").alias("b"), F.lit(True).alias("c"))
    rows = rows.withColumn("_to", F.explode(F.when(is_first, F.array(own, also)).otherwise(F.array(own))))
    return rows.select(*docs.columns, F.col("_to.b").alias("_bucket"), F.col("_to.c").alias("_copy"))


def edit_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Each document with its sketch, its edited text and that text's sketch, and the next document's sketch.

    The edited text has the last half of the code points replaced by the first of the next
    document in ascending ``key`` (ties: by text; after the last, the first).  NULL text is
    empty; a single document is its own successor.  Columns: key, text, edited, sketch,
    edited_sketch, next_sketch.
    """
    rows = docs.select(F.col(key).alias("_key"), same_text(text).alias("_text"))
    rows = in_order(rows, "_key")
    # A copy comes last in its bucket, and one row of several equal keys is copied first.
    order = Window.partitionBy("_bucket").orderBy("_copy", "_key", "_text")
    rows = rows.withColumn("_next", F.lead("_text").over(order))
    rows = rows.withColumn("_sketch", sketch(F.col("_text"), k))
    rows = rows.withColumn("_next_sketch", F.lead("_sketch").over(order)).where("not _copy")
    size = F.char_length("_text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), size - half), F.substring("_next", F.lit(1), half))
    rows = rows.withColumn("_edited", edited)
    return rows.select(
        F.col("_key").alias(key),
        F.col("_text").alias("text"),
        F.col("_edited").alias("edited"),
        F.col("_sketch").alias("sketch"),
        sketch(F.col("_edited"), k).alias("edited_sketch"),
        F.col("_next_sketch").alias("next_sketch"),
    )


