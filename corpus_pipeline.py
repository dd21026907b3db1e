"""From raw documents to packed token sequences: five stages, each on all that the one before kept.

1. quality: documents with a score below 0.3 go.
2. language: documents without a letter, or whose letters are on average of no language with a certainty of 0.5, go; a
   missing ``lang`` is filled in.
   Where no language can be learned, documents without a letter go.
3. near copies: of each group of documents linked by a Jaccard likeness of 0.8 of their five-word shingles
   the one with the smallest id stays.
4. secrets: what the rules find is masked; no document goes.
5. packing: documents become pieces of token sequences.

All stages but the last return the columns of ``documents``.  Repeated rows are judged alike, and the third stage
keeps one of them; rows without an id are in no group and stay there.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import language_id, ngram_join, packing, quality, secret_scan
from cardloom.llm.queries import remainder, table
from cardloom.llm.shared import free_name, same_text, staged
from cardloom.llm.shipping import ship

LEAST_QUALITY = 0.3
LEAST_CERTAINTY = 0.5
LIKENESS = Fraction(4, 5)
WORDS = 5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least ``LEAST_QUALITY``, learned from the labels outside the held-out fifth."""
    ship(spark)
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = quality.train(docs, labels)
    score = free_name(docs, "_score")
    return quality.score(docs, model, out=score).where(F.col(score) >= LEAST_QUALITY).select(docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose letters are told to be of known languages with a certainty of at least ``LEAST_CERTAINTY``.

    The certainty is the mean, over the letters, of the best language's probability there, so a text in several
    languages is kept.  Where no row to learn from has a language, none can be told: all documents with a letter stay as they are.
    """
    ship(spark)
    model = language_id.train(docs.where(remainder("doc_id", 4) != 2))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score, certain = free_name(docs, "_lang"), free_name(docs, "_score"), free_name(docs, "_certain")
    rows = language_id.identify(docs, model, lang_out=lang, score_out=score, certainty_out=certain)
    rows = rows.where((F.col(lang) != language_id.UNKNOWN) & (F.col(certain) >= LEAST_CERTAINTY))
    filled = F.coalesce("lang", lang).alias("lang")
    return rows.select(*[filled if c == "lang" else F.col(c) for c in docs.columns])


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    ship(spark)
    groups = ngram_join.join(docs, LIKENESS, WORDS)
    kept = groups.where("component_id = doc_id").select("doc_id").distinct()
    rows = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").select(docs.columns)
    mark = free_name(docs, "_same")
    rows = rows.withColumn(mark, F.sha2(F.encode(same_text("text"), "UTF-8"), 256))
    rows = rows.dropDuplicates(["doc_id", mark]).drop(mark)
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked, by the ledger of their texts."""
    ledger = secret_scan.update_ledger(secret_scan.address(docs))
    return secret_scan.mask(docs, secret_scan.findings(ledger))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("n-gram Jaccard join", keep_one_of_group),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: Learned stages cannot be expressed in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; every result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
