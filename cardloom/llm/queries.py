"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import (
    embedding_dedup,
    filter_audit,
    fingerprints,
    language_id,
    ngram_join,
    packing,
    quality,
    secret_scan,
    segmentation,
    sharding,
    token_counts,
    vector_codes,
    warc,
)
from cardloom.llm.shared import new_folder, staged
from cardloom.llm.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, python: bool = False):
    """Register a query; ``python`` for those whose tasks import this package."""

    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if python:
                ship(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = sharding.shard_records(docs, [1.0] * 16, [1.0] * 17)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op9_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edit_with_next(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.distinct_count(F.col("sketch")).alias("est_shingles"),
    )


@query("op10_secret_scans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The ledger as former runs have left it: half of all blobs, scanned with the rules of that time.  What it lacks, the
    # last rule for those blobs and every rule for the others, is scanned now.
    former = secret_scan.address(docs).where("blob < '8'")
    ledger = secret_scan.update_ledger(former, rules=secret_scan.RULES[:2])
    found, _ = secret_scan.scan(docs, ledger)
    listed = F.array_join(
        F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    counts = [
        F.expr(f"size(filter(spans, x -> x.kind = '{kind}'))").cast("long").alias(f"n_{kind}")
        for kind in ("assign", "access", "hex")
    ]
    rows = found.select(F.col("path").alias("doc_id"), *counts, listed.alias("spans"))
    return rows.withColumn("base_sha256", F.sha2(F.encode("spans", "UTF-8"), 256))


@query("op5_packing", python=True)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op6_warc", python=True)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    rows = warc.read_archive(spark, folder, with_payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op6_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest,
    max(page_id) OVER (PARTITION BY html) AS last
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM d
"""


def remainder(column: str, by: int):
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % by


@query("op1_language_id", python=True)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(remainder("doc_id", 4) != 2))
    rows = docs.select("doc_id", "text", (remainder("doc_id", 4) == 2).alias("held_out"))
    return language_id.identify(rows, model).drop("text")


@query("op4_quality", python=True)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(remainder("doc_id", 5) != 0))
    rows = docs.select("doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    return quality.score(rows, model).drop("text").withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op2_embedding_dedup", python=True)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings"))


@query("op3_ngram_join", python=True)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query("op7_segmentation", python=True)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    samples = segmentation.encode(table(spark, sf_dir, "documents"), model)
    back = segmentation.decode(F.col("ids"), model)
    return samples.withColumn("decoded_crc32", F.crc32(F.encode(back, "UTF-8")))


def _scan(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {order} AS k, {least} AS least, string_split_regex(t, '{quoted}') AS p,
        regexp_extract_all(t, '{quoted}', 0) AS m, regexp_extract_all(t, '{quoted}', {group}) AS g FROM d"""


ORACLES["op10_secret_scans"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(_scan(r.kind, k, r.pattern, r.group, r.least) for k, r in enumerate(secret_scan.RULES))}),
each AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM raw),
placed AS (
  SELECT doc_id, kind, k, length(m[i]) AS size,
    list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM each WHERE length(g[i]) >= least
),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + size AS BIGINT)), ',' ORDER BY start, k) AS spans
  FROM placed GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM d LEFT JOIN listed USING (doc_id)
"""

_REACH = """
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM ends UNION SELECT r.a, l.b FROM reach r JOIN ends l ON l.a = r.b),
lowest AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
linked AS (SELECT a, count(*) AS n_links FROM ends GROUP BY a)"""

ORACLES["op3_ngram_join"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
runs AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words
),
sets AS (SELECT doc_id, len(s) AS n, s FROM runs),
flat AS (SELECT doc_id, n, unnest(s) AS x FROM sets),
often AS (SELECT x FROM flat GROUP BY x HAVING count(*) > 1),
few AS (SELECT doc_id, n, x FROM flat SEMI JOIN often USING (x)),
enough AS (SELECT doc_id FROM few GROUP BY doc_id, n HAVING 100 * count(*) >= 85 * n),
kept AS (SELECT few.* FROM few SEMI JOIN enough USING (doc_id)),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM kept p JOIN kept q ON p.x = q.x AND p.doc_id < q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
),{_REACH}
SELECT s.doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id, coalesce(n_links, 0) AS n_links
FROM sets s LEFT JOIN lowest l ON l.a = s.doc_id LEFT JOIN linked k ON k.a = s.doc_id
"""

ORACLES["op2_embedding_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND len(p.e) = len(q.e) AND p.vec_id < q.vec_id
  WHERE list_cosine_similarity(p.e, q.e) >= 0.93
),{_REACH}
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN lowest l ON l.a = vec_id LEFT JOIN linked k ON k.a = vec_id
"""


@query("op11_filter_audit", python=True)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


TOKEN_LIMIT = 1024


@query("op12_token_counts", python=True)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    counted = staged(token_counts.prefix_table(docs, public_tokenizers.path("byte_bpe_50k.json")), "token-counts")
    n_tokens = token_counts.token_count("steps")
    within = token_counts.chars_within("steps", F.lit(TOKEN_LIMIT))
    rows = counted.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), within.alias("chars_within_limit"))
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op13_vector_codes", python=True)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def _orders() -> str:
    rows = []
    for order in permutations("ABCDE"):
        for i, letter in enumerate(order):
            ahead = sum(1 << "ABCDE".index(x) for x in order[:i])
            rows.append(f"('{''.join(order)}', {i + 1}, {1 << 'ABCDE'.index(letter)}, {ahead})")
    return ", ".join(rows)


ORACLES["op11_filter_audit"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS lowest FROM d
),
f AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > lowest THEN 16 ELSE 0 END AS mask
  FROM w
),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask
),
o(filter_order, step, own, ahead) AS (VALUES {_orders()})
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(sum(CASE WHEN mask & ahead = 0 AND mask & own = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & ahead = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & ahead <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & ahead = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & ahead = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(sum(CASE WHEN mask & ahead = 0 AND mask & own <> 0 THEN n ELSE 0 END)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM m CROSS JOIN o GROUP BY part, filter_order, step, own
"""


def _lloyd(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds as a chain of tables: b0, b1, ... are the codebooks and n0, n1, ... the nearest entries under them."""
    out = [
        f"""WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS (SELECT id, pos, x[pos * (len(x) // {parts}) + 1 : (pos + 1) * (len(x) // {parts})] AS part FROM v, range({parts}) r(pos)),
b0 AS (SELECT pos, id - 1 AS entry, part FROM p WHERE id <= {entries})"""
    ]
    far = "list_sum(list_transform(range(1, len(p.part) + 1), lambda i: (p.part[i] - b.part[i]) * (p.part[i] - b.part[i])))"
    for i in range(rounds + 1):
        out.append(
            f"""n{i} AS (
  SELECT id, pos, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT p.id, p.pos, b.entry, CAST({far} AS BIGINT) AS d FROM p JOIN b{i} b ON p.pos = b.pos) GROUP BY id, pos
)"""
        )
        if i < rounds:
            out.append(
                f"""s{i} AS (
  SELECT pos, entry, i, sum(x) AS total, count(*) AS n
  FROM (SELECT p.pos, best.entry AS entry, unnest(range(1, len(part) + 1)) AS i, unnest(part) AS x FROM n{i} JOIN p USING (id, pos)) GROUP BY pos, entry, i
),
m{i} AS (
  SELECT pos, entry, list(CAST((total - ((total % n + n) % n)) // n AS BIGINT) ORDER BY i) AS part FROM s{i} GROUP BY pos, entry
),
b{i + 1} AS (SELECT b.pos, b.entry, coalesce(m.part, b.part) AS part FROM b{i} b LEFT JOIN m{i} m ON m.pos = b.pos AND m.entry = b.entry)"""
            )
    return (
        ",\n".join(out)
        + f""",
c AS (
  SELECT id, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM n{rounds} GROUP BY id
),
k AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM c JOIN v USING (id) CROSS JOIN k
"""
    )


ORACLES["op13_vector_codes"] = _lloyd()
