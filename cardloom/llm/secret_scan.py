"""Secret scans over an incremental ledger of text blobs.

A text is addressed by its SHA-256.  The ledger has one row per blob and rule version with
what was found there; only pairs that it lacks are scanned, and findings are joined
back to every path that holds the blob.  Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.shared import free_name, same_text, staged


@dataclass(frozen=True)
class Rule:
    """One kind of secret: a Java pattern, and the least length of one of its groups (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: str = "1"

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: The kinds in the order in which equal starts are listed.
RULES = (
    Rule("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # A run of 20 or 24 is looked for at once: the same as long runs among all runs.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)


def find(text: Column, rule: Rule) -> Column:
    """Leftmost matches that do not overlap as array<struct<start, end>> in code points.

    The texts between the matches and the matches themselves give the positions.
    """
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        between.alias("gap"), F.transform(whole, F.char_length).alias("size"), F.transform(kept, F.char_length).alias("held")
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["size"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        hit = F.when(x["held"] >= rule.least, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), hit.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    walked = F.aggregate(parts, first, step, lambda acc: acc["spans"])
    return F.when(text.rlike(rule.pattern), walked).otherwise(none)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Blobs (blob, text, rules: ids to apply) to (blob, rule, spans), a row per blob and rule."""
    found = [
        F.struct(
            F.lit(r.id).alias("rule"),
            F.when(F.array_contains("rules", r.id), find(F.col("text"), r)).alias("spans"),
        )
        for r in rules
    ]
    rows = blobs.select("blob", F.explode(F.array(*found)).alias("f"))
    return rows.where("f.spans is not null").select("blob", "f.rule", "f.spans")


def address(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, text, blob): every version with its content address; a NULL text counts as empty."""
    body = same_text(text)
    return docs.select(F.col(path).alias("path"), body.alias("text"), F.sha2(F.encode(body, "UTF-8"), 256).alias("blob"))


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rule, spans) for the pairs that ``ledger`` lacks, written to the shared folder.

    Copies are brought together with one text each before the shuffle, so a blob on a third of
    all paths is scanned once.  The rules missing for a blob are found first; blobs lacking
    none are not scanned.  Empty text is a blob like any other.
    """
    wanted = F.array(*[F.lit(r.id) for r in rules])
    if ledger is None:
        fresh = versions.select("blob", "text", wanted.alias("rules"))
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
        lacking = F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>")))
        fresh = versions.join(seen, "blob", "left").select("blob", "text", lacking.alias("rules"))
        fresh = fresh.where(F.size("rules") > 0)
    blobs = fresh.groupBy("blob").agg(F.any_value("text").alias("text"), F.any_value("rules").alias("rules"))
    return staged(scan_blobs(blobs, rules), "secret-ledger")


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): all spans of a blob as array<struct<start, kind order, end, kind>>, sorted, on shared storage.

    Spans of rules outside ``rules`` are ignored.
    """
    order = F.when(F.col("rule") == rules[0].id, F.lit(0))
    for i, rule in enumerate(rules[1:], 1):
        order = order.when(F.col("rule") == rule.id, F.lit(i))
    kind = F.substring_index("rule", "@", 1)
    rows = ledger.select("blob", "spans", order.alias("_order"), kind.alias("_kind")).where("_order is not null")
    spans = F.expr("transform(spans, x -> struct(x.start as start, _order as n, x.end as end, _kind as kind))")
    held = rows.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list(spans))).alias("spans"))
    return staged(held, "secret-findings")


def findings_by_path(versions: DataFrame, found: DataFrame) -> DataFrame:
    """(path, spans) for every version; a path without findings has an empty array.

    A repeated path gives a row for each of its versions.
    """
    return versions.select("path", "blob").join(found, "blob").select("path", "spans")


def scan(docs: DataFrame, ledger: DataFrame | None = None, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings by path, and the whole ledger after this run."""
    versions = address(docs, path, text)
    added = update_ledger(versions, ledger, rules)
    whole = added if ledger is None else ledger.select("blob", "rule", "spans").unionByName(added)
    return findings_by_path(versions, findings(whole, rules)), whole


def mask(docs: DataFrame, found: DataFrame, text: str = "text", sign: str = "*") -> DataFrame:
    """Documents with every code point of a span replaced by ``sign``; columns, rows and lengths stay.

    ``found`` has (blob, spans) with the spans sorted; overlapping ones are masked once.  NULL texts stay NULL.
    """
    blob, spans = free_name(docs, "_blob"), free_name(docs, "_spans")
    hits = found.where(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    rows = docs.withColumn(blob, F.sha2(F.encode(same_text(text), "UTF-8"), 256)).join(hits, blob, "left")

    def step(acc: Column, x: Column) -> Column:
        start = F.greatest(acc["at"], x["start"])
        end = F.greatest(start, x["end"])
        kept = F.substring(F.col(text), acc["at"] + 1, start - acc["at"])
        return F.struct(end.alias("at"), F.concat(acc["out"], kept, F.repeat(F.lit(sign), end - start)).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.char_length(text)))
    masked = F.when(F.col(spans).isNull(), F.col(text)).otherwise(F.aggregate(F.col(spans), first, step, rest)).alias(text)
    return rows.select(*[masked if c == text else F.col(c) for c in docs.columns])
