"""All outputs of a run made visible at once.

A run writes its tables to folders of its own and then one manifest that names them.  Readers ask the last complete
manifest, so a run that stops between two outputs leaves the former set visible.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cardloom.sources.tables import folders

SCHEMA = "name string, path string"


def versions(spark: SparkSession, root: str) -> dict[str, str]:
    """Complete versions in order, with the folder of their manifest; a version published again counts by its last."""
    found: dict[str, str] = {}
    for path in sorted(m.rsplit("/", 1)[0] for m in folders(spark, f"{root}/version=*/_SUCCESS")):
        name = re.sub(r"^version=\d+-", "", path.rsplit("/", 1)[1])
        found.pop(name, None)
        found[name] = path
    return found


def refuse_published(spark: SparkSession, root: str, version: str) -> None:
    """Stop a run that has been published already."""
    if version in versions(spark, root):
        raise ValueError(f"version {version} of {root} is there already")


def publish(spark: SparkSession, root: str, version: str, outputs: Mapping[str, str | Sequence[str]], again: bool = False) -> str:
    """Write the manifest of ``version``: the path or paths of every named output.

    A published version is final, unless ``again`` says that a repeated run may publish it anew.
    """
    if not again:
        refuse_published(spark, root, version)
    count = len(folders(spark, f"{root}/version=*"))
    rows = [(name, p) for name, paths in outputs.items() for p in ([paths] if isinstance(paths, str) else paths)]
    path = f"{root}/version={count + 1:08d}-{version}"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def published(spark: SparkSession, root: str, version: str | None = None) -> dict[str, list[str]]:
    """Paths by output of a version, by default the last; empty if nothing has been published."""
    known = versions(spark, root)
    if not known:
        return {}
    out: dict[str, list[str]] = {}
    path = known[version] if version is not None else list(known.values())[-1]
    for r in spark.read.schema(SCHEMA).parquet(path).collect():
        out.setdefault(r["name"], []).append(r["path"])
    return {name: sorted(paths) for name, paths in out.items()}


def read_published(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """One output of a published version."""
    return spark.read.parquet(*published(spark, root, version)[name])
