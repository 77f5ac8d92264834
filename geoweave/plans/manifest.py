"""Manifests: what a result was made from, so that it is reused only for the same inputs and settings.

A result stands in a folder named by the hash of its settings; the manifest beside it, a one-row JSON
table that is written last, names the folder. A run that ends early leaves the manifest as it
was, with the folder that it names untouched.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def canonical(value: dict) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=str)


def payload_hash(value: dict) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    try:
        row = spark.read.text(f"{path}/manifest").first()
        return json.loads(row.value) if row else None
    except (AnalysisException, ValueError):
        return None


def write_manifest(spark: SparkSession, path: str, value: dict) -> None:
    spark.createDataFrame([(canonical(value),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def produce(spark: SparkSession, path: str, settings: dict, build: Callable[[], DataFrame], *, conflict: str = "raise", partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, bool]:
    """The result at the path, and whether it was there already for the same settings.

    conflict: what happens to a result of other settings: `raise` keeps it and raises ValueError,
    `rebuild` replaces it.
    """
    if conflict not in ("raise", "rebuild"):
        raise ValueError("conflict must be raise or rebuild")
    known = read_manifest(spark, path)
    wanted = payload_hash(settings)
    if known is not None and known.get("settings_hash") == wanted:
        return spark.read.parquet(f"{path}/{known['folder']}"), True
    if known is not None and conflict == "raise":
        raise ValueError(f"{path} was made with other inputs or settings")
    folder = f"data-{wanted[:16]}"
    build().write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{folder}")
    made = spark.read.parquet(f"{path}/{folder}")
    write_manifest(spark, path, {"settings": settings, "settings_hash": wanted, "folder": folder, "rows": made.count()})
    return made, False


def produce_parts(spark: SparkSession, path: str, settings: dict, parts: Mapping[str, Callable[[], DataFrame]], *, conflict: str = "raise", log: Callable[[dict], None] | None = None) -> DataFrame:
    """A result made part by part: parts that are complete for the same settings are not made again.

    log: called with an event for each part that begins, ends, is skipped or fails; a failure is raised again.
    """
    tell = log or (lambda event: None)
    made = []
    for name, build in parts.items():
        tell({"event": "begin", "part": name})
        try:
            rows, reused = produce(spark, f"{path}/part={name}", settings | {"part": name}, build, conflict=conflict)
        except BaseException as e:
            tell({"event": "failed", "part": name, "error": str(e)})
            raise
        tell({"event": "skipped" if reused else "complete", "part": name})
        made.append(rows)
    if not made:
        raise ValueError("no parts")
    return reduce(DataFrame.unionByName, made)
