"""What a session needs before Python functions of this package run on its executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, unless they find it by PYTHONPATH or the working folder. Once an application."""
    known = {os.path.realpath(p or ".") for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."]}
    application = spark.sparkContext.applicationId
    if str(ROOT) in known or application in _shipped:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='geoweave-')}/geoweave", "zip", ROOT, "geoweave")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


#: Rows that go to Python at a time, at most.
BATCH_ROWS = 1000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


#: Rows after which Parquet's writers look at the size of their pages, at most.
PAGE_ROWS = 100
_PAGES = "parquet.page.size.row.check.max"


def small_batches(spark: SparkSession) -> None:
    """Texts are long, and workers keep the memory of their largest batch: its rows, not those of a partition, bound it.

    Parquet's writers guess from short rows after how many (10,000) a page is full; where long ones follow, such as the mentions of a
    sentence of 50,000 characters, a page takes hundreds of megabytes, and as many again to be compressed. They are to look at it often.
    """
    if not 0 < int(spark.conf.get(_BATCHES)) <= BATCH_ROWS:
        spark.conf.set(_BATCHES, str(BATCH_ROWS))
    if not spark.conf.get(_PAGES, None):
        spark.conf.set(_PAGES, str(PAGE_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset a local session (tests) gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='geoweave-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/geoweave/{uuid.uuid4().hex}-{label}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a table in the shared folder and read it again: it is worked out once, its size is known, and it outlives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_by_one(structs: str | Column, *fields: str) -> Column:
    """`explode` of an array of structs, with these fields of them, whose rows go on one at a time.

    A plain explode is compiled into one loop with the joins and explodes around it, and such a loop holds all rows that come of one of its input
    rows: of a sentence, its mentions times the areas of their names. A generator over a lambda is not compiled, and gives its rows on as they are asked for.
    """
    return F.explode(F.transform(structs, lambda x: F.struct(*(x[f].alias(f) for f in fields))))
