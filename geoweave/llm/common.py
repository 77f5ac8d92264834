"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.sources.tables import spread

BATCH_ROWS = 1000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset a local session (tests) gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='geoweave-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python BATCH_ROWS at a time at most: texts are long, and workers keep the memory of their largest batch."""
    if int(spark.conf.get(_BATCHES)) > BATCH_ROWS:
        spark.conf.set(_BATCHES, str(BATCH_ROWS))


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a table in the shared folder and read it again: cuts lineage, and outlives lost executors."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/geoweave/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, so that other columns, whatever their names, cannot clash."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def sha256_text(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that df does not have."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name
