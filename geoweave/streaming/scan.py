"""Incremental scans: new document files become evidence, each file once.

The checkpoint of the stream knows which files are done, a batch is written under its own number
(so a repeated batch replaces itself), and a changed setting is an error as its hash is part of
the output's folder. `kept` takes the first evidence of each area and document over all batches, by a stateful stream
over the evidence (`first_seen`), so that the result is the same however the files are split into batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.plans.manifest import payload_hash
from geoweave.streaming.first_seen import PLACE, first_places, track_first

DOCUMENTS = "row_index long, document_id string, text string, url string"
SHARD = "shard"


def _scan(spark: SparkSession, source: str, folder: str, find: Callable[[DataFrame], DataFrame], files_per_batch: int) -> None:
    def write(batch: DataFrame, number: int) -> None:
        find(batch).write.mode("overwrite").parquet(f"{folder}/data/batch={number}")

    files = spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream = files.select(F.col("_metadata.file_name").alias(SHARD), "*")
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def scan_new_files(spark: SparkSession, source: str, target: str, settings: dict, find: Callable[[DataFrame], DataFrame], *, files_per_batch: int = 1000) -> DataFrame:
    """Process what has come since the last call; the evidence so far, empty before the first. source: Parquet files of DOCUMENTS.

    find gets the documents with the file they came in as `shard`. Rules with a cutoff of frequencies
    need profiles that were chosen before, as a batch knows nothing of the others.
    """
    folder = f"{target}/{payload_hash(settings)[:16]}"
    _scan(spark, source, folder, find, files_per_batch)
    try:
        return spark.read.option("basePath", f"{folder}/data").parquet(f"{folder}/data")
    except AnalysisException:  # no file has come yet
        return find(_no_documents(spark)).withColumn("batch", F.lit(None).cast("int"))


def _no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{SHARD} string, {DOCUMENTS}")


def keep_first_of_new_files(spark: SparkSession, source: str, target: str, settings: dict, find: Callable[[DataFrame], DataFrame], *, files_per_batch: int = 1000) -> DataFrame:
    """`scan_new_files`, with one row for each area and document: the first by shard, row and name over all that has come.

    find: rows with normalized_name, as `retrieval.evidence` gives them.
    """
    folder = f"{target}/{payload_hash(settings)[:16]}"
    _scan(spark, source, folder, find, files_per_batch)
    schema = find(_no_documents(spark)).schema
    try:
        evidence = spark.read.schema(schema).parquet(f"{folder}/data")
    except AnalysisException:  # no file has come yet
        return find(_no_documents(spark))
    new = spark.readStream.schema(schema).parquet(f"{folder}/data")
    track_first(new, f"{folder}/first")
    kept = first_places(spark, f"{folder}/first")
    return evidence.join(kept, ["polygon_id", *PLACE], "left_semi").select(*evidence.columns)
