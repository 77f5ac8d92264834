"""Readers and writers of documents, rows of JSON, vocabularies and results."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.operators.topics import Vocabulary
from geoweave.sources.pbf import MARK

REQUIRED = ("text", "url")


def missing_columns(frame: DataFrame, columns: Sequence[str]) -> list[str]:
    return sorted(set(columns) - set(frame.columns))


def require_columns(frame: DataFrame, columns: Sequence[str]) -> None:
    missing = missing_columns(frame, columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a few large partitions dealt anew, so that all cores have some. Inputs with a partition for each core stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def read_documents(spark: SparkSession, path: str, *, text_col: str = "text", url_col: str = "url", id_col: str = "id") -> DataFrame:
    """shard (the file), row_index in it, document_id, text, url of Parquet shards; only these columns are read. The column of ids is optional."""
    rows = spark.read.parquet(path)
    require_columns(rows, (text_col, url_col))
    document_id = F.col(id_col).cast("string") if id_col in rows.columns else F.lit(None).cast("string")
    return rows.select(F.col("_metadata.file_name").alias("shard"), F.col("_metadata.row_index").alias("row_index"), document_id.alias("document_id"), F.coalesce(text_col, F.lit("")).alias("text"), F.coalesce(url_col, F.lit("")).alias("url"))


def as_one_shard(rows: DataFrame, shard: str, file: str = "shard") -> DataFrame:
    """Rows with a row_index within their files, counted on over all files in the order of their names: the files are the parts of one shard."""
    before, starts = 0, []
    for r in sorted(rows.groupBy(file).count().collect()):  # one row a file
        starts.append((r[file], before))
        before += r["count"]
    begins = rows.sparkSession.createDataFrame(starts, "_file string, _before long")
    placed = rows.join(F.broadcast(begins), F.col(file) == F.col("_file"))
    return placed.withColumns({"row_index": F.col("row_index") + F.col("_before"), file: F.lit(shard)}).drop("_file", "_before")


def row_ranges(spark: SparkSession, path: str, rows_per_chunk: int, *, one_shard: bool = False) -> DataFrame:
    """file, chunk, first_row, rows: chunks of consecutive rows, from the row indices alone. one_shard: over all files, see as_one_shard."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index"))
    rows = (as_one_shard(rows, path, "file") if one_shard else rows).withColumnRenamed("row_index", "i")
    return rows.groupBy("file", F.floor(F.col("i") / rows_per_chunk).alias("chunk")).agg(F.min("i").alias("first_row"), F.count("*").alias("rows"))


def parsed_rows(lines: DataFrame, schema: str) -> DataFrame:
    """lines: column value. Rows of JSON; a line that is blank or no object is an error."""
    return _checked(lines).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def _checked(lines: DataFrame) -> DataFrame:
    bad = ~F.coalesce(F.trim("value").startswith("{"), F.lit(False))
    shown = F.concat(F.lit("a line is no JSON object: "), F.coalesce(F.substring("value", 1, 80), F.lit("null")))
    return lines.select(F.when(bad, F.raise_error(shown)).otherwise(F.col("value")).alias("value"))


def read_json_rows(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of JSON files, see parsed_rows. Without a schema the lines are checked in a pass of their own, and it is inferred."""
    lines = spark.read.text(path)
    if schema is not None:
        return parsed_rows(lines, schema)
    _checked(lines).write.format("noop").mode("overwrite").save()
    return spark.read.option("mode", "FAILFAST").json(path)


def json_lines(frame: DataFrame) -> DataFrame:
    """value: one object a row, keys in alphabetical order, nulls kept."""
    return frame.select(F.to_json(F.struct(*sorted(frame.columns)), {"ignoreNullFields": "false"}).alias("value"))


def write_json_rows(frame: DataFrame, path: str) -> None:
    json_lines(frame).write.mode("overwrite").text(path)


def write_by_source(frame: DataFrame, path: str, sources: Sequence[str]) -> None:
    """One Parquet folder a source (`source_key=...`), written in one job; readers get an empty frame for sources without rows."""
    known = frame.where(F.col("source_key").isin(*sources))
    known.write.mode("overwrite").option("compression", "zstd").partitionBy("source_key").parquet(path)


def read_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("source_key") == source).drop("source_key")


def read_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    found = spark.read.option("wholetext", "true").text(path).first()
    try:
        return Vocabulary.from_mapping(json.loads(found.value if found else ""))
    except json.JSONDecodeError as e:
        raise ValueError(f"the vocabulary is no JSON: {path}") from e


#: Larger files are hashed row by row or blob by blob, as a file's content is one value when it is read whole.
MAX_HASHED_BYTES = 1 << 30


def _summed(digest: Column) -> list[Column]:
    """SHA-256 digests (hexadecimal) added up as four numbers of 64 bits: the same however rows are dealt to tasks."""
    part = lambda i: F.conv(F.substring(digest, 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")
    return [F.sum(part(i)).cast("string").alias(f"s{i}") for i in range(4)]


def _in_parts(spark: SparkSession, files: list[str], name: Column) -> DataFrame:
    """f: a line for each of some large files, of its parts' hashes; parts are read in the tasks that Spark deals them to."""
    lines = []
    parquet = [f for f in files if f.endswith(".parquet")]
    if parquet:
        rows = spark.read.option("mergeSchema", "true").parquet(*parquet)
        told = F.struct(F.col("_metadata.row_index").alias("_at"), *(F.col(f"`{c}`") for c in rows.columns))
        each = rows.select(F.col("_metadata.file_path").alias("path"), F.sha2(F.to_json(told, {"ignoreNullFields": "false"}), 256).alias("h"))
        lines.append(each.withColumn("kind", F.lit(rows.schema.simpleString())))
    binary = [f for f in files if f.endswith(".pbf")]
    if binary:
        # Blobs of elements, which come in no order.
        blobs = spark.read.text(binary, lineSep=MARK).select(F.col("_metadata.file_path").alias("path"), F.sha2(F.col("value").cast("binary"), 256).alias("h"))
        lines.append(blobs.withColumn("kind", F.lit("blobs")))
    summed = [x.groupBy("path", "kind").agg(F.count("*").alias("n"), *_summed(F.col("h"))).select(F.concat_ws(":", name, "kind", "n", "s0", "s1", "s2", "s3").alias("f")) for x in lines]
    return reduce(DataFrame.union, summed)


def fingerprint(spark: SparkSession, path: str, max_hashed_bytes: int = MAX_HASHED_BYTES) -> str:
    """SHA-256 over the names and contents of the files of a path; read on the executors.

    Small files are hashed whole. Of larger ones, Parquet files are hashed by row and index, and map files in the binary
    format by blob, so that no task reads a file. Of other large files (XML) name, size and time of change stand for the content.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    is_large = F.col("length") > max_hashed_bytes
    in_parts = is_large & (F.col("path").endswith(".parquet") | F.col("path").endswith(".pbf"))
    lines = files.where(~is_large).select(F.concat_ws(":", name, "length", F.sha2("content", 256)).alias("f"))
    lines = lines.union(files.where(is_large & ~in_parts).select(F.concat_ws(":", name, "length", F.col("modificationTime").cast("long").cast("string")).alias("f")))
    large = [r.path for r in files.where(in_parts).select("path").collect()]  # names of files
    if large:
        lines = lines.union(_in_parts(spark, large, name))
    # One short line a file; a sum of hashes would do for more files than a task can sort.
    row = lines.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("f")), "\n"), 256).alias("f")).first()
    return row.f
