"""Keep-first over a stream: of each area and document, the first evidence in the order of shards and rows, however files come in.

The state of a key is the place of its first row so far, a streaming aggregate that Spark keeps by itself: a key of which something
new has come goes on with the first of all its rows. So a document that comes again, in the same file or years later, is told once,
and what was told first gives way if a row before it comes late. The places that went on are written by batch; the least of a key
counts (`first_places`).

State is held by Spark's RocksDB store in the stream's checkpoint, partitioned by key: one small row for each area and document
with evidence, in no task's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.operators.gazetteer import document_identity

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PLACE = ["shard", "row_index", "normalized_name"]
KEY = ["polygon_id", "kind", "a", "b"]
PLACES = "polygon_id string, kind string, a string, b string, shard string, row_index long, normalized_name string"


def places(evidence: DataFrame) -> DataFrame:
    """The key and the place of each row of evidence, without its texts."""
    return evidence.select("polygon_id", document_identity().alias("_i"), *PLACE).select("polygon_id", "_i.kind", "_i.a", "_i.b", *PLACE)


def track_first(evidence: DataFrame, target: str) -> None:
    """evidence: a stream of files. Takes in what is new, and writes the places that go on under the target."""
    spark = evidence.sparkSession
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        first = places(evidence).groupBy(*KEY).agg(F.min(F.struct(*PLACE)).alias("first")).select(*KEY, "first.*")

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{target}/places/batch={number}")

        first.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_STORE, before)


def first_places(spark: SparkSession, target: str) -> DataFrame:
    """The places that count, one for each area and document."""
    rows = spark.read.schema(f"{PLACES}, batch long").option("basePath", f"{target}/places").parquet(f"{target}/places")
    return rows.groupBy(*KEY).agg(F.min(F.struct(*PLACE)).alias("first")).select("polygon_id", "first.*")
