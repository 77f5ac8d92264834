"""A checkpoint of a classifier's answers: what is answered once is not asked again.

Answers are appended wave by wave, as files of JSON lines under the number of their wave: the key of a row, and its labels. A
header beside them says what they are answers to (the source, the model, the prompt and its hash); a checkpoint with another
header is refused, as are rows that are answered twice, and lines that are no answers. A line that is cut off is let pass, and
its row asked again, where a run can have been lost in writing it: in the last wave, and in waves that were not completed. The
log of events says which waves were completed, and which cut ones were let pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.operators.classify import LABELS, Classifier, labelled
from geoweave.operators.gazetteer import document_key
from geoweave.plans.chunks import EventLog
from geoweave.plans.manifest import canonical, read_manifest, write_manifest
from geoweave.session import scratch_path

#: Rows of a wave, about.
WAVE_ROWS = 100_000
#: Jobs that the waves of a run are written in, at most: beyond that several waves are one job, so that their number costs no time.
MAX_JOBS = 32


def open_checkpoint(spark: SparkSession, path: str, header: dict) -> None:
    known = read_manifest(spark, path)
    if known is None:
        write_manifest(spark, path, header)
    elif canonical(known) != canonical(header):
        raise ValueError("the checkpoint of answers does not match this run")


def read_answers(spark: SparkSession, path: str, key_schema: str, key: Sequence[str]) -> tuple[DataFrame, int]:
    """The answers (key, labels), and the number of the next wave."""
    try:
        lines = spark.read.schema("value string, wave long").option("basePath", f"{path}/answers").text(f"{path}/answers")
    except AnalysisException:  # nothing is answered yet
        return spark.createDataFrame([], f"{key_schema}, labels array<string>"), 0
    waves = [r.wave for r in spark.read.format("binaryFile").load(f"{path}/answers/*/*").select(F.regexp_extract("path", "wave=([0-9]+)", 1).cast("long").alias("wave")).distinct().collect()]
    log = EventLog(spark, f"{path}/events")
    told = [(r.event, r.chunk) for r in log.read().where("event IN ('complete', 'cut')").select("event", "chunk").distinct().collect()]
    passes = {w for w in waves if ("complete", w) not in told or ("cut", w) in told} | {max(waves, default=-1)}
    parsed = lines.where(F.trim("value") != "").select("wave", F.from_json("value", f"{key_schema}, labels array<string>").alias("a"), F.get_json_object("value", "$").isNotNull().alias("whole"))
    fine = F.col("whole") & F.col("a.labels").isNotNull() & ~F.exists(F.col("a.labels"), lambda x: x.isNull() | ~x.isin(*LABELS))
    for c in key:
        fine = fine & F.col(f"a.{c}").isNotNull()
    cut = {r.wave for r in parsed.where(~F.col("whole")).select("wave").distinct().collect()}
    wrong = parsed.where(F.col("whole") & ~F.coalesce(fine, F.lit(False))).count()
    if wrong or cut - passes:
        raise ValueError(f"the checkpoint of answers holds lines that are no answers: {wrong} wrong, waves with cut ones: {sorted(cut)}")
    for wave in sorted(cut):
        if ("cut", wave) not in told:
            log.append({"event": "cut", "chunk": wave})
    answers = parsed.where(fine).select("a.*")
    if not answers.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError("the checkpoint of answers repeats a row")
    return answers, max(waves, default=-1) + 1


def answered(frame: DataFrame, classifier: Classifier, path: str, header: dict, *, key: Sequence[str] | None = None, batch: int = 8, wave_rows: int = WAVE_ROWS) -> DataFrame:
    """`classify.labelled` with the answers of earlier runs; new ones are kept wave by wave. header: what tells answers of other runs apart."""
    spark = frame.sparkSession
    if wave_rows < 1:
        raise ValueError("a wave must have rows")
    key = list(key or ["polygon_id", *document_key(frame)])
    kinds = dict(frame.dtypes)
    key_schema = ", ".join(f"`{c}` {kinds[c]}" for c in key)
    open_checkpoint(spark, path, header | {"key": key})
    known, number = read_answers(spark, path, key_schema, key)
    left = frame.join(known.select(*key), key, "left_anti").select(*key, "sentences_with_topic_term")
    waves, log = -(-left.count() // wave_rows), EventLog(spark, f"{path}/events")
    each = max(1, -(-waves // MAX_JOBS))
    if waves:
        left = left.withColumn("_wave", F.pmod(F.xxhash64(*key), F.lit(waves))).withColumn("_job", F.expr(f"_wave DIV {each}"))
    if waves > 1:
        # Dealt to the folders of their jobs once, as each job would read all rows.
        folder, schema = scratch_path(spark, "left"), left.schema
        left.write.partitionBy("_job").parquet(folder)
        left = spark.read.schema(schema).parquet(folder)
    for job in range(-(-waves // each)):
        rows = left.where(F.col("_job") == job).repartition("_wave")
        new = labelled(rows, classifier, batch=batch, key=key).select((F.col("_wave") + number).alias("wave"), F.to_json(F.struct(*key, "labels")).alias("value"))
        new.write.mode("append").partitionBy("wave").text(f"{path}/answers")
        log.append(*({"event": "complete", "chunk": number + w} for w in range(job * each, min(waves, (job + 1) * each))))
    known, _ = read_answers(spark, path, key_schema, key)
    return labelled(frame, classifier, batch=batch, known=known, key=key)
