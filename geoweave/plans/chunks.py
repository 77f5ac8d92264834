"""Runs in chunks of rows that resume: what is complete is not done again.

The documents are cut into chunks of consecutive rows of a shard. A wave of chunks is one Spark job: its
documents are read (other shards are pruned), searched, and written under their chunks, each of which replaces what an
earlier attempt has left there. What happens to a chunk is an event in an append-only log (pending, running, complete,
failed; with the time in UTC); a chunk's state is that of its last event. A chunk is complete once its rows are
committed and counted, and as long as they are there.

A run belongs to its settings and to its plan of chunks: other ones are an error, as their parts would not fit together.

The driver holds one row a chunk, never documents. The documents of a chunk are counted by the plan (from row indices
alone), the rows found from the files written.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.plans.manifest import payload_hash, read_manifest, write_manifest
from geoweave.session import scratch_path

STATES = ("pending", "running", "complete", "failed")
EVENT = "sequence long, time string, event string, run string, shard string, chunk long, first_row long, rows long, rows_scanned long, matches long, error string"
_CHUNK = "_chunk"
_WAVE = "_wave"
#: Waves of a long run, about: from the size asked for, waves double until no more than these are left.
MAX_WAVES = 32


def utc_now() -> str:
    return datetime.now(UTC).isoformat()


@dataclass(frozen=True, order=True)
class Chunk:
    shard: str
    chunk: int
    first_row: int
    rows: int


@dataclass
class EventLog:
    """An append-only table of events in files of JSON lines; `tell` also gets each event."""

    spark: SparkSession
    path: str
    tell: Callable[[dict], None] | None = None
    sequence: int = field(init=False, default=0)

    def __post_init__(self) -> None:
        self.sequence = self.read().agg(F.max("sequence")).first()[0] or 0

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(EVENT).json(self.path)
        except AnalysisException:  # nothing has been told yet
            return self.spark.createDataFrame([], EVENT)

    def append(self, *events: Mapping) -> None:
        rows = []
        for event in events:
            self.sequence += 1
            rows.append({"sequence": self.sequence, "time": utc_now(), **event})
            if self.tell is not None:
                self.tell(rows[-1])
        lines = self.spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in rows], "value string")
        lines.coalesce(1).write.mode("append").text(self.path)


def chunk_plan(documents: DataFrame, rows_per_chunk: int) -> list[Chunk]:
    """The chunks of documents with `shard` and `row_index`, in order."""
    if rows_per_chunk < 1:
        raise ValueError("a chunk must have rows")
    found = documents.groupBy("shard", F.expr(f"row_index DIV {rows_per_chunk}").alias("chunk")).agg(F.min("row_index").alias("first_row"), F.count("*").alias("rows"), F.countDistinct("row_index").alias("different"))
    rows = found.collect()  # one row a chunk
    if any(r.rows != r.different for r in rows):
        raise ValueError("several shards have one name")
    return sorted(Chunk(r.shard, r.chunk, r.first_row, r.rows) for r in rows)


def chunk_states(events: DataFrame) -> DataFrame:
    """shard, chunk, state, time, matches, error: what was told last of each chunk."""
    last = F.max_by(F.struct(F.col("event").alias("state"), "time", "matches", "error"), "sequence").alias("last")
    return events.where(F.col("event").isin(*STATES) & F.col("chunk").isNotNull()).groupBy("shard", "chunk").agg(last).select("shard", "chunk", "last.*")


@dataclass(frozen=True)
class ChunkRun:
    """What a run has found, and what it did for that."""

    found: DataFrame
    chunks_done: int
    chunks_skipped: int
    rows_scanned: int
    matches: int
    seconds: float

    def counters(self) -> dict:
        return {k: getattr(self, k) for k in ("chunks_done", "chunks_skipped", "rows_scanned", "matches")}


def _counts(spark: SparkSession, data: str, schema) -> dict[tuple[str, int], int]:
    """Rows of each chunk that has some, from the files."""
    return {(r.shard, r[_CHUNK]): r["count"] for r in spark.read.schema(schema).parquet(data).groupBy("shard", _CHUNK).count().collect()}


def _counts_of(spark: SparkSession, data: str, schema, wave: list[Chunk]) -> dict[tuple[str, int], int]:
    """_counts of a wave, whose folders alone are listed."""
    own = ",".join(sorted({str(c.chunk) for c in wave}))
    try:
        rows = spark.read.schema(schema).option("basePath", data).parquet(f"{data}/*/{_CHUNK}={{{own}}}")
    except AnalysisException:  # none of them has a row
        return {}
    found = {(r.shard, r[_CHUNK]): r["count"] for r in rows.groupBy("shard", _CHUNK).count().collect()}
    return {k: n for c in wave if (n := found.get(k := (c.shard, c.chunk)))}


def waves_of(left: list[Chunk], size: int) -> list[list[Chunk]]:
    """Chunks in waves of a size. A job takes its time however little it does: of a run of many waves the later ones are larger."""
    out, at, most = [], 0, max(size, -(-len(left) // MAX_WAVES))
    while at < len(left):
        out.append(left[at : at + size])
        at, size = at + size, min(2 * size, most)
    return out


def _dealt(documents: DataFrame, waves: list[list[Chunk]], rows_per_chunk: int) -> Callable[[int], DataFrame]:
    """The documents of a wave, by its number. Those of several waves are dealt to the folders of their waves once, a chunk to one file, so that none is read for other waves."""
    spark = documents.sparkSession
    if len(waves) < 2:
        return lambda n: _documents_of(documents, waves[n], rows_per_chunk)
    own = spark.createDataFrame([(c.shard, c.chunk, n) for n, wave in enumerate(waves) for c in wave], f"own_shard string, own_chunk long, {_WAVE} int")
    of_row = F.expr(f"row_index DIV {rows_per_chunk}")
    placed = documents.join(F.broadcast(own), (F.col("shard") == F.col("own_shard")) & (of_row == F.col("own_chunk")))
    placed, path = placed.repartition("own_shard", "own_chunk").drop("own_shard", "own_chunk"), scratch_path(spark, "waves")
    placed.write.option("compression", "zstd").partitionBy(_WAVE).parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    return lambda n: rows.where(F.col(_WAVE) == n).select(*documents.columns)


def run_chunks(
    documents: DataFrame, path: str, settings: dict, find: Callable[[DataFrame], DataFrame], *, rows_per_chunk: int, chunks_per_wave: int | None = None, tell: Callable[[dict], None] | None = None
) -> ChunkRun:
    """find: the documents of a wave -> rows with their `shard` and `row_index`. Continues what stands at the path."""
    spark, began = documents.sparkSession, time.monotonic()
    plan = chunk_plan(documents, rows_per_chunk)
    of_plan = payload_hash({"rows_per_chunk": rows_per_chunk, "chunks": [[c.shard, c.chunk, c.first_row, c.rows] for c in plan]})
    known = read_manifest(spark, path)
    wanted = {"settings": settings, "settings_hash": payload_hash(settings), "plan_hash": of_plan, "chunks": len(plan)}
    for key, told in (("settings_hash", "other inputs or settings"), ("plan_hash", "other chunks")):
        if known is not None and known.get(key) != wanted[key]:
            raise ValueError(f"{path} was made with {told}")
    name = f"chunks-{wanted['settings_hash'][:16]}"
    log = EventLog(spark, f"{path}/events", tell)
    if known is None:
        log.append({"event": "run_begins", "run": name}, *({"event": "pending", "run": name, "shard": c.shard, "chunk": c.chunk, "first_row": c.first_row, "rows": c.rows} for c in plan))
        write_manifest(spark, path, wanted)

    data = f"{path}/data"
    empty = find(documents.limit(0)).withColumn(_CHUNK, F.lit(0).cast("long"))
    schema, columns = empty.schema, [c for c in empty.columns if c != _CHUNK]
    empty.limit(0).write.mode("append").parquet(data)  # so that there is a folder to read
    states = {(r.shard, r.chunk): r for r in chunk_states(log.read()).where("state = 'complete'").collect()}
    there = _counts(spark, data, schema)
    complete = {k for k, r in states.items() if there.get(k, 0) == r.matches}
    left = [c for c in plan if (c.shard, c.chunk) not in complete]
    skipped = [c for c in plan if (c.shard, c.chunk) in complete]
    scanned = sum(c.rows for c in plan)
    size = chunks_per_wave or spark.sparkContext.defaultParallelism
    if size < 1:
        raise ValueError("a wave must have chunks")
    waves = waves_of(left, size)
    documents_of = _dealt(documents, waves, rows_per_chunk)
    for n, wave in enumerate(waves):
        each = [{"run": name, "shard": c.shard, "chunk": c.chunk, "first_row": c.first_row, "rows": c.rows} for c in wave]
        log.append(*(e | {"event": "running"} for e in each))
        try:
            _run_wave(documents_of(n), data, find, rows_per_chunk)
            there = {k: v for k, v in there.items() if k not in {(c.shard, c.chunk) for c in wave}} | _counts_of(spark, data, schema, wave)
        except BaseException as e:
            log.append(*(x | {"event": "failed", "error": str(e)[:2000]} for x in each))
            raise
        log.append(*(e | {"event": "complete", "rows_scanned": e["rows"], "matches": there.get((e["shard"], e["chunk"]), 0)} for e in each))
    matches = sum(there.get((c.shard, c.chunk), 0) for c in plan)
    found = spark.read.schema(schema).parquet(data).select(*columns)
    log.append({"event": "run_complete", "run": name, "rows_scanned": scanned, "matches": matches})
    return ChunkRun(found, len(left), len(skipped), scanned, matches, time.monotonic() - began)


def _documents_of(documents: DataFrame, wave: list[Chunk], rows_per_chunk: int) -> DataFrame:
    spark = documents.sparkSession
    of_row = F.expr(f"row_index DIV {rows_per_chunk}")
    own = spark.createDataFrame([(c.shard, c.chunk) for c in wave], "own_shard string, own_chunk long")
    # The names alone prune the files; the join then keeps the chunks' rows.
    return documents.where(F.col("shard").isin(*{c.shard for c in wave})).join(F.broadcast(own), (F.col("shard") == F.col("own_shard")) & (of_row == F.col("own_chunk")), "left_semi")


def _run_wave(rows: DataFrame, data: str, find: Callable[[DataFrame], DataFrame], rows_per_chunk: int) -> None:
    of_row = F.expr(f"row_index DIV {rows_per_chunk}")
    find(rows).withColumn(_CHUNK, of_row).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard", _CHUNK).parquet(data)
