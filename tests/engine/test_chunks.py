"""Runs in chunks: killed, resumed, changed; the log of events; the command line."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from geoweave import cli
from geoweave.plans import chunks, runs
from geoweave.sources import tables

ROWS = 95


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("chunks") / "d")
    text = F.when(F.col("i") % 4 == 0, F.concat(F.lit("Quillbury by Norland, no. "), F.col("i") % 8)).when(F.col("i") % 7 == 0, "Marlow in Norland").otherwise("nothing")
    rows = spark.range(2 * ROWS).select(F.col("id").alias("i")).select("i", text.alias("text"), F.concat(F.lit("u"), F.col("i") % 5).alias("url"))
    for n in range(2):
        rows.where(F.col("i") % 2 == n).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame([("w/1", "a", "Quillbury", [], {"name": "Quillbury"}, None), ("w/2", "a", "Marlow", [], {"name": "Marlow"}, None)], "polygon_id string, source_key string, name string, aliases array<string>, tags map<string,string>, geometry string").drop("geometry")


def documents(spark, shards):
    return tables.read_documents(spark, shards)


def found_in(rows):
    return rows.select("polygon_id", "shard", "row_index")


def plain(rows):
    return sorted(map(tuple, rows.collect()))


def find(rows):
    return rows.where("text <> 'nothing'").select("shard", "row_index", "text")


def test_plan_covers_all_rows_in_order(spark, shards):
    plan = chunks.chunk_plan(documents(spark, shards), 20)
    assert len(plan) == 10 and sum(c.rows for c in plan) == 2 * ROWS
    assert [(c.chunk, c.first_row, c.rows) for c in plan[:5]] == [(0, 0, 20), (1, 20, 20), (2, 40, 20), (3, 60, 20), (4, 80, 15)]
    with pytest.raises(ValueError):
        chunks.chunk_plan(documents(spark, shards), 0)
    twice = documents(spark, shards).withColumn("shard", F.lit("same"))
    with pytest.raises(ValueError, match="one name"):
        chunks.chunk_plan(twice, 20)


@pytest.mark.parametrize("error", [OSError("lost"), KeyboardInterrupt()])
def test_a_killed_run_does_only_what_is_left(spark, shards, tmp_path, error):
    docs, path, waves, told = documents(spark, shards), str(tmp_path / "r"), [], []

    def failing(rows):
        waves.append(rows)
        if len(waves) == 4:  # the first call asks for the columns only
            raise error
        return find(rows)

    with pytest.raises(type(error)):
        chunks.run_chunks(docs, path, {"a": 1}, failing, rows_per_chunk=20, chunks_per_wave=3, tell=told.append)
    states = {r.state: r.n for r in chunks.chunk_states(chunks.EventLog(spark, f"{path}/events").read()).groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert states == {"complete": 6, "failed": 3, "pending": 1}
    done = chunks.run_chunks(docs, path, {"a": 1}, find, rows_per_chunk=20, chunks_per_wave=3)
    assert (done.chunks_done, done.chunks_skipped, done.rows_scanned) == (4, 6, 2 * ROWS)
    assert plain(done.found) == plain(find(docs)) and done.matches == find(docs).count()
    again = chunks.run_chunks(docs, path, {"a": 1}, lambda rows: find(rows), rows_per_chunk=20)
    assert (again.chunks_done, again.chunks_skipped) == (0, 10) and again.rows_scanned == 2 * ROWS
    times = [datetime.fromisoformat(e["time"]) for e in told]
    assert times == sorted(times) and all(t.utcoffset() == timedelta(0) for t in times)
    assert [e["event"] for e in told if e["event"] != "pending"][:2] == ["run_begins", "running"] and "lost" in str(told[-1]["error"]) or isinstance(error, KeyboardInterrupt)


def test_running_chunks_of_a_lost_driver_and_lost_files_are_done_again(spark, shards, tmp_path):
    docs, path = documents(spark, shards), str(tmp_path / "r")
    chunks.run_chunks(docs, path, {}, find, rows_per_chunk=50)
    log = chunks.EventLog(spark, f"{path}/events")
    first = chunks.chunk_plan(docs, 50)[0]
    log.append({"event": "running", "shard": first.shard, "chunk": first.chunk})
    done = chunks.run_chunks(docs, path, {}, find, rows_per_chunk=50)
    assert (done.chunks_done, done.chunks_skipped) == (1, 3) and plain(done.found) == plain(find(docs))
    import shutil

    shutil.rmtree(f"{path}/data/shard={first.shard}/_chunk=1")
    done = chunks.run_chunks(docs, path, {}, find, rows_per_chunk=50)
    assert (done.chunks_done, done.chunks_skipped) == (1, 3) and plain(done.found) == plain(find(docs))


def test_other_settings_and_other_chunks_are_refused(spark, shards, tmp_path):
    docs, path = documents(spark, shards), str(tmp_path / "r")
    chunks.run_chunks(docs, path, {"a": 1}, find, rows_per_chunk=50)
    with pytest.raises(ValueError, match="settings"):
        chunks.run_chunks(docs, path, {"a": 2}, find, rows_per_chunk=50)
    with pytest.raises(ValueError, match="chunks"):
        chunks.run_chunks(docs, path, {"a": 1}, find, rows_per_chunk=49)
    with pytest.raises(ValueError, match="chunks"):
        chunks.run_chunks(docs.where("row_index < 90"), path, {"a": 1}, find, rows_per_chunk=50)


def test_nothing_found_and_no_documents(spark, shards, tmp_path):
    docs = documents(spark, shards)
    none = chunks.run_chunks(docs, str(tmp_path / "a"), {}, lambda rows: find(rows).where("false"), rows_per_chunk=60)
    assert none.found.count() == 0 and none.matches == 0 and none.chunks_done == 4
    assert chunks.run_chunks(docs, str(tmp_path / "a"), {}, lambda rows: find(rows).where("false"), rows_per_chunk=60).chunks_skipped == 4
    empty = chunks.run_chunks(docs.limit(0), str(tmp_path / "b"), {}, find, rows_per_chunk=60)
    assert empty.found.count() == 0 and empty.chunks_done == 0


def test_a_wave_reads_only_its_shards(spark, shards, tmp_path):
    docs = documents(spark, shards)
    shard = sorted(r.shard for r in docs.select("shard").distinct().collect())[0]
    assert len(docs.where(F.col("shard").isin(shard)).inputFiles()) == 2  # before planning
    metrics = docs.where(F.col("shard").isin(shard)).select("text")
    assert metrics.rdd.getNumPartitions() <= docs.rdd.getNumPartitions() and metrics.count() == ROWS


@pytest.mark.parametrize("version", ["v1", "v4", "v6"])
def test_retrieval_in_chunks_equals_one_run(spark, shards, areas, tmp_path, version):
    docs = documents(spark, shards)
    done = runs.retrieve_in_chunks(docs, areas, version, str(tmp_path / "r"), {}, country="Norland", rows_per_chunk=30, chunks_per_wave=3, ratio=0.9)
    assert plain(found_in(done.found)) == plain(found_in(runs.retrieve(docs, areas, version, country="Norland", ratio=0.9)))


@pytest.mark.parametrize("version", ["v1", "v2", "v3"])
def test_candidates_in_chunks_equal_one_run(spark, shards, areas, tmp_path, version):
    docs, countries = documents(spark, shards), {"a": "Norland"}
    done = runs.candidates_in_chunks(docs, areas, version, str(tmp_path / "r"), {}, countries=countries, rows_per_chunk=40, ratio=0.9)
    assert plain(done.found) == plain(runs.find_candidates(docs, areas, version, countries=countries, ratio=0.9).select(*done.found.columns))


def test_command_line_resumes(spark, shards, areas, tmp_path, capsys):
    areas.write.parquet(str(tmp_path / "areas"))
    args = ["scan", "--documents", shards, "--areas", str(tmp_path / "areas"), "--country", "Norland", "--version", "v4", "--chunk-rows", "30", "--wave", "2"]
    told = []
    for output in ("a", "a", "b"):
        capsys.readouterr()
        assert cli.main([*args, "--output", str(tmp_path / output)], spark) == 0
        told.append(json.loads(capsys.readouterr().out))
    assert [(t["chunks_done"], t["chunks_skipped"]) for t in told] == [(8, 0), (0, 8), (8, 0)]
    assert told[0]["rows"] == told[1]["rows"] > 0 and told[0]["rows_scanned"] == 2 * ROWS and told[1]["reused"]
    assert cli.main([*args[:-4], "--chunk-rows", "31", "--output", str(tmp_path / "a")], spark) == 2
