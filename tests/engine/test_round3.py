"""Findings of the third review: each test failed before its change."""

import pytest

import __spark_entry__


@pytest.fixture(scope="module")
def run(spark):
    return lambda name, folder: sorted(map(tuple, __spark_entry__.queries()[name](spark, str(folder)).collect()), key=str)


def test_pages_in_several_files_are_one_shard(spark, run, tmp_path):
    rows = spark.range(250).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "'<p>' AS html").collect()
    (tmp_path / "pages.parquet").mkdir()
    for n, (a, b) in enumerate([(0, 130), (130, 145), (145, 250)]):
        spark.createDataFrame(rows[a:b]).coalesce(1).write.parquet(str(tmp_path / f"w{n}"))
        part = next(p for p in (tmp_path / f"w{n}").iterdir() if p.name.startswith("part-"))
        part.rename(tmp_path / "pages.parquet" / f"part-{n:04}.parquet")
    assert run("row_chunks", tmp_path) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]
    assert sorted((r[0], r[1], r[2]) for r in run("document_rows", tmp_path)) == sorted(("pages.parquet", i, str(i)) for i in range(250))


@pytest.mark.parametrize("name", ["osm_names", "osm_areas", "pbf_names", "pbf_areas"])
def test_ways_with_numbers_like_those_of_inner_rings(spark, run, tmp_path, name):
    spark.createDataFrame([(k,) for k in (7, 1001, 10003, 100004)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    ways = sorted(r[0].removeprefix("m/") for r in run(name, tmp_path) if "way/" in r[0])
    assert ways == ["way/100004", "way/10003", "way/1001", "way/7"]


def test_waves_of_a_long_run_are_few():
    from geoweave.plans.chunks import Chunk, waves_of

    left = [Chunk("a", n, n, 1) for n in range(5000)]
    waves = waves_of(left, 4)
    assert [c for w in waves for c in w] == left and len(waves) < 50 and [len(w) for w in waves[:3]] == [4, 8, 16]
    assert [len(w) for w in waves_of(left[:10], 3)] == [3, 3, 3, 1]


def test_many_waves_of_answers_are_few_jobs(spark, tmp_path):
    from geoweave.operators import classify
    from geoweave.plans import answers

    rows = spark.range(400).selectExpr("concat('w/', id % 3) AS polygon_id", "id AS row_index", "array(repeat('x', CAST(id AS INT))) AS sentences_with_topic_term")
    told = lambda texts: ["yes" if len(t) % 2 else "no" for t in texts]
    got = answers.answered(rows, told, str(tmp_path / "c"), {}, wave_rows=2)
    assert sorted(map(str, got.collect())) == sorted(map(str, classify.labelled(rows, told).collect()))
    waves = [p for p in (tmp_path / "c" / "answers").iterdir() if p.name.startswith("wave=")]
    assert len(waves) > 100 and sum(len([f for f in w.iterdir() if f.name.startswith("part-")]) for w in waves) == len(waves)
    assert len([p for p in (tmp_path / "c" / "events").iterdir() if p.name.startswith("part-")]) <= answers.MAX_JOBS


def test_areas_of_one_name_do_not_multiply_mentions(spark):
    from geoweave.operators import lexical
    from geoweave.plans import runs

    from .test_retrieval import areas, docs

    a = areas(spark, *[("n", "Green", [])] * 30, ("n", "Quillbury", ["Old Mill"]))
    d = docs(spark, ("Green and Green. Old Mill, Quillbury.", "http://x/green"), ("Green", ""))
    countries = {"n": "Norland"}
    grouped, members = runs.find_grouped(d, a, "v3", countries=countries)
    every = runs.find_candidates(d, a, "v3", countries=countries)
    assert grouped.count() == 5 and every.count() == 3 * 30 + 2
    plain = lambda rows: sorted(map(str, rows.collect()))
    assert plain(runs.result_counts(grouped, members=members)) == plain(runs.result_counts(every))
    assert plain(lexical.source_summary(grouped, a, members)) == plain(lexical.source_summary(every, a))


def test_batches_to_python_are_bounded(spark):
    from geoweave import queries

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    queries.shard(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
