"""Functions from SQL text, places in a total order, and the later commands of the command line."""

import json

import pytest
from pyspark.sql import functions as F

from geoweave import cli
from geoweave.functions import sql
from geoweave.operators import matching
from geoweave.operators.ordering import numbered
from geoweave.operators.topics import CONTRACT


def test_places_equal_a_sort(spark):
    rows = spark.range(5000).select((F.hash("id") % 700).alias("a"), F.col("id").alias("b")).repartition(7)
    got = sorted((r.place, r.a, r.b) for r in numbered(rows, ["a", "b"], partitions=9).collect())
    want = sorted((r.a, r.b) for r in rows.collect())
    assert [g[1:] for g in got] == want and [g[0] for g in got] == list(range(1, 5001))
    assert numbered(rows.limit(0), ["a"]).count() == 0
    plan = numbered(rows, ["a", "b"])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_functions_from_sql(spark):
    sql.register(spark)
    row = spark.sql("SELECT geoweave_normalize('Ｆoo--BAR') AS a, geoweave_normalize_url('http://x/%C3%89t%C3%A9') AS b, geoweave_normalize(NULL) AS c, length(geoweave_excerpt(repeat('x', 300))) AS d").first()
    assert (row.a, row.b, row.c, row.d) == ("foo bar", "http x été", "", 240)


def test_table_function_of_mentions(spark, monkeypatch):
    names = spark.createDataFrame([("old mill",), ("dorn",), ("",)], "normalized_name string")
    sql.register_names(spark, names, prefix="t")
    docs = spark.createDataFrame([(1, "a", "The Old-Mill. Dorn!"), (2, "b", None), (3, "c", "none")], "id long, tag string, body string")
    docs.createOrReplaceTempView("t_docs")
    rows = spark.sql("SELECT * FROM t_mentions(TABLE(t_docs), 'body') ORDER BY id, start_char")
    assert rows.columns == ["id", "tag", "name", "start_char", "end_char", "sentence"]
    assert [tuple(r) for r in rows.collect()] == [(1, "a", "old mill", 4, 12, "The Old-Mill."), (1, "a", "dorn", 14, 18, "Dorn!")]
    assert [r[0] for r in spark.sql("SELECT t_names_in(body) FROM t_docs ORDER BY id").collect()] == [["old mill", "dorn"], [], []]
    with pytest.raises(Exception, match="no column text"):
        spark.sql("SELECT * FROM t_mentions(TABLE(t_docs), 'text')").collect()
    with pytest.raises(Exception, match="columns of the result"):
        spark.sql("SELECT * FROM t_mentions(TABLE(SELECT body, 1 AS name FROM t_docs), 'body')").collect()
    monkeypatch.setattr(matching, "MAX_NAMES", 1)
    with pytest.raises(ValueError, match="too many"):
        sql.register_names(spark, names)


def yes_to_clay(texts):
    return ["yes" if "clay" in t else "no" for t in texts]


def test_refine_and_compare_from_the_command_line(spark, tmp_path, capsys):
    docs, areas = str(tmp_path / "d"), str(tmp_path / "areas")
    texts = ["Quillbury lies in Norland. There is clay. Also a pond.", "Quillbury in Norland has a pond.", "Quillbury and Norland."]
    spark.createDataFrame([(t, f"u{i}") for i, t in enumerate(texts)], "text string, url string").write.parquet(docs)
    spark.createDataFrame([("w/1", "n", "Quillbury", [], {"name": "Quillbury"})], "polygon_id string, source_key string, name string, aliases array<string>, tags map<string,string>").write.parquet(areas)
    (tmp_path / "v.json").write_text(json.dumps({"version": "1", "language": "en", "matching": CONTRACT, "categories": {"soil": ["clay"], "water": ["pond"]}}))

    def run(*args):
        capsys.readouterr()
        code = cli.main(list(map(str, args)), spark)
        return code, capsys.readouterr()

    common = ["--documents", docs, "--areas", areas, "--ratio", "5"]
    assert run("scan", *common, "--country", "Norland", "--version", "v6", "--output", tmp_path / "v6")[0] == 0
    refine = ["refine", "--evidence", tmp_path / "v6", "--vocabulary", tmp_path / "v.json"]
    for version, rows in (("v7", 3), ("v8", 2), ("v9", 2)):
        code, out = run(*refine, "--version", version, "--output", tmp_path / version)
        assert code == 0 and json.loads(out.out)["rows"] == rows
    assert run(*refine, "--version", "v10", "--output", tmp_path / "v10")[0] == 2
    assert run(*refine, "--version", "v10", "--output", tmp_path / "v10", "--classifier", "no_such:thing")[0] == 2
    told = []
    for _ in range(2):
        code, out = run(*refine, "--version", "v10", "--output", tmp_path / "v10", "--classifier", f"{__name__}:yes_to_clay")
        told.append(json.loads(out.out))
        assert code == 0
    assert [(t["rows"], t["reused"]) for t in told] == [(1, False), (1, True)]
    for version in ("v2", "v3"):
        assert run("candidates", *common, "--countries", "n=Norland", "--version", version, "--output", tmp_path / f"l{version}")[0] == 0
    code, out = run("compare", "--v2", tmp_path / "lv2", "--v3", tmp_path / "lv3")
    assert code == 0 and "equal as multisets: yes" in out.out and "| Quillbury | 3 |" in out.out
