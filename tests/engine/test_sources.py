"""Readers, writers, OSM areas, manifests, streams and the command line."""

import json

import pytest

from geoweave import cli
from geoweave.operators import gazetteer, retrieval
from geoweave.plans import manifest, versions
from geoweave.sources import osm, tables
from geoweave.streaming.scan import scan_new_files

from .test_retrieval import docs, profiles


def osm_file(tmp_path):
    node = lambda i, x, y: f'<node id="{i}" lat="{y}" lon="{x}"/>'
    way = lambda i, refs, **tags: f'<way id="{i}">' + "".join(f'<nd ref="{r}"/>' for r in refs) + "".join(f'<tag k="{k.replace("__", ":")}" v="{v}"/>' for k, v in tags.items()) + "</way>"
    nodes = [node(1, 0, 0), node(2, 4, 0), node(3, 4, 4), node(4, 0, 4), node(5, 1, 1), node(6, 2, 1), node(7, 2, 2), node(8, 1, 2), node(9, 20, 20), node(10, 21, 20), node(11, 21, 21)]
    ways = [way(10, [5, 6, 7, 8, 5], name="Tower", name__fr="La Tour", name__en="Tower"), way(11, [1, 2, 3, 1]), way(12, [1, 2, 3], name="Open"), way(13, [1, 2, 3]), way(14, [3, 4, 1]), way(15, [9, 10, 11, 9], name="Elm Row"), way(16, [1, 2, 99, 1], name="Broken")]
    boundary = {"type": "boundary", "name": "Norland", "boundary": "administrative", "admin_level": "8", "place": "city"}
    relation = '<relation id="20"><member type="way" ref="13" role="outer"/><member type="way" ref="14" role="outer"/><member type="way" ref="10" role="inner"/>' + "".join(f'<tag k="{k}" v="{v}"/>' for k, v in boundary.items()) + "</relation>"
    path = tmp_path / "m.osm"
    path.write_text("<?xml version='1.0'?>\n<osm>\n" + "\n".join([*nodes, *ways, relation]) + "\n</osm>\n")
    return str(path)


def test_areas(spark, tmp_path):
    path = osm_file(tmp_path)
    named = {r.polygon_id: r.name for r in osm.named_areas(spark, path).collect()}
    assert named == {"way/10": "Tower", "way/11": None, "way/15": "Elm Row", "way/16": "Broken", "relation/20": "Norland"}
    found = osm.areas(spark, path, "m")
    rows = {r.polygon_id: r for r in found.collect()}
    assert rows["m/way/10"].aliases == ["Tower", "La Tour"] and rows["m/way/10"].centroid == (1.5, 1.5)
    assert len(rows["m/relation/20"].geometry) == 1 and len(rows["m/relation/20"].geometry[0]) == 2
    assert rows["m/way/16"].geometry is None
    assert tuple(osm.area_counts(found).first()) == (4, 1, 1)
    inside = gazetteer.within_boundary(found, "norland")
    assert sorted(r.polygon_id for r in inside.collect()) == ["m/relation/20"]  # the tower fills the hole
    with pytest.raises(ValueError):
        gazetteer.within_boundary(found, "elsewhere")


def test_documents(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(7, "t", None), (8, None, "u")], "id long, text string, url string").coalesce(1).write.parquet(path)
    assert [tuple(r) for r in tables.read_documents(spark, path).drop("shard").orderBy("row_index").collect()] == [(0, "7", "t", ""), (1, "8", "", "u")]
    spark.createDataFrame([("t",)], "text string").write.parquet(f"{path}2")
    with pytest.raises(ValueError, match="url"):
        tables.read_documents(spark, f"{path}2")
    assert [(r.chunk, r.first_row, r["rows"]) for r in tables.row_ranges(spark, path, 1).orderBy("chunk").collect()] == [(0, 0, 1), (1, 1, 1)]


def test_json_rows(spark, tmp_path):
    path = str(tmp_path / "j")
    tables.write_json_rows(spark.createDataFrame([(1, None, "é")], "b int, a string, c string"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ['{"a":null,"b":1,"c":"é"}']
    assert tables.read_json_rows(spark, path, "b int, c string").first() == (1, "é")
    (tmp_path / "bad.jsonl").write_text('{"b":1}\n\n')
    with pytest.raises(Exception, match="JSON object"):
        tables.read_json_rows(spark, str(tmp_path / "bad.jsonl"), "b int").collect()
    with pytest.raises(Exception, match="JSON object"):
        tables.read_json_rows(spark, str(tmp_path / "bad.jsonl")).collect()
    assert tables.read_json_rows(spark, path).first() == (None, 1, "é")


def test_vocabulary_file_and_sources(spark, tmp_path):
    from geoweave.operators.topics import CONTRACT

    (tmp_path / "v.json").write_text(json.dumps({"version": "1", "language": "en", "matching": CONTRACT, "categories": {"a": ["x"]}}))
    assert tables.read_vocabulary(spark, str(tmp_path / "v.json")).categories == {"a": ["x"]}
    (tmp_path / "w.json").write_text("{")
    with pytest.raises(ValueError):
        tables.read_vocabulary(spark, str(tmp_path / "w.json"))
    tables.write_by_source(spark.createDataFrame([("a", 1)], "source_key string, x int"), str(tmp_path / "out"), ["a", "b"])
    assert tables.read_source(spark, str(tmp_path / "out"), "b").count() == 0 and tables.read_source(spark, str(tmp_path / "out"), "a").collect() == [(1,)]


def test_manifest(spark, tmp_path):
    path, calls = str(tmp_path / "m"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert manifest.produce(spark, path, {"a": 1}, build)[1] is False
    rows, reused = manifest.produce(spark, path, {"a": 1}, build)
    assert reused and rows.count() == 3 and len(calls) == 1
    with pytest.raises(ValueError):
        manifest.produce(spark, path, {"a": 2}, build)
    assert manifest.produce(spark, path, {"a": 2}, build, conflict="rebuild")[1] is False and len(calls) == 2


def test_parts_resume_and_a_failed_rebuild_leaves_the_old_result(spark, tmp_path):
    path, made, events = str(tmp_path / "p"), [], []

    def part(n, fail=False):
        def build():
            if fail:
                raise OSError("lost")
            made.append(n)
            return spark.range(n)

        return build

    with pytest.raises(OSError):
        manifest.produce_parts(spark, path, {"a": 1}, {"x": part(1), "y": part(2, True)}, log=events.append)
    assert manifest.produce_parts(spark, path, {"a": 1}, {"x": part(1), "y": part(2)}, log=events.append).count() == 3 and made == [1, 2]
    assert [e["event"] for e in events] == ["begin", "complete", "begin", "failed", "begin", "skipped", "begin", "complete"]
    with pytest.raises(OSError):
        manifest.produce(spark, f"{path}/part=x", {"a": 2}, part(1, True), conflict="rebuild")
    assert manifest.produce(spark, f"{path}/part=x", {"a": 1, "part": "x"}, part(9))[1] is True


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    p = profiles(spark, "Quillbury")
    find = lambda batch: retrieval.evidence(batch, p, rule="text", context="Norland").drop("normalized_name")
    whole = docs(spark, ("Quillbury by Norland", ""), ("no", ""))
    spark.createDataFrame([], "row_index long, document_id string, text string, url string").write.parquet(source)
    assert scan_new_files(spark, source, target + "0", {"rule": "text"}, find).count() == 0
    for n in (1, 2, 2):
        if n != 2 or spark.read.parquet(source).count() < 4:
            whole.write.mode("append").parquet(source)
        assert scan_new_files(spark, source, target, {"rule": "text"}, find).count() == n


def test_fingerprints_of_large_files_follow_their_content(spark, tmp_path):
    import shutil

    def written(rows, name, parts=1):
        path = tmp_path / name
        spark.createDataFrame(rows, "a long, b string, c map<string,binary>").coalesce(1).write.parquet(str(path / "w"))
        part = next(p for p in (path / "w").iterdir() if p.name.startswith("part-"))
        shutil.copy(part, path / "one.parquet")
        shutil.rmtree(path / "w")
        return str(path)

    rows = [(n, None if n % 5 == 0 else f"t{n}", {"k": bytes([n])}) for n in range(50)]
    of = lambda path: tables.fingerprint(spark, path, max_hashed_bytes=10)
    first = of(written(rows, "x"))
    assert of(written(rows, "y")) == first != tables.fingerprint(spark, str(tmp_path / "x"))
    changed = [*rows[:7], (7, "t8", {"k": b"7"}), *rows[8:]]
    swapped = [rows[1], rows[0], *rows[2:]]
    assert len({first, of(written(changed, "c")), of(written(swapped, "s")), of(written(rows[:-1], "l")), of(written([*rows, rows[-1]], "d"))}) == 5
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    assert of(str(tmp_path / "x")) == first
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fingerprints_of_large_map_files(spark, tmp_path):
    from geoweave.sources import pbf

    found = []
    for n in (1, 2, 1):
        nodes = spark.createDataFrame([(i, {"lon": float(i), "lat": float(i * n)}) for i in range(40)], pbf.NODE)
        path = tmp_path / f"{len(found)}"
        pbf.write(nodes.coalesce(1), spark.createDataFrame([], pbf.WAY), spark.createDataFrame([], pbf.RELATION), str(path / "w"))
        part = max((p for p in (path / "w").iterdir() if p.name.startswith("part-")), key=lambda p: p.stat().st_size)
        part.rename(path / "m.osm.pbf")
        import shutil

        shutil.rmtree(path / "w")
        found.append(tables.fingerprint(spark, str(path), max_hashed_bytes=10))
    assert found[0] == found[2] != found[1]


def test_catalog_drift(tmp_path, capsys):
    for options, name in ((["--json"], "c.json"), ([], "c.md")):
        assert cli.main(["catalog", *options]) == 0
        (tmp_path / name).write_text(capsys.readouterr().out)
        assert cli.main(["catalog", *options, "--check", str(tmp_path / name)]) == 0
        (tmp_path / name).write_text("old")
        assert cli.main(["catalog", *options, "--check", str(tmp_path / name)]) == 2
    assert cli.main(["catalog", "--check", str(tmp_path / "none")]) == 2 and "error:" in capsys.readouterr().err


def test_catalog_and_command_line(spark, tmp_path, capsys):
    assert versions.catalog(spark).count() == 22 and versions.catalog_record()["lines"][1]["latest"] == "v3" and "| v10 |" in versions.catalog_page()
    assert cli.main([]) == 0 and cli.main(["catalog"]) == 0
    path = str(tmp_path / "d")
    spark.createDataFrame([("Tower by Norland", "u")], "text string, url string").write.parquet(path)
    args = ["scan", "--documents", path, "--areas", osm_file(tmp_path), "--output", str(tmp_path / "o"), "--country", "Norland", "--version"]
    for reused in (False, True):
        capsys.readouterr()
        assert cli.main([*args, "v4"], spark) == 0
        assert json.loads(capsys.readouterr().out)["reused"] is reused
    assert cli.main([*args, "v9"], spark) == 2 and "error:" in capsys.readouterr().err
