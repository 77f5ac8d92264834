"""Keep-first over a stream: any split of files into batches, in any order, equals one run over all of them."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from geoweave.operators import retrieval
from geoweave.streaming.scan import DOCUMENTS, keep_first_of_new_files


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    """Files with documents that come twice in a file, in several files, with and without an id."""
    folder = tmp_path_factory.mktemp("first")
    rng = random.Random(3)
    texts = ["Quillbury by Norland", "Marlow and Quillbury in Norland", "Norland only", "Marlow, Norland"]
    for n in range(6):
        rows = [(i, rng.choice([None, "", f"d{rng.randrange(6)}"]), rng.choice(texts), f"u{rng.randrange(2)}") for i in range(14)]
        path = str(folder / f"w{n}")
        spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(path)
        part = next(p for p in (folder / f"w{n}").iterdir() if p.name.startswith("part-"))
        (folder / "all").mkdir(exist_ok=True)
        shutil.copy(part, folder / "all" / f"shard-{n}.parquet")
    return folder / "all"


def find(spark):
    profiles = spark.createDataFrame([("w/1", "Quillbury", "quillbury"), ("w/2", "Marlow", "marlow"), ("w/3", "Marlow", "marlow")], "polygon_id string, name string, normalized_name string")
    return lambda rows: retrieval.evidence(rows, profiles, rule="text", context="Norland")


def wanted(spark, folder, files):
    rows = spark.read.parquet(*[str(folder / f) for f in files]).select(F.col("_metadata.file_name").alias("shard"), "*")
    return sorted(map(tuple, retrieval.deduplicated(find(spark)(rows)).select("polygon_id", "shard", "row_index", "text", "url").collect()))


@pytest.mark.parametrize("order", [[[0, 1, 2, 3, 4, 5]], [[5], [3, 4], [0], [2, 1]]])
def test_any_split_equals_one_run(spark, shards, tmp_path, order):
    source, target, come = tmp_path / "in", str(tmp_path / "out"), []
    source.mkdir()
    for batch in order:
        for n in batch:
            shutil.copy(shards / f"shard-{n}.parquet", source / f"shard-{n}.parquet")
            come.append(f"shard-{n}.parquet")
        found = keep_first_of_new_files(spark, str(source), target, {"rule": "text"}, find(spark), files_per_batch=2)
        assert sorted(map(tuple, found.select("polygon_id", "shard", "row_index", "text", "url").collect())) == wanted(spark, shards, come)
    again = keep_first_of_new_files(spark, str(source), target, {"rule": "text"}, find(spark))
    assert again.count() == len(wanted(spark, shards, come))


def test_no_files(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "in"))
    assert keep_first_of_new_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), {}, find(spark)).count() == 0
