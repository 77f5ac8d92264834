"""The pipeline's stages against the operators' own brute-force rules, and its edges."""

from pyspark.sql import functions as F

import corpus_pipeline
from geoweave.llm import decontamination, packing, secrets, simhash, toxicity
from geoweave.llm.common import saved
from tests.llm.test_near_copies import brute_kept
from tests.llm.test_packing import PATH, check_packing


def test_each_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, sf_dir), "test")
        seen[name] = docs
        if name != "packing":
            assert docs.dtypes == before.dtypes
        rows = {r.doc_id: r.text for r in before.collect()} if name != "packing" else {}
        if name == "toxicity":
            model = toxicity.fit(before, labels)
            bad = {d for d, t in rows.items() if float(model.scores([toxicity.counts_of(model.grammar(), t)])[0]) >= 0.7}
            assert bad and {r.doc_id for r in docs.collect()} == set(rows) - bad
        if name == "simhash":
            assert sorted(r.doc_id for r in docs.collect()) == brute_kept(list(rows.items()))
        if name == "decontamination":
            report = decontamination.contamination_report(decontamination.find_contamination(before, benchmark))
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in report.where("not contaminated").collect())
        if name == "secrets":
            assert {r.doc_id: r.text for r in docs.collect()} == {d: secrets.redacted_text(t) for d, t in rows.items()}
            assert docs.where(F.length("text") != F.col("n_chars")).isEmpty()
    assert check_packing(seen["packing"].collect(), {r.doc_id: r.text for r in seen["secrets"].collect()}, 1024) == 0
    assert seen["packing"].columns == packing.pack(docs.limit(0).select("doc_id", F.lit("").alias("text")), PATH).drop("task", "row").columns


def test_odd_documents_pass_all_stages(spark, tmp_path):
    rows = [(1, "x y z", None, None, None), (1, "x y z", None, None, None), (2, None, "en", "s", None), (None, "token=abcdefghijklmnop ok", None, None, 25), (None, "token=abcdefghijklmnop ok", None, None, 25), (4, "you idiot", None, None, 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    for given, want in ((docs, [("1", "x y z", None), ("2", None, None), ("None", "[redacted assign] ok", 20)]), (docs.limit(0), [])):
        out = given.withColumns({"fp": F.lit(1), "times": F.lit(2), "kept": F.lit(3)})
        columns = out.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = saved(stage(spark, out, str(tmp_path)), "test")
            assert out.columns == columns
        assert sorted(((str(r.doc_id), r.text, r.n_chars) for r in out.collect()), key=str) == want
        assert corpus_pipeline.STAGES[-1][1](spark, out, str(tmp_path)).select("doc_id").distinct().count() == len(want)
        assert simhash.keep_one_of_each(out).count() == len(want)
