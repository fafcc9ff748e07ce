import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from filedrop.llm.quality_cnn import ACCEPT, fit, with_score

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and [s for s, _ in corpus_pipeline.STAGES][0] == "quality_classifier"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A small corpus with junk, copies, a benchmark item and an address, and columns named like results."""
    root = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(1)
    text = lambda: ". ".join(" ".join(f"w{rng.randint(0, 3000)}" for _ in range(12)) for _ in range(8)) + "."
    rows = [[i, text()] for i in range(260)]
    for i in range(0, 100, 4):
        rows[i][1] = rows[i][1].replace(" ", "*** ")
    rows += [[300, rows[1][1]], [301, rows[1][1].replace("w1", "q1", 1)], [302, text() + " mail me@x.org"], [5, rows[5][1]],
             [303, None], [None, text()]]
    item = " ".join(f"b{i}" for i in range(20))
    rows.append([304, text() + " " + item])
    docs = [(*r, "en", ["a", "b", None][k % 3], len(r[1] or ""), "x") for k, r in enumerate(rows)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, taken string"
    spark.createDataFrame(docs, schema).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(not (i < 100 and i % 4 == 0)), 0) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_every_stage_takes_effect(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, planted)
        if name != "source_mixing":
            assert out.columns == docs.columns
        path = f"{planted}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    ids = {name: [r["doc_id"] for r in rows] for name, rows in seen.items()}
    judged = with_score(spark.read.parquet(f"{planted}/documents.parquet"), fit(
        spark.read.parquet(f"{planted}/documents.parquet"), spark.read.parquet(f"{planted}/labels.parquet")), "s")
    assert len(seen["quality_classifier"]) == judged.filter(f"s >= {ACCEPT}").count()
    assert not set(range(0, 100, 4)) & set(ids["quality_classifier"])
    kept = ids["minhash_near_dedup"]
    assert 1 in kept and 300 not in kept and 301 not in kept and kept.count(5) == 1
    assert set(ids["quality_classifier"]) - {300, 301} == set(kept)
    assert set(ids["minhash_near_dedup"]) - {304} == set(ids["benchmark_decontamination"])
    assert sorted(ids["pii"], key=str) == sorted(ids["benchmark_decontamination"], key=str)
    clean = {r["doc_id"]: r for r in seen["pii"]}
    assert clean[302]["text"].endswith("[EMAIL]") and clean[302]["n_chars"] == len(clean[302]["text"])
    final = seen["source_mixing"]
    assert all(0 < r["taken"] <= 2 * r["size"] for r in final)
    sizes = sum(len((r["text"] or "").split()) for r in seen["pii"])
    assert sum(r["taken"] for r in final) == pytest.approx(1.5 * sizes, rel=0.02)


def test_mix_holds_the_words_that_are_taken(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    final = corpus_pipeline.mixed(spark, docs, planted).collect()
    assert all(len(r["text"].split()) == r["taken"] and r["n_chars"] == len(r["text"]) for r in final)
    for source in ("a", "b", None):
        mine = [r for r in final if r["source"] == source]
        assert sum(len(r["text"].split()) for r in mine) == pytest.approx(mine[0]["target"], abs=16)


def test_run_equals_its_stages(spark, planted):
    again = corpus_pipeline.run(spark, planted)
    assert {(r["doc_id"], r["taken"]) for r in again.collect()} == {
        (r["doc_id"], r["taken"]) for r in spark.read.parquet(f"{planted}/source_mixing").collect()}


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
