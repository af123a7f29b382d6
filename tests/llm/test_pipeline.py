"""The pipeline's stages against what each must keep, on the real tables."""

import pytest

import corpus_pipeline
from strataflow.llm import queries
from strataflow.llm.secret_scan import find_secrets, masked


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append((name, docs))
    return {name: {r["doc_id"]: r for r in df.collect()} for name, df in seen}, dict(seen)


def test_columns(stages):
    _, frames = stages
    first = frames["documents"].columns
    assert all(df.columns == first for name, df in frames.items() if name != "source_mixing")
    assert set(first) <= set(frames["source_mixing"].columns)


def test_toxic_documents_go(spark, sf_dir, stages):
    rows, _ = stages
    predicted = {r["doc_id"]: r["predicted"] for r in queries.op3_toxicity(spark, sf_dir).collect()}
    assert set(rows["toxicity"]) == {i for i, p in predicted.items() if not p}


def test_one_of_each_group_stays(spark, stages):
    rows, frames = stages
    found = {r["doc_id"]: r["component_id"] for r in queries.near_duplicates(frames["toxicity"]).collect()}
    assert set(rows["simhash_near_dedup"]) == {i for i, c in found.items() if i == c}


def test_benchmark_goes(sf_dir, spark, stages):
    rows, frames = stages
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = rows["benchmark_decontamination"]
    assert not any(t in r["text"] for r in left.values() for t in items)
    gone = set(rows["simhash_near_dedup"]) - set(left)
    assert gone and all(any(t[:40] in rows["documents"][i]["text"] for t in items) for i in gone)


def test_secrets_are_masked_and_documents_stay(stages):
    rows, _ = stages
    before, after = rows["benchmark_decontamination"], rows["secret_scans"]
    assert set(before) == set(after)
    for i, r in after.items():
        want = masked(before[i]["text"], find_secrets(before[i]["text"])[1])
        assert r["text"] == want and r["n_chars"] == len(want) and r["source"] == before[i]["source"]
    assert any(before[i]["text"] != after[i]["text"] for i in after)


def test_mix(stages):
    rows, _ = stages
    last = rows["source_mixing"]
    assert set(last) <= set(rows["secret_scans"]) and all(1 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in last.values())
    for source in {r["source"] for r in last.values()}:
        mine = [r for r in last.values() if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) < 0.05 * mine[0]["target"], source


def test_run_is_the_stages_in_order(spark, sf_dir, stages):
    rows, _ = stages
    got = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"]: (r["text"], r["copies"]) for r in got.collect()} == {i: (r["text"], r["copies"]) for i, r in rows["source_mixing"].items()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "source_mixing"]
