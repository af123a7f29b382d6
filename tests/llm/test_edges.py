"""Every query, operator and stage on nulls, empty and very long texts, repeats, clashing names and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataflow.llm import queries
from strataflow.llm.decontaminate import contaminated, drop_contaminated
from strataflow.llm.gbt import fit_isotonic, fit_trees
from strataflow.llm.html_extract import extract, fit_labeller, made_pages
from strataflow.llm.mixing import copies, mix
from strataflow.llm.pii import scan_personal_data
from strataflow.llm.quality import NAMES, QualityModel, score_quality
from strataflow.llm.runs import periodic_runs, with_planted_runs
from strataflow.llm.secret_scan import mask_secrets, scan
from strataflow.llm.simhash import drop_near_duplicates, near_duplicates
from strataflow.llm.sketch import fingerprint_documents, sketch_column
from strataflow.llm.toxicity import INSULTS, Lexicon, ToxicityModel, drop_toxic, score_toxicity
from strataflow.llm.url_filter import judge, train_url_model
from tests.llm.conftest import EXTRA, edge_rows

PER_DOCUMENT = [n for n in queries.QUERIES if n.split("_")[0] in "op1 op2 op3 op4 op7 op8 op10 op11".split()]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
@pytest.mark.parametrize("kind", ["edges", "empty"])
def test_query_on_edges(spark, edge_sf, kind, name):
    got = queries.QUERIES[name](spark, edge_sf[kind]).collect()
    if kind == "empty":
        assert got == []
    elif name in PER_DOCUMENT:
        assert len(got) == len(edge_rows())
    elif "op9" in name:
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(7, 1), (-7, 1)}
    elif "op12" in name:
        assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got if r["query_id"] == 0] == [(0, 1, None), (0, 2, 1), (0, 3, 1), (0, 4, 50)]
        assert len(got) == 8
    elif "op13" in name:
        assert sorted((r["vec_id"] or -1, r["distance"]) for r in got) == [(-1, 0), (-1, 0), (1, 0), (1, 0), (50, 0)]
    else:
        assert len(got) == 7


@pytest.fixture(scope="module")
def models():
    import numpy as np

    trees = fit_trees(np.zeros((0, 1)), np.zeros(0))
    return {
        "quality": QualityModel(trees),
        "toxicity": ToxicityModel(Lexicon(dict.fromkeys(INSULTS, 4.0), {}), trees, fit_isotonic(np.zeros(0), np.zeros(0))),
        "labeller": fit_labeller(made_pages(10), epochs=1),
    }


def operators(models, docs, spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string").withColumn("h", F.lit("x"))
    yield "size copies target taken doc_id", copies(docs)
    yield "size copies target taken text", mix(docs)
    yield "score text", score_quality(docs, models["quality"])
    yield "score text", score_toxicity(docs, models["toxicity"])
    yield "text n_chars", drop_toxic(docs, models["toxicity"])
    yield "base found text", scan(docs)
    yield "text n_chars", mask_secrets(docs)
    yield "base found", scan_personal_data(docs, None)
    yield "doc_id fingerprint component_id", near_duplicates(docs)
    yield "text n_chars", drop_near_duplicates(docs)
    yield "doc_id item_id", contaminated(docs, bench)
    yield "text n_chars", drop_contaminated(docs, bench)
    yield "doc_id fingerprint near_next", fingerprint_documents(docs)
    yield "fingerprint text", sketch_column(docs)
    yield "runs collapsed text", periodic_runs(with_planted_runs(docs))


@pytest.mark.parametrize("table", ["clashing", "no_docs"])
def test_operators_take_clashing_names_and_empty_tables(spark, models, request, table):
    docs = request.getfixturevalue(table)
    for names, out in operators(models, docs, spark):
        rows = out.collect()
        assert set(names.split()) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
        assert table == "clashing" or rows == []


def test_page_operators_take_clashing_names(spark, models, edge_sf):
    pages = spark.read.parquet(f"{edge_sf['edges']}/pages.parquet").withColumns({c: F.lit("x") for c in ("text", "host", "score", "rule", "n_chars")})
    assert extract(pages, models["labeller"]).count() == 7
    assert judge(pages, train_url_model(pages, made=40)).count() == 7


def test_stages_keep_columns_and_take_edges(spark, edge_sf, clashing, no_docs):
    for docs in (clashing, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, edge_sf["edges"])
            if name != "source_mixing":
                assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
            out.collect()


def test_scores_of_every_row(spark, edge_docs, models):
    rows = score_quality(edge_docs, models["quality"]).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in rows) and len(NAMES) == len(set(NAMES))


def test_extra_names_cover_results():
    assert {"score", "copies", "component_id", "fingerprint", "found"} <= set(EXTRA)
