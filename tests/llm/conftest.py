import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    """Deterministic words without any structure."""
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state >> 8 & 15] + WORDS[state >> 14 & 15])
    return " ".join(out)


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Every name that an operator makes, to clash with.
EXTRA = "score size target taken copies rep fingerprint component_id fp base found h x y host verdict part guest n m w level".split()


def edge_rows():
    texts = [
        None, "", "   \n\t ", "one", "two words", prose(1, 40), prose(1, 40), prose(2, 300), prose(3, 60_000), "é" * 50, "a" * 300_000,
        "you idiot, you stupid idiot " * 3, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "mail a.b@c.example.com or +1 (956) 555-1832",
        "𝄞 \U0001f600 " + prose(4, 30),
    ]
    rows = [(i, t, "en", ["s1", "s2", None, "S3"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "en", "s2", 1), (5, texts[5], "en", "s2", 1), (None, prose(5, 50), None, None, None), (None, None, None, None, None)]
    return rows + [(-7, prose(2, 300), "de", "s1", 10)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge_docs):
    """The same rows with extra columns, named like results and helpers."""
    from pyspark.sql import functions as F

    return edge_docs.select("*", *(F.lit(f"extra {c}").alias(c) for c in EXTRA))


@pytest.fixture(scope="session")
def real_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def edge_sf(spark, edge_docs, tmp_path_factory):
    """A folder of tables with nulls, repeats and clashing names, and one of empty tables."""
    from pyspark.sql import functions as F

    folders = {}
    for kind in ("edges", "empty"):
        d = str(tmp_path_factory.mktemp(kind))
        keep = "1 = 1" if kind == "edges" else "1 = 0"
        labels = [(i, q, t) for i in range(15) for q, t in [(i % 2, int(i == 11))]] + [(None, 1, 1), (3, None, None), (4, 1, 0), (99, 1, 1)]
        pages = [
            (1, "https://a.example.net/en/1", "<html><body><nav><a>x</a></nav><article><p>Some text.</p></article></body></html>"),
            (2, None, None), (3, "", ""), (None, "no scheme", "<<<>>> &amp; <p"), (1, "https://a.example.net/en/1", "<p>again"),
            (4, "ftp://ORG", "<p>x</p>" * 3000), (5, "http://x.org/fr/", "\0퟿" + "plain " * 50),
        ]
        benchmark = [(1, prose(2, 40)), (1, prose(2, 40)), (2, None), (3, ""), (None, prose(9, 30)), (4, "three short words")]
        spark.createDataFrame(edge_rows(), DOC_SCHEMA).where(keep).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").where(keep).write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame(pages, "page_id long, url string, html string").where(keep).write.parquet(f"{d}/pages.parquet")
        spark.createDataFrame(benchmark, "item_id long, text string").where(keep).write.parquet(f"{d}/benchmark.parquet")
        vectors = [(0, [0.1] * 64), (50, [-0.2] * 64), (1, [0.1] * 64), (1, [0.1] * 64), (2, None), (3, [None] * 64), (None, [0.3] * 64), (100, [float("nan")] * 64)]
        extra = {c: F.lit("x") for c in ("row", "score", "cluster")}
        vectors = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumns(extra)
        vectors.where(keep).write.parquet(f"{d}/embeddings.parquet")
        folders[kind] = d
    return folders
