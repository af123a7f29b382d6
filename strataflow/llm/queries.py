"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import crc_mod, table
from strataflow.llm.cover_tree import top_k
from strataflow.llm.decontaminate import contaminated
from strataflow.llm.html_extract import extract, train_labeller
from strataflow.llm.mixing import copies
from strataflow.llm.orchard import clusters
from strataflow.llm.pii import KINDS as PERSONAL
from strataflow.llm.pii import scan_personal_data, train_tagger
from strataflow.llm.quality import score_quality, train_quality
from strataflow.llm.runs import periodic_runs, run_digest, with_planted_runs
from strataflow.llm.secret_scan import digest_columns, scan
from strataflow.llm.simhash import near_duplicates
from strataflow.llm.sketch import fingerprint_documents
from strataflow.llm.toxicity import score_toxicity, train_toxicity
from strataflow.llm.url_filter import judge, train_url_model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Usable vectors as whole numbers, for the SQL of the vector queries.
WHOLE = """
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
"""


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def scored(docs: DataFrame, parts: int, rest: int, limit: float) -> DataFrame:
    """The columns that the classifier queries share; rows without an id aren't held out."""
    held_out = F.coalesce(crc_mod(F.col("doc_id"), parts) == rest, F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs, table(spark, sf_dir, "labels"), usable=crc_mod(F.col("doc_id"), 4) != 2)
    return scored(score_quality(docs, model), 4, 2, 0.7)


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), usable=crc_mod(F.col("doc_id"), 5) != 0)
    return scored(score_toxicity(docs, model), 5, 0, 0.5)


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select("doc_id", *digest_columns(("assign", "access", "hex")))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, train_url_model(pages)).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, train_labeller(pages)).select("page_id", "url", "text", "n_chars")


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_personal_data(docs, train_tagger(docs)).select("doc_id", *digest_columns(PERSONAL))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "containment", "same_values")


@query
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic_runs(docs).select("doc_id", *run_digest())


@query
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


SQL["op12_exact_top_k"] = f"""
WITH rows AS MATERIALIZED ({WHOLE}),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM rows q JOIN rows d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, size=64, salt="2:")


def clusters_sql(k: int, rounds: int) -> str:
    """The rounds written out, each an assignment to the centroids ``c<i>`` and their new means."""
    nearest = """SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
      SELECT vec_id, x.v, c, CAST(list_sum(list_transform(list_zip(x.v, y.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
      FROM kept x CROSS JOIN c{i} y) GROUP BY vec_id, v"""
    steps = [f"kept AS MATERIALIZED (SELECT * FROM ({WHOLE}) WHERE len(v) = 64)"]
    first = "SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept"
    steps.append(f"c0 AS MATERIALIZED (SELECT c, v FROM ({first}) WHERE c < {k})")
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(i=i)})")
        parts = f"SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}"
        sums = f"SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM ({parts}) GROUP BY c, i"
        means = f"SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM ({sums}) GROUP BY c"
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN ({means}) m USING (c))")
    steps.append(f"last AS MATERIALIZED ({nearest.format(i=rounds)})")
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(o.v, ',')) AS centroid_sha256
    FROM last JOIN c{rounds} o USING (c)"""


SQL["op13_centroid_clusters"] = clusters_sql(40, 5)
