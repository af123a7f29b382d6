"""Queries for the cleaning operators. The tables are clean, so dirt is injected by the
same expression here and in the SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.catalogue.registry import as_of, query, table
from strataflow.functions import require_not_null, to_double, trim_columns
from strataflow.operators import dedup, persisted, preview, profile_counts, profile_duplicates, profile_nulls
from strataflow.plans import CleanSpec, clean

IDENTITY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
KEYS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _null_flag() -> Column:
    return F.when(F.col("l_orderkey") % 17 != 0, F.col("l_returnflag"))


@query(
    "q05_require_not_null",
    """
    WITH raw AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
      CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_returnflag END AS returnflag,
      CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 29 = 0 THEN CAST('NaN' AS DOUBLE)
           ELSE l_quantity END AS quantity
      FROM lineitem)
    SELECT * FROM raw WHERE returnflag IS NOT NULL AND quantity IS NOT NULL
    """,
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey")
    quantity = F.when(part % 23 == 0, None).when(part % 29 == 0, float("nan")).otherwise(F.col("l_quantity"))
    raw = table(spark, sf_dir, "lineitem").select(
        *IDENTITY, _null_flag().alias("returnflag"), quantity.alias("quantity")
    )
    return require_not_null(raw, ["returnflag", "quantity"])


@query(
    "q06_trim_columns",
    "SELECT c_custkey, trim('  ' || c_mktsegment || ' ') AS segment, trim('   ') AS blank FROM customer",
)
def trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("segment"), F.lit("   ").alias("blank")
    )
    return trim_columns(padded, ["segment", "blank"])


@query(
    "q07_to_double",
    """
    SELECT p_partkey, TRY_CAST(CASE WHEN p_partkey % 5 = 0 THEN 'bad' WHEN p_partkey % 5 = 1 THEN ''
      WHEN p_partkey % 5 = 2 THEN ' ' || CAST(p_size AS VARCHAR) || ' '
      WHEN p_partkey % 5 = 3 THEN CAST(p_size AS VARCHAR) || 'e1'
      ELSE CAST(p_size AS VARCHAR) || '.25' END AS DOUBLE) AS v FROM part
    """,
)
def doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    text = (
        F.when(kind == 0, "bad")
        .when(kind == 1, "")
        .when(kind == 2, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(kind == 3, F.concat(size, F.lit("e1")))
        .otherwise(F.concat(size, F.lit(".25")))
    )
    return to_double(table(spark, sf_dir, "part").select("p_partkey", text.alias("v")), ["v"])


@query(
    "q08_dedup_first",
    """
    SELECT * FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus
      ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
    """,
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "lineitem"), KEYS, ORDER)


@query(
    "q09_dedup_any_keys",
    "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem",
)
def dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "lineitem"), KEYS, keep="any").select(KEYS)


LINE_SPEC = CleanSpec(
    not_null=("returnflag", "quantity"),
    trim=("returnflag", "linestatus"),
    to_double=("quantity", "discount", "tax"),
    dedup_keys=("quantity", "discount", "tax", "returnflag", "linestatus"),
    dedup_order=tuple(ORDER),
)


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    padded = F.concat(F.lit(" "), "l_returnflag", F.lit(" "))
    return table(spark, sf_dir, "lineitem").select(
        *IDENTITY,
        "l_shipdate",
        F.when(order % 17 == 0, None).when(order % 13 == 0, "  ").otherwise(padded).alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
        F.when(part % 23 == 0, None)
        .when(part % 19 == 0, "bad")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("quantity"),
        F.col("l_discount").cast("string").alias("discount"),
        F.col("l_tax").cast("string").alias("tax"),
    )


@query(
    "q10_silver_clean",
    """
    WITH raw AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate,
      CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN '  '
           ELSE ' ' || l_returnflag || ' ' END AS returnflag,
      l_linestatus AS linestatus,
      CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 'bad'
           ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
      CAST(l_discount AS VARCHAR) AS discount, CAST(l_tax AS VARCHAR) AS tax FROM lineitem),
    c AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate,
      trim(returnflag) AS returnflag, trim(linestatus) AS linestatus, TRY_CAST(quantity AS DOUBLE) AS quantity,
      TRY_CAST(discount AS DOUBLE) AS discount, TRY_CAST(tax AS DOUBLE) AS tax,
      TIMESTAMP '2024-01-01 00:00:00' AS processed_at
      FROM raw WHERE returnflag IS NOT NULL AND quantity IS NOT NULL)
    SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY quantity, discount, tax, returnflag, linestatus
      ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
    """,
)
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(dirty_lines(spark, sf_dir), LINE_SPEC, as_of())


@query(
    "q16_profile_nulls",
    """
    SELECT 'returnflag' AS col, count(*) FILTER (WHERE l_orderkey % 17 = 0) AS n_null FROM lineitem
    UNION ALL SELECT 'quantity', count(*) FILTER (WHERE l_partkey % 23 = 0) FROM lineitem
    UNION ALL SELECT 'linestatus', count(*) FILTER (WHERE l_linestatus IS NULL) FROM lineitem
    """,
)
def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_nulls(dirty_lines(spark, sf_dir), ["returnflag", "quantity", "linestatus"])


@query(
    "q17_profile_duplicates",
    "SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang HAVING count(*) > 1",
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_duplicates(table(spark, sf_dir, "documents"), ["text", "lang"])


@query(
    "q18_profile_counts",
    """
    SELECT 'lineitem' AS tbl, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'events', count(*) FROM events
    """,
)
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_counts({name: table(spark, sf_dir, name) for name in ("lineitem", "orders", "events")})


@query(
    "q19_preview",
    "SELECT * FROM events ORDER BY event_id LIMIT 10",
)
def first_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "events"), ["event_id"], 10)


@query(
    "q47_persisted",
    """
    SELECT 'orders' AS what, count(*) AS n FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
    UNION ALL SELECT 'customers', count(DISTINCT o_custkey) FROM orders
      WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
    """,
)
def persisted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two figures of one kept frame."""
    orders = table(spark, sf_dir, "orders")
    mean = orders.agg(F.avg("o_totalprice")).scalar()
    with persisted(orders.where(F.col("o_totalprice") > mean).select("o_custkey")) as dear:
        n = dear.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        customers = dear.agg(F.count_distinct("o_custkey").alias("n")).first()["n"]
    return spark.range(1).select(F.explode(F.lit([0, 1])).alias("k")).select(
        F.when(F.col("k") == 0, "orders").otherwise("customers").alias("what"),
        F.when(F.col("k") == 0, F.lit(n)).otherwise(F.lit(customers)).cast("bigint").alias("n"),
    )
