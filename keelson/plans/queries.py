"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with the
matching DuckDB SQL in ``ORACLE``.

Column names and types agree between the two sides; money sums are rounded
to 2 places.  Queries that run the stored pipeline (ingest, batch fold,
rerun) write under the session's shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelson.operators import marts
from keelson.plans import flows
from keelson.plans.oracle import AS_OF_SQL, with_ctes
from keelson.plans.oracle import _scd2_bulk as _scd2_bulk_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, whole: bool = False):
    """``whole``: the SQL stands as it is (it names its own CTEs)."""
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if whole else with_ctes(sql)
        return fn
    return deco


def _r2(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 2) for c in cols})


# ---------------------------------------------------------------- bronze --

@register("q_bronze_customers", """
SELECT customer_id, name, city, event_date, batch_key FROM bronze_customers""")
def q_bronze_customers(spark, sf):
    return flows.bronze(spark, sf, "customers").drop("_source_file")


@register("q_bronze_products", """
SELECT product_id, product_name, category, price, launch_date, batch_key FROM bronze_products""")
def q_bronze_products(spark, sf):
    return flows.bronze(spark, sf, "products").drop("_source_file")


@register("q_bronze_orders", """
SELECT order_id, customer_id, product_id, amount, order_date, batch_key FROM bronze_orders""")
def q_bronze_orders(spark, sf):
    return flows.bronze(spark, sf, "orders").drop("_source_file")


# ---------------------------------------------------------------- silver --

@register("q_clean_customers", "SELECT * FROM stg_customers")
def q_clean_customers(spark, sf):
    return flows.stg_customers(spark, sf)


@register("q_clean_products", "SELECT * FROM stg_products")
def q_clean_products(spark, sf):
    return flows.stg_products(spark, sf)


@register("q_clean_orders", "SELECT * FROM fact_orders")
def q_clean_orders(spark, sf):
    return flows.fact_orders(spark, sf)


@register("q_scd1_customers", "SELECT * FROM scd1_customers")
def q_scd1_customers(spark, sf):
    return flows.scd1_customers(spark, sf)


@register("q_scd2_customers_bulk", "SELECT * FROM scd2_customers")
def q_scd2_customers_bulk(spark, sf):
    return flows.scd2_customers(spark, sf)


@register("q_scd2_products_bulk", "SELECT * FROM scd2_products")
def q_scd2_products_bulk(spark, sf):
    return flows.scd2_products(spark, sf)


# ------------------------------------------------------------------ gold --

@register("q_sales_by_city", f"""
SELECT c.city, CAST(COUNT(f.order_id) AS BIGINT) AS total_orders,
       ROUND(SUM(f.amount), 2) AS total_amount, {AS_OF_SQL} AS update_date
FROM fact_orders f JOIN cur_customers c ON f.customer_id = c.customer_id
GROUP BY c.city""")
def q_sales_by_city(spark, sf):
    return _r2(flows.sales_by_city(spark, sf), "total_amount")


@register("q_sales_by_category", f"""
SELECT p.category, CAST(COUNT(f.order_id) AS BIGINT) AS total_orders,
       ROUND(SUM(f.amount), 2) AS total_amount,
       CAST(COUNT(DISTINCT f.product_id) AS BIGINT) AS unique_products,
       {AS_OF_SQL} AS update_date
FROM fact_orders f JOIN cur_products p ON f.product_id = p.product_id
GROUP BY p.category""")
def q_sales_by_category(spark, sf):
    return _r2(flows.sales_by_category(spark, sf), "total_amount")


@register("q_customer_ranking", """
SELECT customer_id, name, city, ROUND(total_amount, 2) AS total_amount,
       CAST(ROW_NUMBER() OVER (ORDER BY total_amount DESC, customer_id) AS INTEGER) AS ranking
FROM (SELECT f.customer_id, c.name, c.city, SUM(f.amount) AS total_amount
      FROM fact_orders f JOIN cur_customers c ON f.customer_id = c.customer_id
      GROUP BY f.customer_id, c.name, c.city) t
ORDER BY total_amount DESC, customer_id
LIMIT 100""")
def q_customer_ranking(spark, sf):
    return _r2(flows.customer_ranking(spark, sf, 100), "total_amount")


# ------------------------------------------------- stored pipeline runs --
# These run the batch-committed warehouse (see keelson.plans.stored).

from keelson.operators import governance, validate  # noqa: E402
from keelson.operators import scd as _scd  # noqa: E402
from keelson.plans import stored  # noqa: E402
from keelson.schemas import TABLES  # noqa: E402

_LATEST_STG = "(SELECT MAX(batch_key) FROM stg_customers)"


@register("q_scd2_customers", "SELECT * FROM scd2_customers")
def q_scd2_customers(spark, sf):
    """Type 2 customers folded batch by batch and stored (fold == bulk)."""
    return stored.full_run(spark, sf)["wh"].dim2("customers")


@register("q_scd2_products", "SELECT * FROM scd2_products")
def q_scd2_products(spark, sf):
    return stored.full_run(spark, sf)["wh"].dim2("products")


@register("q_scd2_customers_mixed", "SELECT * FROM scd2_customers")
def q_scd2_customers_mixed(spark, sf):
    """First wave applied in bulk, second wave folded on top."""
    return stored.staged_run(spark, sf)["wh"].dim2("customers")


@register("q_scd2_products_mixed", "SELECT * FROM scd2_products")
def q_scd2_products_mixed(spark, sf):
    return stored.staged_run(spark, sf)["wh"].dim2("products")


@register("q_scd1_customers_stored", "SELECT * FROM scd1_customers")
def q_scd1_customers_stored(spark, sf):
    """Type 1 customers after the batch-by-batch upserts (MERGE semantics)."""
    return stored.full_run(spark, sf)["wh"].dim1()


@register("q_stg_customers_latest", f"""
SELECT customer_id, name, city, event_date FROM stg_customers
WHERE batch_key = {_LATEST_STG}""")
def q_stg_customers_latest(spark, sf):
    return stored.full_run(spark, sf)["wh"].stg("customers")


@register("q_stg_products_latest", f"""
SELECT product_id, product_name, category, price, launch_date FROM stg_products
WHERE batch_key = {_LATEST_STG}""")
def q_stg_products_latest(spark, sf):
    return stored.full_run(spark, sf)["wh"].stg("products")


@register("q_fact_orders", "SELECT * FROM fact_orders")
def q_fact_orders(spark, sf):
    """The stored fact after two restatements (dynamic partition overwrite)."""
    return stored.full_run(spark, sf)["wh"].fact()


@register("q_fact_orders_incremental", "SELECT * FROM fact_orders")
def q_fact_orders_incremental(spark, sf):
    """The fact built from the first wave, then brought up to date with the
    second wave by rewriting only the partitions it touches."""
    return stored.staged_run(spark, sf)["wh"].fact()


@register("q_ingest_incremental", """
SELECT customer_id, name, city, event_date, batch_key FROM bronze_customers""")
def q_ingest_incremental(spark, sf):
    """Bronze customers after three ingests (two waves, then nothing new):
    every raw row exactly once."""
    b = stored.staged_run(spark, sf)["wh"].bronze("customers")
    return b.select("customer_id", "name", "city", "event_date", "batch_key")


@register("q_bronze_orders_stored", """
SELECT order_id, customer_id, product_id, amount, order_date, batch_key FROM bronze_orders""")
def q_bronze_orders_stored(spark, sf):
    b = stored.staged_run(spark, sf)["wh"].bronze("orders")
    return b.select("order_id", "customer_id", "product_id", "amount", "order_date", "batch_key")


@register("q_bronze_products_stored", """
SELECT product_id, product_name, category, price, launch_date, batch_key FROM bronze_products""")
def q_bronze_products_stored(spark, sf):
    b = stored.staged_run(spark, sf)["wh"].bronze("products")
    return b.select("product_id", "product_name", "category", "price", "launch_date",
                    "batch_key")


@register("q_pending_batches", f"""
SELECT DISTINCT batch_key FROM bronze_customers
WHERE batch_key > '{stored.WAVE_SPLIT}'""")
def q_pending_batches(spark, sf):
    """Batch keys that the second wave's Silver run found pending (run log)."""
    log = stored.staged_run(spark, sf)["wh"].run_log().where("item = 'pending'")
    newest = log.agg(F.max("at").alias("at"))
    return log.join(newest, "at", "left_semi").select(F.col("name").alias("batch_key"))


@register("q_batches", """
SELECT DISTINCT batch_key, CAST(batch_key || '-01' AS DATE) AS business_date
FROM bronze_customers WHERE batch_key <> ''""")
def q_batches(spark, sf):
    """All batch keys found in Bronze customers, with their business date."""
    from keelson.functions import business_date
    return (stored.full_run(spark, sf)["wh"].discover()
            .withColumn("business_date", business_date("batch_key")))


@register("q_batch_control", """
SELECT batch_key, CAST(1 AS BIGINT) AS times_processed
FROM (SELECT DISTINCT batch_key FROM bronze_customers WHERE batch_key <> '') b""")
def q_batch_control(spark, sf):
    """Each batch committed once, although the pipeline ran twice."""
    return validate.batch_control_report(stored.full_run(spark, sf)["wh"].control())


@register("q_pipeline_rerun_noop", """
SELECT 'applied_on_rerun' AS item, CAST(0 AS BIGINT) AS n
UNION ALL SELECT 'ingested_on_rerun', CAST(0 AS BIGINT)
UNION ALL SELECT 'dim_customers_versions', COUNT(*) FROM scd2_customers
UNION ALL SELECT 'dim_products_versions', COUNT(*) FROM scd2_products""")
def q_pipeline_rerun_noop(spark, sf):
    """What the run log holds of the second run, and the dimensions' sizes."""
    wh = stored.full_run(spark, sf)["wh"]
    log = wh.run_log()
    applied = (log.where("item = 'batches' and name = 'applied'")
               .agg(F.max_by("n", "at").alias("n")).select(F.lit("applied_on_rerun").alias("item"), "n"))
    ingested = (log.where("item = 'ingested'").groupBy("name").agg(F.max_by("n", "at").alias("n"))
                .agg(F.sum("n").alias("n")).select(F.lit("ingested_on_rerun").alias("item"), "n"))
    dims = [wh.dim2(e).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(f"dim_{e}_versions").alias("item"), "n")
            for e in ("customers", "products")]
    return applied.unionByName(ingested).unionByName(dims[0]).unionByName(dims[1])


_GOLD_COUNTS = {
    "gold_agg_sales_by_city": "SELECT COUNT(DISTINCT c.city) FROM fact_orders f "
                              "JOIN cur_customers c ON f.customer_id = c.customer_id",
    "gold_agg_sales_by_category": "SELECT COUNT(DISTINCT p.category) FROM fact_orders f "
                                  "JOIN cur_products p ON f.product_id = p.product_id",
    "gold_ranking_customers": "SELECT LEAST(100, COUNT(DISTINCT f.customer_id)) FROM "
                              "fact_orders f JOIN cur_customers c "
                              "ON f.customer_id = c.customer_id",
}
_TABLE_COUNT_SQL = {
    "bronze_raw_customers": "SELECT COUNT(*) FROM raw_customers",
    "bronze_raw_orders": "SELECT COUNT(*) FROM raw_orders",
    "bronze_raw_products": "SELECT COUNT(*) FROM raw_products",
    "silver_stg_customers": f"SELECT COUNT(*) FROM stg_customers WHERE batch_key = {_LATEST_STG}",
    "silver_stg_products": f"SELECT COUNT(*) FROM stg_products WHERE batch_key = {_LATEST_STG}",
    "silver_dim_customers_type1": "SELECT COUNT(*) FROM scd1_customers",
    "silver_dim_customers_type2": "SELECT COUNT(*) FROM scd2_customers",
    "silver_dim_products_type2": "SELECT COUNT(*) FROM scd2_products",
    "silver_fact_orders": "SELECT COUNT(*) FROM fact_orders",
    **_GOLD_COUNTS,
}


@register("q_row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(({q}) AS BIGINT) AS row_count"
    for t, q in _TABLE_COUNT_SQL.items()))
def q_row_counts(spark, sf):
    """Row counts of the 12 warehouse tables (control table left out)."""
    wh = stored.full_run(spark, sf)["wh"]
    return validate.row_counts({t: wh.table(t) for t in _TABLE_COUNT_SQL})


@register("q_observed_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(({q}) AS BIGINT) AS rows_written"
    for t, q in _TABLE_COUNT_SQL.items()
    if t.startswith(("bronze", "gold")) or t == "silver_fact_orders"))
def q_observed_counts(spark, sf):
    """Rows written, as observed during the writes themselves (no recount)."""
    log = stored.full_run(spark, sf)["wh"].run_log()
    return (log.where(F.col("item").isin("ingested", "fact", "gold"))
            .groupBy(F.col("name").alias("table_name")).agg(F.sum("n").alias("rows_written")))


@register("q_table_roundtrip", """
SELECT customer_id, name, city, ROUND(total_amount, 2) AS total_amount,
       CAST(ROW_NUMBER() OVER (ORDER BY total_amount DESC, customer_id) AS INTEGER) AS ranking
FROM (SELECT f.customer_id, c.name, c.city, SUM(f.amount) AS total_amount
      FROM fact_orders f JOIN cur_customers c ON f.customer_id = c.customer_id
      GROUP BY f.customer_id, c.name, c.city) t
ORDER BY total_amount DESC, customer_id
LIMIT 100""")
def q_table_roundtrip(spark, sf):
    """A declared catalog table: created twice (IF NOT EXISTS), overwritten
    twice by insertInto, read back by name."""
    import uuid
    from keelson.session import scratch_path
    from keelson.sinks.tables import ensure_table, insert_overwrite
    wh = stored.full_run(spark, sf)["wh"]
    name = f"keelson_gold.ranking_{uuid.uuid4().hex[:8]}"
    schema = TABLES["gold_ranking_customers"][0]
    loc = scratch_path(spark, "catalog")
    for _ in range(2):
        ensure_table(spark, name, schema, location=loc)
    src = wh.table("gold_ranking_customers")
    for _ in range(2):
        insert_overwrite(src, name)
    return _r2(spark.table(name), "total_amount")


_AFTER_SQL = f"""
SELECT 'customers' AS dim, upto AS batch_key, CAST(customer_id AS VARCHAR) AS id, city AS attribute,
       valid_from, valid_to, is_current FROM ({_scd2_bulk_sql("customers_upto", "customer_id, upto",
       ["name", "city"], "event_date")}) c
UNION ALL
SELECT 'products', upto, product_id, category, valid_from, valid_to, is_current
FROM ({_scd2_bulk_sql("products_upto", "product_id, upto", ["product_name", "category", "price"],
       "CAST(batch_key || '-01' AS DATE)")}) p
UNION ALL
SELECT 'customers_type1', upto, CAST(customer_id AS VARCHAR), city, event_date, NULL, TRUE
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, upto ORDER BY batch_key DESC) AS rn
      FROM customers_upto) t WHERE rn = 1"""


@register("q_dim_after_each_batch", _AFTER_SQL)
def q_dim_after_each_batch(spark, sf):
    """The state of all three dimensions after each of the batches, of which
    the first were applied in one bulk commit and the others folded."""
    return _after_each_batch(stored.staged_run(spark, sf)["wh"])


def _after_each_batch(wh) -> DataFrame:
    bks, at = wh.committed(), F.col("as_of").alias("batch_key")
    two = [wh.dim2_each(e, bks).select(
        F.lit(e).alias("dim"), at, F.col(key).cast("string").alias("id"),
        F.col(attr).alias("attribute"), "valid_from", "valid_to", "is_current")
        for e, key, attr in (("customers", "customer_id", "city"), ("products", "product_id", "category"))]
    one = wh.dim1_each(bks).select(
        F.lit("customers_type1").alias("dim"), at, F.col("customer_id").cast("string").alias("id"),
        F.col("city").alias("attribute"), F.col("update_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    return two[0].unionByName(two[1]).unionByName(one)


@register("q_scd2_after_stops", """
SELECT 'customers' AS dim, CAST(customer_id AS VARCHAR) AS id, city AS attribute, valid_from,
       valid_to, is_current FROM scd2_customers
UNION ALL
SELECT 'products', product_id, category, valid_from, valid_to, is_current FROM scd2_products""")
def q_scd2_after_stops(spark, sf):
    """Both Type 2 dimensions after runs that stopped in every step and were rerun."""
    wh = stored.stopped_run(spark, sf)["wh"]
    each = [wh.dim2(e).select(F.lit(e).alias("dim"), F.col(k).cast("string").alias("id"),
                              F.col(a).alias("attribute"), "valid_from", "valid_to", "is_current")
            for e, k, a in (("customers", "customer_id", "city"),
                            ("products", "product_id", "category"))]
    return each[0].unionByName(each[1])


@register("q_fact_orders_after_stops", "SELECT * FROM fact_orders")
def q_fact_orders_after_stops(spark, sf):
    """The fact after runs that stopped while rewriting it and were rerun."""
    return stored.stopped_run(spark, sf)["wh"].fact()


# ------------------------------------------- late rows, types, rewrites --

@register("q_late_rows", f"""
SELECT 'customers' AS entity, batch_key, COUNT(*) AS n FROM bronze_customers
WHERE batch_key = '{stored.LATE_CUSTOMERS}' AND TRY_CAST(customer_id AS BIGINT) % 7 = 3 GROUP BY batch_key
UNION ALL
SELECT 'products', batch_key, COUNT(*) FROM bronze_products
WHERE batch_key = '{stored.LATE_PRODUCTS}' AND TRY_CAST(substring(product_id, 2) AS BIGINT) % 6 = 2
GROUP BY batch_key""")
def q_late_rows(spark, sf):
    """Rows that came for a batch after its commit, as recorded per file."""
    rows = stored.late_run(spark, sf)["wh"].late_rows()
    return rows.groupBy("entity", "batch_key").agg(F.sum("n").alias("n"))


@register("q_scd2_after_late_file", """
SELECT 'customers' AS dim, CAST(customer_id AS VARCHAR) AS id, city AS attribute, valid_from,
       valid_to, is_current FROM scd2_customers
UNION ALL
SELECT 'products', product_id, category, valid_from, valid_to, is_current FROM scd2_products
UNION ALL
SELECT 'customers_type1', CAST(customer_id AS VARCHAR), city, update_date, NULL, TRUE FROM scd1_customers""")
def q_scd2_after_late_file(spark, sf):
    """The dimensions after late rows of two old batches were replayed for their keys
    and a further batch was folded: equal to a build of all rows in order."""
    wh = stored.late_run(spark, sf)["wh"]
    each = [wh.dim2(e).select(F.lit(e).alias("dim"), F.col(k).cast("string").alias("id"),
                              F.col(a).alias("attribute"), "valid_from", "valid_to", "is_current")
            for e, k, a in (("customers", "customer_id", "city"),
                            ("products", "product_id", "category"))]
    one = wh.dim1().select(F.lit("customers_type1").alias("dim"), F.col("customer_id").cast("string").alias("id"),
                           F.col("city").alias("attribute"), F.col("update_date").alias("valid_from"),
                           F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    return each[0].unionByName(each[1]).unionByName(one)


@register("q_dim_after_late_file", _AFTER_SQL)
def q_dim_after_late_file(spark, sf):
    """As q_dim_after_each_batch, where some rows of two batches came late."""
    return _after_each_batch(stored.late_run(spark, sf)["wh"])


@register("q_orders_mixed_types", "SELECT * FROM fact_orders")
def q_orders_mixed_types(spark, sf):
    """The fact from Parquet files with BIGINT, INT and string ids in one feed."""
    return stored.types_run(spark, sf)["wh"].fact()


@register("q_fact_while_rewriting", f"""
SELECT order_id, customer_id, product_id, amount, order_date,
       CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
             ORDER BY order_date DESC NULLS LAST, amount ASC NULLS FIRST,
                      product_id ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS rn
  FROM (SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(customer_id AS BIGINT) AS customer_id,
               product_id, COALESCE(TRY_CAST(amount AS DOUBLE), 0.0) AS amount,
               TRY_CAST(order_date AS DATE) AS order_date
        FROM bronze_orders WHERE batch_key <= '{stored.WAVE_SPLIT}') t
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND amount > 0) x
WHERE rn = 1""")
def q_fact_while_rewriting(spark, sf):
    """What readers see of the fact while a build has written its rows and not yet
    committed them: the state before."""
    return stored.rewriting_run(spark, sf)["wh"].fact()


# ------------------------------------------------------------ validation --

def _broken(dim_sql: str) -> str:
    # a damaged copy: closed versions wrongly left current (valid_to kept)
    return f"(SELECT * REPLACE (TRUE AS is_current) FROM {dim_sql})"


def _broken_df(df):
    return df.withColumn("is_current", F.lit(True))


@register("q_multi_current_customers", """
SELECT customer_id, COUNT(*) AS current_versions FROM scd2_customers
WHERE is_current GROUP BY customer_id HAVING COUNT(*) > 1""")
def q_multi_current_customers(spark, sf):
    return validate.multi_current(stored.full_run(spark, sf)["wh"].dim2("customers"),
                                  "customer_id")


@register("q_multi_current_products", """
SELECT product_id, COUNT(*) AS current_versions FROM scd2_products
WHERE is_current GROUP BY product_id HAVING COUNT(*) > 1""")
def q_multi_current_products(spark, sf):
    return validate.multi_current(stored.full_run(spark, sf)["wh"].dim2("products"),
                                  "product_id")


@register("q_multi_current_customers_damaged", f"""
SELECT customer_id, COUNT(*) AS current_versions FROM {_broken('scd2_customers')} d
WHERE is_current GROUP BY customer_id HAVING COUNT(*) > 1""")
def q_multi_current_customers_damaged(spark, sf):
    return validate.multi_current(_broken_df(flows.scd2_customers(spark, sf)), "customer_id")


@register("q_current_count_strict", """
SELECT product_id, COUNT(*) FILTER (WHERE is_current) AS current_versions
FROM (SELECT * FROM scd2_products WHERE NOT is_current) d
GROUP BY product_id HAVING COUNT(*) FILTER (WHERE is_current) <> 1""")
def q_current_count_strict(spark, sf):
    """The strict form of the one-current-version check also reports keys
    with none (here: the closed history alone)."""
    closed = flows.scd2_products(spark, sf).where(~F.col("is_current"))
    return validate.multi_current(closed, "product_id", strict=True)


@register("q_current_not_open", """
SELECT * FROM scd2_customers WHERE is_current AND valid_to IS NOT NULL""")
def q_current_not_open(spark, sf):
    return validate.current_not_open(stored.full_run(spark, sf)["wh"].dim2("customers"))


@register("q_current_not_open_damaged", f"""
SELECT * FROM {_broken('scd2_products')} d WHERE is_current AND valid_to IS NOT NULL""")
def q_current_not_open_damaged(spark, sf):
    return validate.current_not_open(_broken_df(flows.scd2_products(spark, sf)))


_OVERLAP_SQL = """
SELECT {key}, valid_from, valid_to,
       CASE WHEN valid_to IS NOT NULL AND valid_to <= valid_from THEN 'reversed'
            ELSE 'overlap' END AS problem
FROM (SELECT *, LEAD(valid_from) OVER (PARTITION BY {key}
                  ORDER BY valid_from, valid_to NULLS LAST) AS nf FROM {src}) x
WHERE (valid_to IS NOT NULL AND valid_to <= valid_from)
   OR (nf IS NOT NULL AND (valid_to IS NULL OR valid_to > nf))"""


@register("q_scd2_overlap", _OVERLAP_SQL.format(key="customer_id", src="scd2_customers"))
def q_scd2_overlap(spark, sf):
    return validate.scd2_overlap(stored.full_run(spark, sf)["wh"].dim2("customers"),
                                 "customer_id")


@register("q_scd2_overlap_damaged", _OVERLAP_SQL.format(
    key="product_id",
    src="(SELECT product_id, valid_from, valid_to FROM scd2_products UNION ALL "
        "SELECT product_id, valid_from - 400, NULL FROM scd2_products WHERE NOT is_current) d"))
def q_scd2_overlap_damaged(spark, sf):
    """Overlap check on a damaged copy: every closed version gets an extra,
    earlier, never-closed twin."""
    d = flows.scd2_products(spark, sf)
    twins = (d.where(~F.col("is_current"))
             .select("product_id", F.date_sub("valid_from", 400).alias("valid_from"),
                     F.lit(None).cast("date").alias("valid_to")))
    return validate.scd2_overlap(d.select("product_id", "valid_from", "valid_to")
                                 .unionByName(twins), "product_id")


@register("q_orphan_orders", """
SELECT f.order_id, f.customer_id, 'customer' AS missing
FROM fact_orders f LEFT JOIN cur_customers c ON f.customer_id = c.customer_id
WHERE c.customer_id IS NULL
UNION ALL
SELECT f.order_id, f.customer_id, 'product' AS missing
FROM fact_orders f LEFT JOIN cur_products p ON f.product_id = p.product_id
WHERE p.product_id IS NULL""")
def q_orphan_orders(spark, sf):
    wh = stored.full_run(spark, sf)["wh"]
    return validate.orphan_orders(wh.fact(), wh.dim2("customers"), wh.dim2("products"))


@register("q_dim_as_of", """
SELECT * FROM scd2_customers
WHERE valid_from <= DATE '1998-03-15' AND (valid_to > DATE '1998-03-15' OR valid_to IS NULL)""")
def q_dim_as_of(spark, sf):
    return validate.dim_as_of(stored.full_run(spark, sf)["wh"].dim2("customers"), "1998-03-15")


@register("q_dim_as_of_boundary", """
SELECT * FROM scd2_products
WHERE valid_from <= DATE '1998-01-01' AND (valid_to > DATE '1998-01-01' OR valid_to IS NULL)""")
def q_dim_as_of_boundary(spark, sf):
    """As of a day on which versions change: the new version, not the closed one."""
    return validate.dim_as_of(flows.scd2_products(spark, sf), "1998-01-01")


@register("q_gold_report_city", f"""
SELECT c.city, CAST(COUNT(f.order_id) AS BIGINT) AS total_orders,
       ROUND(SUM(f.amount), 2) AS total_amount, {AS_OF_SQL} AS update_date
FROM fact_orders f JOIN cur_customers c ON f.customer_id = c.customer_id
GROUP BY c.city ORDER BY total_amount DESC""")
def q_gold_report_city(spark, sf):
    g = stored.full_run(spark, sf)["wh"].table("gold_agg_sales_by_city")
    return validate.gold_report(_r2(g, "total_amount"))


@register("q_gold_report_category", f"""
SELECT p.category, CAST(COUNT(f.order_id) AS BIGINT) AS total_orders,
       ROUND(SUM(f.amount), 2) AS total_amount,
       CAST(COUNT(DISTINCT f.product_id) AS BIGINT) AS unique_products,
       {AS_OF_SQL} AS update_date
FROM fact_orders f JOIN cur_products p ON f.product_id = p.product_id
GROUP BY p.category ORDER BY total_amount DESC""")
def q_gold_report_category(spark, sf):
    g = stored.full_run(spark, sf)["wh"].table("gold_agg_sales_by_category")
    return validate.gold_report(_r2(g, "total_amount"))


@register("q_gold_report_ranking", """
SELECT customer_id, name, city, ROUND(total_amount, 2) AS total_amount,
       CAST(ROW_NUMBER() OVER (ORDER BY total_amount DESC, customer_id) AS INTEGER) AS ranking
FROM (SELECT f.customer_id, c.name, c.city, SUM(f.amount) AS total_amount
      FROM fact_orders f JOIN cur_customers c ON f.customer_id = c.customer_id
      GROUP BY f.customer_id, c.name, c.city) t
ORDER BY ranking LIMIT 100""")
def q_gold_report_ranking(spark, sf):
    g = stored.full_run(spark, sf)["wh"].table("gold_ranking_customers")
    return validate.gold_report(_r2(g, "total_amount"), "ranking", descending=False)


@register("q_batch_keys_seen", """
SELECT DISTINCT regexp_extract(_source_file, '(\\d{4}-\\d{2})', 1) AS batch_key
FROM raw_customers""")
def q_batch_keys_seen(spark, sf):
    """Diagnostic: batch keys as read from the stored Bronze file paths."""
    return validate.batch_keys_seen(stored.full_run(spark, sf)["wh"].bronze("customers"))


@register("q_analyst_customers", """
SELECT customer_id, name, city FROM scd2_customers WHERE is_current""")
def q_analyst_customers(spark, sf):
    return governance.analyst_view(stored.full_run(spark, sf)["wh"].dim2("customers"))


@register("q_analyst_products", """
SELECT product_id, product_name, category, price FROM scd2_products WHERE is_current""")
def q_analyst_products(spark, sf):
    return governance.analyst_view(stored.full_run(spark, sf)["wh"].dim2("products"))


@register("q_analyst_products_rows", "SELECT * FROM scd2_products WHERE is_current")
def q_analyst_products_rows(spark, sf):
    """Products under the row filter alone: current versions with all their columns."""
    return governance.analyst_view(stored.full_run(spark, sf)["wh"].dim2("products"), exclude=())


@register("q_analyst_customers_columns", "SELECT customer_id, name, city FROM scd2_customers")
def q_analyst_customers_columns(spark, sf):
    """Customers under the column filter alone: every version without history columns."""
    return governance.analyst_view(stored.full_run(spark, sf)["wh"].dim2("customers"), row_filter=None)


@register("q_current_customers", """
SELECT customer_id, name AS customer_name, city, valid_from AS since
FROM scd2_customers WHERE is_current = true ORDER BY customer_id""")
def q_current_customers(spark, sf):
    d = flows.scd2_customers(spark, sf)
    return (d.where(F.col("is_current") == F.lit(True))
            .select("customer_id", F.col("name").alias("customer_name"), "city",
                    F.col("valid_from").alias("since"))
            .orderBy("customer_id"))


# ------------------------------------------------------------- odd feeds --

def _odd(spark, sf, entity):
    from keelson.functions import batch_key_of
    from keelson.sources import feeds
    made = {"products": feeds.odd_products, "orders": feeds.odd_orders}[entity](spark, sf)
    return made.withColumn("batch_key", batch_key_of("_source_file"))


@register("q_clean_products_odd", "SELECT * FROM stg_products_odd")
def q_clean_products_odd(spark, sf):
    """Products with NULL attributes and duplicates that differ by price or tie."""
    from keelson.operators.cleanse import clean_products
    return clean_products(_odd(spark, sf, "products"))


@register("q_clean_orders_odd", "SELECT * FROM fact_orders_odd")
def q_clean_orders_odd(spark, sf):
    """Orders with timed and NULL dates, NULL customers and differing duplicates."""
    from keelson.operators.cleanse import clean_orders
    return clean_orders(_odd(spark, sf, "orders"))


@register("q_scd2_products_nulls", """
SELECT product_id, product_name, category, price, valid_from, valid_to, is_current
FROM scd2_products_odd_x""")
def q_scd2_products_nulls(spark, sf):
    """Type 2 products over NULL attributes, a NULL counted as a change."""
    from keelson.functions import business_date
    from keelson.operators.cleanse import clean_products
    from keelson.schemas import SCD2_SPECS
    spec = SCD2_SPECS["products"]
    return _scd.scd2_bulk(clean_products(_odd(spark, sf, "products")), spec["key"],
                          spec["tracked"], business_date("batch_key"), null_safe=True)


# the fold stated in SQL: a row is accepted when it differs from the last accepted one
_FOLD_NULLS = """
SELECT product_id, product_name, category, price, valid_from,
       LEAD(valid_from) OVER w AS valid_to, LEAD(valid_from) OVER w IS NULL AS is_current
FROM (SELECT DISTINCT n.product_id, n.product_name, n.category, n.price, n.valid_from, n.i
      FROM accepted a JOIN numbered n ON n.product_id = a.product_id AND n.i = a.last) v
WINDOW w AS (PARTITION BY product_id ORDER BY i)"""


def _fold_nulls_sql() -> str:
    numbered = with_ctes("""SELECT product_id, product_name, category, price, CAST(batch_key || '-01' AS DATE) AS valid_from,
       ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY batch_key) AS i FROM stg_products_odd""")
    return f"""WITH RECURSIVE numbered AS ({numbered}),
accepted AS (
  SELECT product_id, CAST(1 AS BIGINT) AS i, CAST(1 AS BIGINT) AS last FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.product_id, n.i, CASE WHEN n.product_name <> l.product_name OR n.category <> l.category
                                   OR n.price <> l.price THEN n.i ELSE a.last END
  FROM accepted a JOIN numbered n ON n.product_id = a.product_id AND n.i = a.i + 1
  JOIN numbered l ON l.product_id = a.product_id AND l.i = a.last)
{_FOLD_NULLS}"""


@register("q_scd2_products_nulls_fold", _fold_nulls_sql(), whole=True)
def q_scd2_products_nulls_fold(spark, sf):
    """Type 2 products over NULL attributes, a NULL no change (`<>`), in one pass: each row
    compared with the last accepted one, as batch-by-batch folding does."""
    from keelson.functions import business_date
    from keelson.operators.cleanse import clean_products
    from keelson.schemas import SCD2_SPECS
    spec = SCD2_SPECS["products"]
    return _scd.scd2_history(clean_products(_odd(spark, sf, "products")), spec["key"], spec["tracked"],
                             business_date("batch_key")).drop("opened_by", "closed_by")


# -------------------------------------------------------------- rejects --

@register("q_rejected_rows", """
SELECT 'customers' AS feed, reason, COUNT(*) AS n FROM (
  SELECT CASE WHEN TRY_CAST(customer_id AS BIGINT) IS NULL THEN 'customer_id'
              WHEN name IS NULL THEN 'name' WHEN city IS NULL THEN 'city'
              WHEN TRY_CAST(event_date AS DATE) IS NULL THEN 'event_date' END AS reason
  FROM raw_customers) c WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'products', reason, COUNT(*) FROM (
  SELECT CASE WHEN product_id IS NULL THEN 'product_id'
              WHEN TRY_CAST(price AS DOUBLE) IS NULL OR TRY_CAST(price AS DOUBLE) <= 0
              THEN 'price' END AS reason
  FROM raw_products) p WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'orders', reason, COUNT(*) FROM (
  SELECT CASE WHEN TRY_CAST(order_id AS BIGINT) IS NULL THEN 'order_id'
              WHEN product_id IS NULL THEN 'product_id'
              WHEN TRY_CAST(amount AS DOUBLE) IS NULL OR TRY_CAST(amount AS DOUBLE) <= 0
              THEN 'amount' END AS reason
  FROM raw_orders) o WHERE reason IS NOT NULL GROUP BY reason""")
def q_rejected_rows(spark, sf):
    """Raw rows that cleansing drops, by feed and first failing column."""
    from functools import reduce
    from keelson.operators.cleanse import rejected_rows
    each = [rejected_rows(flows.bronze(spark, sf, e), e)
            .groupBy(F.lit(e).alias("feed"), "reason").agg(F.count(F.lit(1)).alias("n"))
            for e in ("customers", "products", "orders")]
    return reduce(DataFrame.unionByName, each)


@register("q_orders_wide_ids", """
SELECT order_id + 3000000000 AS order_id, customer_id + 3000000000 AS customer_id, product_id,
       amount, order_date, year, month FROM fact_orders""")
def q_orders_wide_ids(spark, sf):
    """The order fact with every order and customer id moved above 2^31."""
    from keelson.operators.cleanse import clean_orders
    raw = flows.bronze(spark, sf, "orders")
    wide = {c: F.coalesce((F.col(c).try_cast("bigint") + 3_000_000_000).cast("string"), F.col(c))
            for c in ("order_id", "customer_id")}
    return clean_orders(raw.withColumns(wide))


@register("q_ingest_unread_files", """
SELECT CAST(NULL AS VARCHAR) AS entity, CAST(NULL AS VARCHAR) AS path
FROM region WHERE FALSE""")
def q_ingest_unread_files(spark, sf):
    """Landed files with rows that Bronze does not hold (must be none)."""
    from functools import reduce
    from keelson.streaming.ingest import unread_files
    run = stored.full_run(spark, sf)
    each = [unread_files(spark, f"{run['landing']}/{e}", run["wh"].bronze(e))
            .select(F.lit(e).alias("entity"), "path")
            for e in ("customers", "products", "orders")]
    return reduce(DataFrame.unionByName, each)


@register("q_ingest_unread_files_damaged", """
SELECT 'customers' AS entity, MAX(batch_key) AS batch_key FROM bronze_customers
UNION ALL SELECT 'products', MAX(batch_key) FROM bronze_products""")
def q_ingest_unread_files_damaged(spark, sf):
    """The check on a Bronze without its newest batch's rows: it names their files."""
    from functools import reduce
    from keelson.functions import batch_key_of
    from keelson.streaming.ingest import unread_files
    run = stored.full_run(spark, sf)
    each = []
    for e in ("customers", "products"):
        b = run["wh"].bronze(e)
        newest = b.agg(F.max("batch_key")).first()[0]
        lost = unread_files(spark, f"{run['landing']}/{e}", b.where(F.col("batch_key") != newest))
        each.append(lost.select(F.lit(e).alias("entity"), batch_key_of("path").alias("batch_key")).distinct())
    return reduce(DataFrame.unionByName, each)


@register("q_multi_current_products_damaged", f"""
SELECT product_id, COUNT(*) AS current_versions FROM {_broken('scd2_products')} d
WHERE is_current GROUP BY product_id HAVING COUNT(*) > 1""")
def q_multi_current_products_damaged(spark, sf):
    return validate.multi_current(_broken_df(stored.full_run(spark, sf)["wh"].dim2("products")),
                                  "product_id")


@register("q_products_not_open", """
SELECT * FROM scd2_products WHERE is_current AND valid_to IS NOT NULL""")
def q_products_not_open(spark, sf):
    """Current rows of the stored product dimension that carry an end (must be none)."""
    return validate.current_not_open(stored.full_run(spark, sf)["wh"].dim2("products"))


# ----------------------------------------------------- changes / as-was --

@register("q_scd2_changes", """
SELECT s.customer_id, s.name, s.city, s.event_date
FROM stg_customers s
LEFT JOIN (SELECT customer_id, name, city FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY batch_key DESC) AS rn
             FROM scd2_customers_x
             WHERE batch_key < (SELECT MAX(batch_key) FROM stg_customers)) v
           WHERE rn = 1) c ON s.customer_id = c.customer_id
WHERE s.batch_key = (SELECT MAX(batch_key) FROM stg_customers)
  AND (c.customer_id IS NULL OR s.name <> c.name OR s.city <> c.city)""")
def q_scd2_changes(spark, sf):
    """Rows of the newest batch that open a version against the state left
    by all earlier batches (new key, or name / city differs)."""
    stg = flows.stg_customers(spark, sf)
    newest = stg.agg(F.max("batch_key")).first()[0]
    before = _scd.scd2_bulk(stg.where(F.col("batch_key") < F.lit(newest)), "customer_id",
                            ["name", "city"], F.col("event_date"))
    batch = stg.where(F.col("batch_key") == F.lit(newest)).drop("batch_key")
    return _scd.scd2_changes(before, batch, "customer_id", ["name", "city"])


@register("q_batch_slice_customers", """
SELECT customer_id, name, city, event_date, batch_key,
       CAST(batch_key || '-01' AS DATE) AS business_date
FROM bronze_customers WHERE batch_key = (SELECT MAX(batch_key) FROM bronze_customers)""")
def q_batch_slice_customers(spark, sf):
    """One batch of Bronze by equality on its key (partition pruning on the
    stored table), with its business date."""
    from keelson.functions import business_date
    b = stored.full_run(spark, sf)["wh"].bronze("customers")
    newest = b.agg(F.max("batch_key")).first()[0]
    return (b.where(F.col("batch_key") == F.lit(newest))
            .select("customer_id", "name", "city", "event_date", "batch_key",
                    business_date("batch_key").alias("business_date")))


@register("q_sales_by_city_as_was", f"""
SELECT d.city, CAST(COUNT(f.order_id) AS BIGINT) AS total_orders,
       ROUND(SUM(f.amount), 2) AS total_amount, {AS_OF_SQL} AS update_date
FROM fact_orders f JOIN scd2_customers d
  ON f.customer_id = d.customer_id AND d.valid_from <= f.order_date
 AND (d.valid_to > f.order_date OR d.valid_to IS NULL)
GROUP BY d.city""")
def q_sales_by_city_as_was(spark, sf):
    return _r2(marts.sales_by_city_as_was(flows.fact_orders(spark, sf),
                                          flows.scd2_customers(spark, sf), flows.AS_OF),
               "total_amount")


@register("q_sales_by_category_as_was", f"""
SELECT d.category, CAST(COUNT(f.order_id) AS BIGINT) AS total_orders,
       ROUND(SUM(f.amount), 2) AS total_amount,
       CAST(COUNT(DISTINCT f.product_id) AS BIGINT) AS unique_products,
       {AS_OF_SQL} AS update_date
FROM fact_orders f JOIN scd2_products d
  ON f.product_id = d.product_id AND d.valid_from <= f.order_date
 AND (d.valid_to > f.order_date OR d.valid_to IS NULL)
GROUP BY d.category""")
def q_sales_by_category_as_was(spark, sf):
    return _r2(marts.sales_by_category_as_was(flows.fact_orders(spark, sf),
                                              flows.scd2_products(spark, sf), flows.AS_OF),
               "total_amount")


_AS_WAS_SQL = """
SELECT f.order_id, f.customer_id, d.city, d.valid_from
FROM fact_orders f JOIN scd2_customers d
  ON f.customer_id = d.customer_id AND d.valid_from <= f.order_date
 AND (d.valid_to > f.order_date OR d.valid_to IS NULL)"""


@register("q_orders_as_was", _AS_WAS_SQL)
def q_orders_as_was(spark, sf):
    """Point-in-time join at row level: each order with the customer version
    valid on its date (no fan-out: one version per order)."""
    f = flows.fact_orders(spark, sf).select("order_id", "customer_id", "order_date")
    v = flows.scd2_customers(spark, sf).select("customer_id", "city", "valid_from",
                                               "valid_to")
    return marts.as_of_join(f, v, "customer_id", "order_date") \
        .select("order_id", "customer_id", "city", "valid_from")


@register("q_orders_as_was_merged", _AS_WAS_SQL)
def q_orders_as_was_merged(spark, sf):
    """The same by a merge in date order, for keys with many versions."""
    f = flows.fact_orders(spark, sf).select("order_id", "customer_id", "order_date")
    v = flows.scd2_customers(spark, sf).select("customer_id", "city", "valid_from", "valid_to")
    return marts.as_of_merge(f, v, "customer_id", "order_date") \
        .select("order_id", "customer_id", "city", "valid_from")
