"""Reference SQL for the registered queries, runnable by DuckDB on the given
tables.  Each statement restates a query's semantics in plain SQL (window
dedup, lag/lead versions, outer joins) as an independent check of the Spark
plans.  Money sums are rounded to 2 places on both sides.
"""

from __future__ import annotations

# Batch token of a feed path (each feed path has exactly one).
_BK = r"regexp_extract(_source_file, '(\d{4}-(0[1-9]|1[0-2]))', 1)"

CTES: dict[str, str] = {}

CTES["raw_customers"] = """
SELECT CASE WHEN c_custkey % 97 = 13 THEN 'C' || CAST(c_custkey AS VARCHAR)
            ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN c_custkey % 89 = 7 AND b = 1 THEN NULL
            WHEN c_custkey % 10 = 0 AND b >= 2 THEN c_name || ' Jr'
            ELSE c_name END AS name,
       CASE WHEN c_custkey % 83 = 5 AND b = 2 THEN NULL ELSE n_name END AS city,
       CASE WHEN c_custkey % 79 = 3 AND b = 3 THEN 'not-a-date'
            ELSE CAST(CAST(CAST(1995 + b AS VARCHAR) || '-01-02' AS DATE)
                 + CAST(c_custkey % 27 AS INTEGER) - CAST(dup AS INTEGER) AS VARCHAR) END AS event_date,
       'raw/customers/customers_' || CAST(1995 + b AS VARCHAR) || '-01.json' AS _source_file
FROM (SELECT *, unnest(CASE WHEN c_custkey % 31 = 0 THEN [0, 1] ELSE [0] END) AS dup
      FROM (SELECT *, unnest(range(CAST(c_custkey % 5 AS BIGINT), 7)) AS b
            FROM customer WHERE c_custkey % 50 <> 49) cb
      WHERE (c_custkey * 7 + b) % 3 <> 0) cbd
JOIN nation ON n_nationkey = (c_nationkey
       + CASE WHEN c_custkey % 4 = 0 THEN b
              WHEN c_custkey % 4 = 1 AND b >= 3 THEN 1 ELSE 0 END
       + CASE WHEN dup = 1 THEN 7 ELSE 0 END) % 25
"""

CTES["raw_products"] = """
SELECT CASE WHEN p_partkey % 73 = 6 AND b = 1 THEN NULL
            ELSE 'P' || CAST(p_partkey AS VARCHAR) END AS product_id,
       p_name AS product_name,
       CASE WHEN p_partkey % 11 = 0 AND b >= 4 THEN 'CLEARANCE' ELSE p_type END AS category,
       CASE WHEN p_partkey % 61 = 4 AND b = 0 THEN '-1.0'
            WHEN p_partkey % 67 = 2 THEN 'n/a'
            WHEN p_partkey % 3 = 0 THEN CAST(ROUND(p_retailprice + 10 * b, 2) AS VARCHAR)
            ELSE CAST(p_retailprice AS VARCHAR) END AS price,
       '1994-06-15' AS launch_date,
       'raw/products/products_' || CAST(1995 + b AS VARCHAR) || '-01.csv' AS _source_file
FROM (SELECT *, unnest(range(0, 7)) AS b FROM part WHERE p_partkey % 40 <> 39) pb
WHERE (p_partkey + b) % 4 <> 0
"""

CTES["raw_orders"] = """
SELECT CASE WHEN o_orderkey % 101 = 50 THEN 'bad' ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       'P' || CAST(l_min AS VARCHAR) AS product_id,
       CASE WHEN o_orderkey % 53 = 1 THEN NULL
            WHEN o_orderkey % 59 = 2 THEN '0'
            WHEN o_orderkey % 47 = 3 THEN '-5.0'
            ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       'raw/orders/orders_' || SUBSTRING(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7)
           || '.parquet' AS _source_file
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 43 = 0 THEN [0, 1] ELSE [0] END) AS dup
      FROM orders) o
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS l_min FROM lineitem GROUP BY l_orderkey) l
       ON l_orderkey = o_orderkey
"""

for _e in ("customers", "products", "orders"):
    CTES[f"bronze_{_e}"] = f"SELECT *, {_BK} AS batch_key FROM raw_{_e}"

CTES["stg_customers"] = """
SELECT batch_key, customer_id, name, city, event_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY batch_key, customer_id
             ORDER BY event_date DESC NULLS LAST, name ASC NULLS FIRST, city ASC NULLS FIRST) AS rn
  FROM (SELECT batch_key, TRY_CAST(customer_id AS BIGINT) AS customer_id, name, city,
               TRY_CAST(event_date AS DATE) AS event_date FROM bronze_customers) t
  WHERE customer_id IS NOT NULL AND name IS NOT NULL AND city IS NOT NULL
    AND event_date IS NOT NULL) x
WHERE rn = 1
"""

CTES["stg_products"] = """
SELECT batch_key, product_id, product_name, category, price, launch_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY batch_key, product_id
             ORDER BY price ASC NULLS FIRST, product_name ASC NULLS FIRST,
                      category ASC NULLS FIRST, launch_date ASC NULLS FIRST) AS rn
  FROM (SELECT batch_key, product_id, product_name, category,
               TRY_CAST(price AS DOUBLE) AS price,
               TRY_CAST(launch_date AS DATE) AS launch_date FROM bronze_products) t
  WHERE product_id IS NOT NULL AND price > 0) x
WHERE rn = 1
"""

CTES["fact_orders"] = """
SELECT order_id, customer_id, product_id, amount, order_date,
       CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
             ORDER BY order_date DESC NULLS LAST, amount ASC NULLS FIRST,
                      product_id ASC NULLS FIRST, customer_id ASC NULLS FIRST) AS rn
  FROM (SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
               TRY_CAST(customer_id AS BIGINT) AS customer_id, product_id,
               COALESCE(TRY_CAST(amount AS DOUBLE), 0.0) AS amount,
               TRY_CAST(order_date AS DATE) AS order_date FROM raw_orders) t
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND amount > 0) x
WHERE rn = 1
"""


CTES["raw_products_odd"] = """
SELECT product_id, CASE WHEN n % 13 = 1 THEN NULL ELSE product_name END AS product_name,
       CASE WHEN dup = 1 THEN 'AAA'
            WHEN n % 7 = 2 AND regexp_matches(_source_file, '199[68]-01') THEN NULL
            ELSE category END AS category,
       CASE WHEN dup = 1 AND n % 6 = 0 THEN '1' || price WHEN dup = 1 THEN '0' || price
            ELSE price END AS price,
       CASE WHEN n % 5 = 3 THEN NULL ELSE launch_date END AS launch_date, _source_file
FROM (SELECT *, unnest(CASE WHEN n % 6 < 2 THEN [0, 1] ELSE [0] END) AS dup
      FROM (SELECT *, TRY_CAST(substring(product_id, 2) AS BIGINT) AS n FROM raw_products) a) b
"""

CTES["raw_orders_odd"] = """
SELECT order_id, CASE WHEN n % 9 = 4 THEN NULL ELSE customer_id END AS customer_id,
       CASE WHEN dup = 1 AND n % 5 = 2 THEN 'A' ELSE product_id END AS product_id,
       CASE WHEN dup = 1 AND n % 5 < 2 THEN '1' || amount ELSE amount END AS amount,
       CASE WHEN (dup = 1 AND n % 5 = 0) OR n % 11 = 2 THEN NULL
            WHEN n % 7 = 1 THEN order_date || ' 10:30:00' ELSE order_date END AS order_date,
       _source_file
FROM (SELECT *, unnest(CASE WHEN n % 5 < 3 THEN [0, 1] ELSE [0] END) AS dup
      FROM (SELECT *, TRY_CAST(order_id AS BIGINT) AS n FROM raw_orders) a) b
"""

CTES["bronze_products_odd"] = CTES["bronze_products"].replace("raw_products", "raw_products_odd")
CTES["stg_products_odd"] = CTES["stg_products"].replace("bronze_products", "bronze_products_odd")
CTES["fact_orders_odd"] = CTES["fact_orders"].replace("raw_orders", "raw_orders_odd").replace(
    "TRY_CAST(order_date AS DATE)", "CAST(TRY_CAST(order_date AS TIMESTAMP) AS DATE)")


def _scd2_bulk(stg: str, key: str, tracked: list[str], eff: str, null_safe: bool = False) -> str:
    w = f"PARTITION BY {key} ORDER BY batch_key"
    lags = ", ".join(f"LAG({t}) OVER ({w}) AS p_{t}" for t in tracked)
    if null_safe:
        diff = " OR ".join(f"{t} IS DISTINCT FROM p_{t}" for t in tracked)
    else:
        diff = " OR ".join(f"{t} <> p_{t}" for t in tracked)
    cols = ", ".join(tracked)
    return f"""
SELECT {key}, {cols}, valid_from,
       LEAD(valid_from) OVER ({w}) AS valid_to,
       LEAD(valid_from) OVER ({w}) IS NULL AS is_current,
       batch_key, LEAD(batch_key) OVER ({w}) AS closed_by
FROM (
  SELECT * FROM (
    SELECT {key}, {cols}, {eff} AS valid_from, batch_key,
           LAG(1) OVER ({w}) AS pk, {lags}
    FROM {stg}) l
  WHERE pk IS NULL OR {diff}) v
"""


CTES["scd2_customers_x"] = _scd2_bulk("stg_customers", "customer_id", ["name", "city"],
                                      "event_date")
CTES["scd2_products_x"] = _scd2_bulk("stg_products", "product_id",
                                     ["product_name", "category", "price"],
                                     "CAST(batch_key || '-01' AS DATE)")
CTES["scd2_customers"] = ("SELECT customer_id, name, city, valid_from, valid_to, is_current "
                          "FROM scd2_customers_x")
CTES["scd2_products"] = ("SELECT product_id, product_name, category, price, valid_from, "
                         "valid_to, is_current FROM scd2_products_x")
CTES["scd2_products_odd_x"] = _scd2_bulk("stg_products_odd", "product_id",
                                         ["product_name", "category", "price"],
                                         "CAST(batch_key || '-01' AS DATE)", null_safe=True)
for _e in ("customers", "products"):  # the rows each batch and all before it staged
    CTES[f"{_e}_upto"] = (f"SELECT s.*, b.upto FROM stg_{_e} s JOIN (SELECT DISTINCT batch_key AS upto "
                          "FROM stg_customers) b ON s.batch_key <= b.upto")
CTES["cur_customers"] = "SELECT * FROM scd2_customers WHERE is_current"
CTES["cur_products"] = "SELECT * FROM scd2_products WHERE is_current"

CTES["scd1_customers"] = """
SELECT customer_id, name, city, event_date AS update_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY batch_key DESC) AS rn
  FROM stg_customers) x WHERE rn = 1
"""

AS_OF_SQL = "DATE '2001-08-02'"


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) names."""
    import re
    names = list(CTES)
    need: list[str] = []

    def visit(text: str) -> None:
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", text):
                visit(CTES[n])
                if n not in need:
                    need.append(n)

    visit(body)
    if not need:
        return body.strip()
    head = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in need)
    return f"WITH {head}\n{body.strip()}"
