"""Table schemas of the three layers.

Bronze keeps every business column as a string; Silver and Gold are typed.
Order and customer ids and the marts' counts are BIGINT (a declared departure
from an INT layout: ids pass 2^31 at scale, and an INT cast would drop them).
Each entry: (schema, partition columns).
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
          "DOUBLE": T.DoubleType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
          "BOOLEAN": T.BooleanType()}


def _struct(spec: str) -> T.StructType:
    """'name TYPE, ...' with simple types only (no session needed)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ.upper()], True))
    return T.StructType(fields)


TECH = "_ingestion_ts TIMESTAMP, _ingestion_date DATE, _source_file STRING"

# Raw business columns of the three feeds (all STRING at Bronze).
RAW_COLUMNS = {
    "customers": ["customer_id", "name", "city", "event_date"],
    "orders": ["order_id", "customer_id", "product_id", "amount", "order_date"],
    "products": ["product_id", "product_name", "category", "price", "launch_date"],
}


def raw_schema(entity: str) -> T.StructType:
    return _struct(", ".join(f"{c} STRING" for c in RAW_COLUMNS[entity]))


TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    # bronze: raw columns + technical columns + the derived batch key
    "bronze_raw_customers": (_struct(
        "customer_id STRING, name STRING, city STRING, event_date STRING, "
        + TECH + ", batch_key STRING"), ["_ingestion_date", "batch_key"]),
    "bronze_raw_orders": (_struct(
        "order_id STRING, customer_id STRING, product_id STRING, amount STRING, "
        "order_date STRING, " + TECH + ", batch_key STRING"), ["_ingestion_date", "batch_key"]),
    "bronze_raw_products": (_struct(
        "product_id STRING, product_name STRING, category STRING, price STRING, "
        "launch_date STRING, " + TECH + ", batch_key STRING"), ["_ingestion_date", "batch_key"]),
    # silver
    "silver_stg_customers": (_struct(
        "customer_id BIGINT, name STRING, city STRING, event_date DATE, batch_key STRING"),
        ["batch_key"]),
    "silver_stg_products": (_struct(
        "product_id STRING, product_name STRING, category STRING, price DOUBLE, "
        "launch_date DATE, batch_key STRING"), ["batch_key"]),
    "silver_dim_customers_type1": (_struct(
        "customer_id BIGINT, name STRING, city STRING, update_date DATE, batch_key STRING"),
        ["batch_key"]),
    "silver_dim_customers_type2": (_struct(
        "customer_id BIGINT, name STRING, city STRING, valid_from DATE, valid_to DATE, "
        "is_current BOOLEAN"), []),
    "silver_dim_products_type2": (_struct(
        "product_id STRING, product_name STRING, category STRING, price DOUBLE, "
        "valid_from DATE, valid_to DATE, is_current BOOLEAN"), []),
    "silver_fact_orders": (_struct(
        "order_id BIGINT, customer_id BIGINT, product_id STRING, amount DOUBLE, order_date DATE, "
        "year INT, month INT"), ["year", "month"]),
    "silver_batch_control": (_struct("batch_key STRING, processed_at TIMESTAMP"), []),
    # gold
    "gold_agg_sales_by_city": (_struct(
        "city STRING, total_orders BIGINT, total_amount DOUBLE, update_date DATE"), []),
    "gold_agg_sales_by_category": (_struct(
        "category STRING, total_orders BIGINT, total_amount DOUBLE, unique_products BIGINT, "
        "update_date DATE"), []),
    "gold_ranking_customers": (_struct(
        "customer_id BIGINT, name STRING, city STRING, total_amount DOUBLE, ranking INT"), []),
}

LAYER_OF = {name: name.split("_", 1)[0] for name in TABLES}

# Version-row columns of the two Type 2 dimensions.
SCD2_SPECS = {
    "customers": {"key": "customer_id", "tracked": ["name", "city"]},
    "products": {"key": "product_id", "tracked": ["product_name", "category", "price"]},
}
