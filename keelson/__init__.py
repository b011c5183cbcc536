"""keelson: a layered (bronze / silver / gold) warehouse on plain Spark.

Raw JSON, CSV and Parquet drops are picked up once, cleansed and typed,
folded in batch order into slowly changing dimensions (Type 1 and Type 2)
and a partitioned fact table, then summarised into marts.  Every operator
is a DataFrame -> DataFrame function, so Catalyst sees whole plans.
"""

from keelson.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
