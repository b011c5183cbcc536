from keelson.sources.tables import read_table
from keelson.sources.feeds import raw_customers, raw_orders, raw_products, raw_feed

__all__ = ["read_table", "raw_customers", "raw_orders", "raw_products", "raw_feed"]
