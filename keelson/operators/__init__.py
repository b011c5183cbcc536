from keelson.operators.cleanse import clean_customers, clean_orders, clean_products
from keelson.operators.dedup import dedup_first
from keelson.operators.scd import (scd1_bulk, scd1_merge, scd2_bulk, scd2_changes,
                                   scd2_step)

__all__ = ["clean_customers", "clean_orders", "clean_products", "dedup_first",
           "scd1_bulk", "scd1_merge", "scd2_bulk", "scd2_changes", "scd2_step"]
