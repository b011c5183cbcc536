"""Small hand-made landing zones for pipeline tests."""

from __future__ import annotations

import csv
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq


def write_customers(root, name, rows):
    """rows: (customer_id, name, city, event_date) -> one JSON-lines file."""
    d = os.path.join(root, "customers", os.path.dirname(name))
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(root, "customers", name), "w") as f:
        for r in rows:
            f.write(json.dumps(dict(zip(["customer_id", "name", "city", "event_date"], r))) + "\n")


def write_products(root, name, rows, header=("product_id", "product_name", "category",
                                             "price", "launch_date")):
    d = os.path.join(root, "products")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def write_orders(root, name, rows):
    d = os.path.join(root, "orders")
    os.makedirs(d, exist_ok=True)
    cols = ["order_id", "customer_id", "product_id", "amount", "order_date"]
    t = pa.table({c: pa.array([r[i] for r in rows], pa.string()) for i, c in enumerate(cols)})
    pq.write_table(t, os.path.join(d, name))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
