import datetime as dt

import pytest
from pyspark.sql import functions as F

from keelson.plans.warehouse import Warehouse
from tests.helpers import rows, write_customers, write_orders, write_products

D = dt.date


def _landing(tmp_path):
    root = str(tmp_path / "landing")
    write_customers(root, "customers_2026-01.json", [("1", "Ann", "Rome", "2026-01-05"),
                                                      ("2", "Bob", "Oslo", "2026-01-06")])
    write_products(root, "products_2026-01.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    write_orders(root, "orders_2026-01.parquet", [("10", "1", "P1", "3.0", "2026-01-07"),
                                                  ("11", "3", "P1", "4.0",
                                                   "2026-01-08 10:00:00")])
    return root


def _dims(wh):
    return (rows(wh.dim2("customers"), "customer_id", "city", "valid_from", "valid_to",
                 "is_current"),
            rows(wh.dim2("products"), "product_id", "category", "valid_from", "valid_to",
                 "is_current"))


def test_pipeline_fold_rerun_and_late_batch(spark, tmp_path):
    land = _landing(tmp_path)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    r1 = wh.run(land, as_of="2026-03-01")
    assert r1["ingested"] == {"customers": 2, "orders": 2, "products": 1}
    assert r1["silver"]["applied"] == ["2026-01"]
    # rerun with nothing new: no-op
    before = _dims(wh)
    r2 = wh.run(land, as_of="2026-03-01")
    assert r2["ingested"] == {"customers": 0, "orders": 0, "products": 0}
    assert r2["silver"]["applied"] == [] and _dims(wh) == before
    # next batch: Ann moves, product changes category
    write_customers(land, "customers_2026-02.json", [("1", "Ann", "Paris", "2026-02-03")])
    write_products(land, "products_2026-02.csv", [("P1", "Pen", "Y", "1.5", "2025-06-01")])
    wh.run(land, as_of="2026-03-01")
    cust, prod = _dims(wh)
    assert cust == [(1, "Paris", D(2026, 2, 3), None, True),
                    (1, "Rome", D(2026, 1, 5), D(2026, 2, 3), False),
                    (2, "Oslo", D(2026, 1, 6), None, True)]
    assert prod == [("P1", "X", D(2026, 1, 1), D(2026, 2, 1), False),
                    ("P1", "Y", D(2026, 2, 1), None, True)]
    assert rows(wh.control().groupBy("batch_key").count(), "batch_key", "count") == \
        [("2026-01", 1), ("2026-02", 1)]
    # the order with a time part is kept, its customer (3) is an orphan
    assert rows(wh.fact(), "order_id", "order_date") == [(10, D(2026, 1, 7)),
                                                          (11, D(2026, 1, 8))]
    assert rows(wh.table("gold_agg_sales_by_city"), "city", "total_orders") == [("Paris", 1)]
    # a late file of an old batch is refused, not replayed
    write_customers(land, "customers_2025-12.json", [("1", "Ann", "Bern", "2025-12-01")])
    write_customers(land, "customers_2026-03.json", [("2", "Bob", "Bonn", "2026-03-02")])
    write_orders(land, "orders_2026-03.parquet", [("12", "2", "P1", "5.0", "2026-03-03")])
    r3 = wh.run(land, as_of="2026-03-01")
    assert r3["silver"]["refused"] == ["2025-12"] and r3["silver"]["applied"] == ["2026-03"]
    assert wh.refused() == ["2025-12"] and wh.pending() == []
    assert r3["silver"]["fact_rows"] > 0 and wh.fact().where("order_id = 12").count() == 1
    assert [r[1] for r in rows(wh.current_versions("customers"), "customer_id", "city")] == ["Paris", "Bonn"]
    assert wh.run(land)["silver"]["refused"] == []


def test_crash_before_commit_then_rerun(spark, tmp_path):
    land = _landing(tmp_path)
    clean = Warehouse(spark, str(tmp_path / "clean"))
    clean.run(land)
    wh = Warehouse(spark, str(tmp_path / "crash"))
    wh.ingest(land)
    # a batch that wrote its folders but stopped before its control row
    wh._commit_orig, wh._commit = wh._commit, lambda bks: None
    wh.run_silver(mode="fold")
    assert wh.committed() == [] and wh.dim2("customers").count() == 0  # invisible
    wh._commit = wh._commit_orig
    wh.run_silver(mode="fold")
    assert _dims(wh) == _dims(clean)


def test_no_token_is_an_error_and_two_tokens_take_the_last(spark, tmp_path):
    land = str(tmp_path / "landing")
    write_customers(land, "customers.json", [("1", "Ann", "Rome", "2026-01-05")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.ingest(land)
    with pytest.raises(ValueError, match="no batch key"):
        wh.pending()
    write_customers(land, "2026-01/customers_2026-02.json", [("2", "Bob", "Oslo", "2026-02-01")])
    wh.ingest(land)
    assert wh.pending() == ["2026-02"]


def test_products_only_batch_is_not_processed(spark, tmp_path):
    land = _landing(tmp_path)
    write_products(land, "products_2026-02.csv", [("P1", "Pen", "Z", "1.5", "2025-06-01")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    assert wh.committed() == ["2026-01"]
    both = Warehouse(spark, str(tmp_path / "wh2"), batch_source="both")
    both.run(land)
    assert both.committed() == ["2026-01", "2026-02"]


def test_csv_binds_columns_by_header_name(spark, tmp_path):
    land = _landing(tmp_path)
    # same columns, other order: rejected rather than silently swapped
    write_products(land, "products_2026-02.csv", [("1.5", "P2", "Pen", "X", "2025-06-01")],
                   header=("price", "product_id", "product_name", "category", "launch_date"))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(Exception):
        wh.ingest(land)


def test_auto_mode_is_exact_in_bulk_across_null_categories(spark, tmp_path):
    land = str(tmp_path / "landing")
    for m, cat in ((1, "X"), (2, None), (3, "Y")):
        write_customers(land, f"customers_2026-0{m}.json", [("1", "Ann", "Rome", f"2026-0{m}-02")])
        write_products(land, f"products_2026-0{m}.csv", [("P1", "Pen", cat, "1.5", "2025-06-01")])
    for name, null_safe, versions in (("wh", False, 2), ("wh_ns", True, 3)):
        wh, fold = (Warehouse(spark, str(tmp_path / f"{name}_{mode}"), null_safe=null_safe) for mode in ("auto", "fold"))
        wh.ingest(land)
        fold.ingest(land)
        assert wh.run_silver(mode="auto")["mode"] == "bulk" and fold.run_silver(mode="fold")["mode"] == "fold"
        cols = wh.dim2("products").columns
        assert _text(wh.dim2("products"), cols) == _text(fold.dim2("products"), cols)
        assert wh.dim2("products").count() == versions
    assert rows(Warehouse(spark, str(tmp_path / "wh_auto")).dim2("products"), "category", "valid_from") == \
        [("X", D(2026, 1, 1)), ("Y", D(2026, 3, 1))]


def test_incremental_fact_equals_full_restatement(spark, tmp_path):
    land = _landing(tmp_path)
    write_orders(land, "orders_2026-02.parquet", [("20", "1", "P1", "2.0", "2026-02-01"),
                                                  ("21", "2", "P1", "6.0", "2026-02-02")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    # late files: order 20 restated with a later date (moves to March),
    # order 10 duplicated with an earlier date (ignored), a new order 30,
    # and an invalid row that must not reach the fact
    write_orders(land, "orders_2026-03.parquet", [("20", "1", "P1", "2.5", "2026-03-04"),
                                                  ("10", "1", "P1", "1.0", "2025-12-31"),
                                                  ("30", "2", "P1", "7.0", None),
                                                  ("31", "2", "P1", "-1", "2026-03-01")])
    wh.ingest(land)
    # only the touched partitions are rewritten: 2026-01 (10, 11), 2026-02 (21),
    # 2026-03 (20) and the NULL-date partition (30)
    assert wh.build_fact() == 5
    inc = rows(wh.fact(), "order_id", "customer_id", "amount", "order_date", "year", "month")
    full = Warehouse(spark, str(tmp_path / "wh_full"))
    full.ingest(land)
    full.build_fact(full=True)
    assert inc == rows(full.fact(), "order_id", "customer_id", "amount", "order_date", "year",
                       "month")
    assert (20, 1, 2.5, D(2026, 3, 4), 2026, 3) in inc and len(inc) == 5
    assert wh.build_fact() == 0  # nothing new


def test_register_catalog(spark, tmp_path):
    from keelson.schemas import TABLES
    land = _landing(tmp_path)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land, as_of="2026-03-01")
    for month in (2, 3):
        names = wh.register_catalog("kt")
        other = spark.newSession()  # shares the catalog, but no temp views
        assert names == [f"kt_{n.split('_', 1)[0]}.{n}" for n in TABLES]
        for name in names:
            want = wh.table(name.split(".")[1])
            cols = [c for c in want.columns if c != "batch_key" or "bronze" in name or "control" in name]
            assert _text(other.table(name), cols) == _text(want, cols), name
        write_customers(land, f"customers_2026-0{month}.json", [("1", "Ann", f"Town {month}", f"2026-0{month}-03")])
        write_orders(land, f"orders_2026-0{month}.parquet", [(str(month), "1", "P1", "5.0", f"2026-0{month}-04")])
        wh.run(land, as_of="2026-03-01")


def test_incremental_fact_drops_emptied_partition(spark, tmp_path):
    land = _landing(tmp_path)
    write_orders(land, "orders_2026-04.parquet", [("40", "1", "P1", "2.0", "2026-04-01")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    # order 40 was alone in April and moves to May
    write_orders(land, "orders_2026-05.parquet", [("40", "1", "P1", "2.0", "2026-05-09")])
    wh.ingest(land)
    wh.build_fact()
    assert rows(wh.fact().where("order_id = 40"), "order_id", "year", "month") == \
        [(40, 2026, 5)]
    full = Warehouse(spark, str(tmp_path / "full"))
    full.ingest(land)
    full.build_fact(full=True)
    cols = ("order_id", "customer_id", "amount", "order_date", "year", "month")
    assert rows(wh.fact(), *cols) == rows(full.fact(), *cols)


def test_crash_between_chains_then_rerun(spark, tmp_path):
    land = _landing(tmp_path)
    write_customers(land, "customers_2026-02.json", [("1", "Ann", "Paris", "2026-02-03")])
    write_products(land, "products_2026-02.csv", [("P1", "Pen", "Y", "1.5", "2025-06-01")])
    clean = Warehouse(spark, str(tmp_path / "clean"))
    clean.ingest(land)
    clean.run_silver(mode="fold")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.ingest(land)
    wh.apply_batch("2026-01")
    orig = wh._fold_dim2

    def failing(entity, *a, **k):
        if entity == "products":
            raise RuntimeError("executor lost")
        return orig(entity, *a, **k)
    wh._fold_dim2 = failing
    with pytest.raises(RuntimeError):
        wh.apply_batch("2026-02")  # customer chain written, product chain failed
    assert wh.committed() == ["2026-01"]
    assert rows(wh.dim2("customers"), "customer_id", "city") == [(1, "Rome"), (2, "Oslo")]
    wh._fold_dim2 = orig
    wh.run_silver(mode="fold")
    assert _dims(wh) == _dims(clean)


def test_typed_parquet_orders_become_strings(spark, tmp_path):
    import datetime as _dt
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    land = _landing(tmp_path)
    t = pa.table({"order_id": pa.array([50], pa.int64()),
                  "customer_id": pa.array([1], pa.int32()),
                  "product_id": pa.array(["P1"]),
                  "amount": pa.array([9.5], pa.float64()),
                  "order_date": pa.array([_dt.date(2026, 1, 9)], pa.date32())})
    os.makedirs(os.path.join(land, "orders_typed"), exist_ok=True)
    pq.write_table(t, os.path.join(land, "orders_typed", "orders_2026-01.parquet"))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    from keelson.streaming.ingest import ingest_bronze
    n = ingest_bronze(spark, "orders", os.path.join(land, "orders_typed"),
                      wh.path("bronze_raw_orders"), str(tmp_path / "ck"), "parquet")
    assert n == 1
    b = wh.bronze("orders").first()
    assert (b.order_id, b.customer_id, b.amount, b.order_date, b.batch_key) == \
        ("50", "1", "9.5", "2026-01-09", "2026-01")


def test_late_file_of_committed_batch_reaches_only_the_fact(spark, tmp_path):
    land = _landing(tmp_path)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    before = _dims(wh)
    write_customers(land, "late/customers_2026-01.json", [("1", "Ann", "Bern", "2026-01-20")])
    write_orders(land, "late_orders_2026-01.parquet", [("12", "2", "P1", "8.0", "2026-01-21")])
    rep = wh.run(land)
    assert rep["silver"]["applied"] == [] and _dims(wh) == before
    assert 12 in [r.order_id for r in wh.fact().collect()]


def test_bucketed_fold_equals_plain_and_shuffles_only_the_batch(spark, tmp_path):
    from keelson.operators import scd
    land = _landing(tmp_path)
    write_customers(land, "customers_2026-02.json", [("1", "Ann", "Paris", "2026-02-03"),
                                                      ("3", "Cy", "Oslo", "2026-02-04")])
    write_products(land, "products_2026-02.csv", [("P1", "Pen", "Y", "1.5", "2025-06-01")])
    plain = Warehouse(spark, str(tmp_path / "plain"))
    plain.ingest(land)
    plain.run_silver(mode="fold")
    wh = Warehouse(spark, str(tmp_path / "bucketed"), buckets=4)
    wh.ingest(land)
    wh.run_silver(mode="fold")
    assert _dims(wh) == _dims(plain)
    # the open versions are read as a bucketed scan, also from a fresh catalog entry
    spark.sql(f"DROP TABLE IF EXISTS {wh._state_table('customers', '2026-02')}")
    cur = wh._open_versions("customers", "2026-02")
    assert cur.count() == 3
    stg = spark.createDataFrame([(1, "Ann", "Rome", D(2026, 3, 1))],
                                "customer_id int, name string, city string, event_date date")
    step = scd.scd2_step(cur, stg, "customer_id", ["name", "city"], F.col("event_date"),
                         small_batch=False)
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan


def test_bucketed_bulk_then_fold(spark, tmp_path):
    land = _landing(tmp_path)
    for m, city in ((2, "Paris"), (3, "Bern")):
        write_customers(land, f"customers_2026-0{m}.json", [("1", "Ann", city, f"2026-0{m}-03")])
        write_products(land, f"products_2026-0{m}.csv", [("P1", "Pen", f"C{m}", "1.5", "2025-06-01")])
    plain = Warehouse(spark, str(tmp_path / "plain"))
    plain.ingest(land)
    plain.run_silver(mode="fold")
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    wh.ingest(land)
    wh.apply_bulk(["2026-01", "2026-02"])
    assert wh._bucketed(f"{wh.path('silver_dim_customers_type2')}/batch_key=2026-02/is_current=true")
    assert wh.run_silver(mode="fold")["applied"] == ["2026-03"]
    assert _dims(wh) == _dims(plain)


def test_discovery_reads_only_rows_ingested_after_the_mark(spark, tmp_path):
    land = _landing(tmp_path)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh._discovery_mark() is None
    wh.run(land)
    mark = wh._discovery_mark()
    assert mark is not None
    # nothing new since the mark: no row is read, nothing pending
    assert wh._batch_rows(mark).count() == 0 and wh.pending() == []
    write_customers(land, "customers_2026-02.json", [("1", "Ann", "Paris", "2026-02-03")])
    wh.ingest(land)
    window = wh._batch_rows(mark)
    assert rows(window, "batch_key") == [("2026-02",)]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan
    assert wh.pending() == ["2026-02"]
    # the mark moves only when everything found is committed
    wh._commit_orig, wh._commit = wh._commit, lambda bks: None
    wh.run_silver(mode="fold")
    assert wh._discovery_mark() == mark
    wh._commit = wh._commit_orig
    assert wh.run_silver(mode="fold")["applied"] == ["2026-02"]
    assert wh._discovery_mark() > mark and wh.pending() == []
    assert wh.committed() == ["2026-01", "2026-02"]


def test_ingest_count_survives_dropped_progress(spark, tmp_path):
    # more micro-batches than Spark keeps progress entries for
    land = str(tmp_path / "landing")
    for m in range(1, 5):
        write_customers(land, f"customers_2026-0{m}.json",
                        [(str(i), f"N{i}", "Rome", f"2026-0{m}-02") for i in range(m)])
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        wh = Warehouse(spark, str(tmp_path / "wh"), max_files_per_trigger=1)
        got = wh.ingest(land)["customers"]
    finally:
        spark.conf.set(key, old)
    assert got == 1 + 2 + 3 + 4 == wh.bronze("customers").count()
    # a second run with one more file counts only its own rows
    write_customers(land, "customers_2026-05.json", [("9", "Z", "Oslo", "2026-05-02")])
    spark.conf.set(key, "1")
    try:
        assert wh.ingest(land)["customers"] == 1
    finally:
        spark.conf.set(key, old)


def test_runs_without_orders_then_with_only_rejected_orders(spark, tmp_path):
    # empty inputs under shuffles: the observed counts must still be read
    land = str(tmp_path / "landing")
    write_customers(land, "customers_2026-01.json", [("1", "Ann", "Rome", "2026-01-05")])
    write_products(land, "products_2026-01.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    r = wh.run(land)
    assert r["silver"]["applied"] == ["2026-01"] and r["silver"]["fact_rows"] == 0
    assert set(r["gold"].values()) == {0}
    write_orders(land, "orders_2026-01.parquet", [("bad", "1", "P1", "3.0", "2026-01-07")])
    r = wh.run(land)
    assert r["ingested"]["orders"] == 1 and r["silver"]["fact_rows"] == 0
    assert wh.fact().count() == 0 and set(r["gold"].values()) == {0}


def test_backdated_file_is_read(spark, tmp_path):
    import os
    import time

    land = str(tmp_path / "landing")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    counts = []
    for m, back in ((1, 0), (2, 30), (3, 0)):
        name = f"customers_2026-0{m}.json"
        write_customers(land, name, [(str(m), "Ann", "Rome", f"2026-0{m}-05")])
        when = time.time() - back * 86400
        for folder, _, files in os.walk(land):
            for f in files:
                if name in os.path.join(folder, f):
                    os.utime(os.path.join(folder, f), (when, when))
        counts.append(wh.ingest(land)["customers"])
    assert counts == [1, 1, 1]
    assert rows(wh.bronze("customers"), "batch_key") == [("2026-01",), ("2026-02",), ("2026-03",)]
    from keelson.streaming.ingest import unread_files
    assert unread_files(spark, f"{land}/customers", wh.bronze("customers")).isEmpty()
    write_customers(land, "customers_2026-04.json", [("4", "Ann", "Rome", "2026-04-05")])
    assert unread_files(spark, f"{land}/customers", wh.bronze("customers")).count() == 1


def test_ids_above_int_reach_the_tables(spark, tmp_path):
    land = str(tmp_path / "landing")
    write_customers(land, "customers_2026-01.json", [("3000000001", "Ann", "Rome", "2026-01-05")])
    write_products(land, "products_2026-01.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    write_orders(land, "orders_2026-01.parquet", [("3000000000", "3000000001", "P1", "3.0", "2026-01-07")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    assert rows(wh.fact(), "order_id", "customer_id") == [(3000000000, 3000000001)]
    assert rows(wh.table("gold_agg_sales_by_city"), "city", "total_orders") == [("Rome", 1)]


def test_fact_crash_while_an_order_moves(spark, tmp_path):
    """The order's old partition empties; the run stops before it is removed."""
    land = str(tmp_path / "landing")
    write_customers(land, "customers_2026-01.json", [("1", "Ann", "Rome", "2026-01-05")])
    write_products(land, "products_2026-01.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    write_orders(land, "orders_2026-01.parquet", [("10", "1", "P1", "3.0", "2026-01-07"),
                                                  ("11", "1", "P1", "3.0", "2026-02-07")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    write_orders(land, "orders_2026-03.parquet", [("10", "1", "P1", "3.0", "2026-03-07")])
    wh.ingest(land)

    def stop(path):
        raise RuntimeError("stopped")
    wh._drop_folder = stop
    with pytest.raises(RuntimeError):
        wh.build_fact()
    del wh._drop_folder
    want = [(10, 2026, 3), (11, 2026, 2)]
    wh.build_fact()
    assert rows(wh.fact(), "order_id", "year", "month") == want
    wh.build_fact(full=True)
    assert rows(wh.fact(), "order_id", "year", "month") == want


def test_bulk_rerun_after_a_stop_starts_clean(spark, tmp_path):
    land = str(tmp_path / "landing")
    for m, city in ((1, "x"), (2, "y")):
        write_customers(land, f"customers_2026-0{m}.json", [("1", "Ann", city, f"2026-0{m}-02")])
        write_products(land, f"products_2026-0{m}.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.ingest(land)
    commit, wh._commit = wh._commit, lambda bks: None
    wh.run_silver(mode="bulk")
    wh._commit = commit
    # a further file of the second batch: the city never changed
    write_customers(land, "more/customers_2026-02.json", [("1", "Ann", "x", "2026-02-20")])
    wh.ingest(land)
    wh.run_silver(mode="bulk")
    clean = Warehouse(spark, str(tmp_path / "clean"))
    clean.ingest(land)
    clean.run_silver(mode="bulk")
    assert _dims(wh) == _dims(clean) and clean.dim2("customers").count() == 1


def test_states_inside_a_bulk_commit_equal_the_fold(spark, tmp_path):
    land = str(tmp_path / "landing")
    for m, city in ((1, "x"), (2, "y"), (3, "z")):
        write_customers(land, f"customers_2026-0{m}.json", [("1", "Ann", city, f"2026-0{m}-02")])
        write_products(land, f"products_2026-0{m}.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    bulk, fold = Warehouse(spark, str(tmp_path / "bulk")), Warehouse(spark, str(tmp_path / "fold"))
    for wh, mode in ((bulk, "bulk"), (fold, "fold")):
        wh.ingest(land)
        wh.run_silver(mode=mode)
    for m in (1, 2, 3):
        bk = f"2026-0{m}"
        assert rows(bulk.dim1(bk), "city", "update_date") == rows(fold.dim1(bk), "city", "update_date")
        for e in ("customers", "products"):
            cols = bulk.dim2(e).columns
            assert _text(bulk.dim2(e, bk), cols) == _text(fold.dim2(e, bk), cols)
        assert bulk.dim2("customers", bk).count() == m
    with pytest.raises(ValueError, match="not committed"):
        bulk.dim2("customers", "2026-04")
    # a second backlog on top of the first: states inside it start from the first
    for m, city in ((4, "x"), (5, "y")):
        write_customers(land, f"customers_2026-0{m}.json", [("1", "Ann", city, f"2026-0{m}-02"),
                                                            ("2", "Bob", city, f"2026-0{m}-03")])
    for wh, mode in ((bulk, "bulk"), (fold, "fold")):
        wh.ingest(land)
        wh.run_silver(mode=mode)
    for m in range(1, 6):
        bk, cols = f"2026-0{m}", bulk.dim2("customers").columns
        assert rows(bulk.dim1(bk), "customer_id", "city") == rows(fold.dim1(bk), "customer_id", "city")
        assert _text(bulk.dim2("customers", bk), cols) == _text(fold.dim2("customers", bk), cols)


def _text(df, cols):
    return sorted(repr(r) for r in df.select(*cols).collect())


def test_run_log_holds_what_each_step_did(spark, tmp_path):
    land = _landing(tmp_path)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.run_log().isEmpty()
    wh.run(land, as_of="2026-03-01")
    got = {(r.item, r.name): r.n for r in wh.run_log().collect()}
    assert got[("ingested", "bronze_raw_customers")] == 2 and got[("pending", "2026-01")] == 1
    assert got[("staged", "silver_stg_customers/2026-01")] == 2
    assert got[("fact", "silver_fact_orders")] == 2 and got[("gold", "gold_agg_sales_by_city")] == 1
    wh.run(land, as_of="2026-03-01")
    assert rows(wh.run_log().where("item = 'applied'"), "name") == [("2026-01",)]


def test_bulk_equals_the_fold_where_an_accepted_null_comes_first(spark, tmp_path):
    land = str(tmp_path / "landing")
    for m, cat in ((1, None), (2, "X"), (3, "Y"), (4, None), (5, "X"), (6, "Z")):
        write_customers(land, f"customers_2026-0{m}.json", [("1", "Ann", "Rome", f"2026-0{m}-02")])
        write_products(land, f"products_2026-0{m}.csv", [("P1", "Pen", cat, "1.5" if m < 3 else "2.5", "2025-06-01")])
    bulk, fold = Warehouse(spark, str(tmp_path / "bulk")), Warehouse(spark, str(tmp_path / "fold"))
    for wh, mode in ((bulk, "bulk"), (fold, "fold")):
        wh.ingest(land)
        wh.run_silver(mode=mode)
    for bk in ("2026-03", "2026-06"):
        cols = bulk.dim2("products").columns
        assert _text(bulk.dim2("products", bk), cols) == _text(fold.dim2("products", bk), cols)


def test_bucket_count_may_change(spark, tmp_path):
    land = str(tmp_path / "landing")
    people = [(str(i), f"N{i}", "Rome", "2026-01-05") for i in range(200)]
    write_customers(land, "customers_2026-01.json", people)
    write_products(land, "products_2026-01.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    root = str(tmp_path / "wh")
    first = Warehouse(spark, root, buckets=8)
    first.ingest(land)
    first.run_silver(mode="fold")
    for e in ("customers", "products"):  # as a new session would find it
        spark.sql(f"DROP TABLE IF EXISTS {first._state_table(e, '2026-01')}")
    write_customers(land, "customers_2026-02.json", [(i, n, "Oslo", "2026-02-05") for i, n, *_ in people[:100]])
    write_products(land, "products_2026-02.csv", [("P1", "Pen", "X", "1.5", "2025-06-01")])
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        again = Warehouse(spark, root, buckets=16)
        again.ingest(land)
        again.run_silver(mode="fold")
        current = again.current_versions("customers")
        assert current.count() == 200 == current.select("customer_id").distinct().count()
        assert current.where("city = 'Oslo'").count() == 100
        assert again._stored_buckets("customers", "2026-01") == 8
        assert again._stored_buckets("customers", "2026-02") == 16
    finally:
        spark.conf.set(key, old)


def test_gold_is_rebuilt_only_after_a_change(spark, tmp_path):
    land = _landing(tmp_path)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    first = wh.run(land, as_of="2026-03-01")["gold"]
    built = []
    real, wh.run_gold = wh.run_gold, lambda *a, **k: built.append(a) or real(*a, **k)
    assert wh.run(land, as_of="2026-03-01")["gold"] == first and not built
    wh.run(land, as_of="2026-03-02")  # another date
    assert len(built) == 1
    write_orders(land, "orders_2026-02.parquet", [("20", "2", "P1", "2.0", "2026-02-01")])
    assert wh.run(land, as_of="2026-03-02")["gold"]["gold_agg_sales_by_city"] == 2 and len(built) == 2
    # a build that stopped half way is repeated
    wh._log_gold("started", "", {})
    wh.run(land, as_of="2026-03-02")
    assert len(built) == 3
    # Silver changed in a run that stopped before Gold
    write_orders(land, "orders_2026-04.parquet", [("40", "2", "P1", "2.0", "2026-04-01")])
    wh.ingest(land)
    wh.run_silver()
    wh.run(land, as_of="2026-03-02")
    assert len(built) == 4
