"""Late rows, whole rewrites of the fact, the order locator, Parquet types, bounded ingest."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from keelson import paths
from keelson.operators import scd
from keelson.plans.warehouse import Warehouse
from keelson.streaming import ingest
from tests.helpers import rows, write_customers, write_orders, write_products

D = dt.date
COLS = ("order_id", "customer_id", "amount", "order_date", "year", "month")


def feed(land, month, city, cat="X", who="1"):
    write_customers(land, f"customers_2026-{month:02d}.json", [(who, "Ann", city, f"2026-{month:02d}-03")])
    write_products(land, f"products_2026-{month:02d}.csv", [("P1", "Pen", cat, "1.5", "2025-06-01")])


def orders(land, name, *rs):
    write_orders(land, f"{name}.parquet", [(str(i), "1", "P1", str(a), day) for i, a, day in rs])


# ------------------------------------------------------------------ ingest --

def typed(path, ids, order_ids, extra=False):
    n = len(order_ids)
    cols = {"order_id": pa.array(order_ids, ids), "customer_id": pa.array([1] * n, pa.int32()),
            "product_id": pa.array(["P1"] * n), "amount": pa.array([9.5] * n, pa.float64()),
            "order_date": pa.array([D(2026, 1, 9)] * n, pa.date32())}
    if extra:
        cols["note"] = pa.array(["x"] * n)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(cols), path)


def test_parquet_files_of_differing_types_in_one_run_and_later(spark, tmp_path):
    land = str(tmp_path / "land")
    for k in range(3):
        typed(f"{land}/orders/a{k}/orders_2026-01.parquet", pa.int64(), [10 + k])
        typed(f"{land}/orders/b{k}/orders_2026-01.parquet", pa.int32(), [20 + k], extra=True)
    orders(land, "c_orders_2026-01", ("30", 2.5, "2026-01-08"), ("bad", 1, "2026-01-08"))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.ingest(land)["orders"] == 8
    typed(f"{land}/orders/d/orders_2026-02.parquet", pa.int64(), [2**40])
    assert wh.ingest(land)["orders"] == 1 and wh.ingest(land)["orders"] == 0
    got = rows(wh.bronze("orders"), "order_id", "customer_id", "amount", "order_date")
    assert got[0] == ("10", "1", "9.5", "2026-01-09") and ("30", "1", "2.5", "2026-01-08") in got
    assert {g[0] for g in got} == {"10", "11", "12", "20", "21", "22", "30", "bad", str(2**40)}


def test_schema_groups_are_few_and_whole(spark, tmp_path):
    files = []
    for k in range(9):
        path = f"{tmp_path}/f{k}.parquet"
        typed(path, (pa.int64(), pa.string())[k % 2] if k < 4 else pa.int64(), [str(k) if k < 4 and k % 2 else k])
        files.append(path)
    groups = ingest.schema_groups(spark, files)
    assert sorted(sum((g[1] for g in groups), [])) == files
    assert sorted(len(g[1]) for g in groups) == [2, 7]


def test_a_file_without_a_column_stops_the_feed_until_mended(spark, tmp_path):
    land = str(tmp_path / "land")
    os.makedirs(f"{land}/orders")
    path = f"{land}/orders/orders_2026-01.parquet"
    pq.write_table(pa.table({"order_id": ["1"]}), path)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for _ in range(2):
        with pytest.raises(Exception, match="lack columns"):
            wh.ingest(land)
    assert wh.bronze("orders").isEmpty()
    typed(path, pa.int64(), [1])
    assert wh.ingest(land)["orders"] == 1 and wh.bronze("orders").count() == 1


def test_a_stopped_ingest_is_invisible_and_replaced(spark, tmp_path, monkeypatch):
    land = str(tmp_path / "land")
    feed(land, 1, "Rome")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.ingest(land)
    feed(land, 2, "Oslo")
    note = ingest.note_parts

    def stop(*a):
        raise RuntimeError("stopped")
    monkeypatch.setattr(ingest, "note_parts", stop)
    with pytest.raises(Exception, match="stopped"):
        wh.ingest(land)
    bronze = wh.path("bronze_raw_customers")
    assert paths.exists(spark, f"{bronze}/ingest_id=1") and ingest.bronze_parts(spark, bronze).count() == 1
    assert rows(wh.bronze("customers"), "city") == [("Rome",)]
    assert wh.bronze("customers", batch_keys=["2026-02"]).isEmpty()
    monkeypatch.setattr(ingest, "note_parts", note)
    feed(land, 3, "Bern")
    assert wh.ingest(land)["customers"] == 2
    assert rows(wh.bronze("customers"), "city") == [("Bern",), ("Oslo",), ("Rome",)]


def test_a_batch_lists_only_its_own_folders(spark, tmp_path):
    land = str(tmp_path / "land")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for m in (1, 2, 3):
        feed(land, m, f"C{m}")
        wh.ingest(land)
    one = wh.bronze("customers", batch_keys=["2026-02"])
    assert rows(one, "city") == [("C2",)]
    assert len(one.inputFiles()) == 1 and "batch_key=2026-02" in one.inputFiles()[0]


def test_a_backlog_is_read_in_slices(spark, tmp_path):
    land = str(tmp_path / "land")
    for k in range(7):
        write_customers(land, f"f{k}/customers_2026-01.json", [(str(k), "A", "B", "2026-01-02")])
    wh = Warehouse(spark, str(tmp_path / "wh"), max_files_per_trigger=3)
    assert wh.ingest(land)["customers"] == 7
    parts = ingest.bronze_parts(spark, wh.path("bronze_raw_customers"))
    assert rows(parts, "ingest_id")[-1][0] >= 2 and max(r.n for r in parts.collect()) <= 3


# ------------------------------------------------------------------- fact --

def test_a_reader_during_a_stopped_rewrite_sees_the_state_before(spark, tmp_path):
    land = str(tmp_path / "land")
    feed(land, 1, "Rome")
    orders(land, "orders_2026-01", (1, 1.0, "2026-01-02"), (2, 2.0, "2026-02-02"))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    before = rows(wh.fact(), *COLS)
    orders(land, "orders_2026-03", (1, 5.0, "2026-03-05"), (3, 3.0, "2026-02-09"))
    wh.ingest(land)
    held = wh.fact()  # resolved before the build
    for step in ("write", "note_done"):
        real_write, real_log = wh._fact.write, wh._log_fact

        def stop_write(*a, **k):
            real_write(*a, **k)
            raise RuntimeError("stopped")

        def stop_log(phase, *a):
            if phase == "done":
                raise RuntimeError("stopped")
            real_log(phase, *a)
        if step == "write":
            wh._fact.write = stop_write
        else:
            wh._log_fact = stop_log
        with pytest.raises(RuntimeError):
            wh.build_fact()
        wh._fact.write, wh._log_fact = real_write, real_log
        assert rows(wh.fact(), *COLS) == before
        assert rows(Warehouse(spark, wh.root).fact(), *COLS) == before
    assert wh.build_fact() == 3  # from the last finished state, not a full restatement
    assert rows(wh.fact(), "order_id", "month") == [(1, 3), (2, 2), (3, 2)]
    assert rows(held, *COLS) == before  # a reader that began earlier can finish
    orders(land, "orders_2026-04", (2, 9.0, "2026-04-05"))
    wh.ingest(land)
    wh.build_fact()
    full = Warehouse(spark, str(tmp_path / "full"))
    full.ingest(land)
    full.build_fact(full=True)
    assert rows(wh.fact(), *COLS) == rows(full.fact(), *COLS)
    wh.build_fact(full=True)
    assert rows(wh.fact(), *COLS) == rows(full.fact(), *COLS)


def test_replaced_folders_go_one_build_later(spark, tmp_path):
    land = str(tmp_path / "land")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for k in range(4):
        orders(land, f"x{k}_orders_2026-01", (k, 1.0, "2026-01-02"), (100 + k, 1.0, f"2026-0{k + 2}-02"))
        wh.ingest(land)
        wh.build_fact()
    january = [a for a in range(1, 5) if paths.exists(spark, wh._fact._folder((2026, 1), a))]
    assert january == [3, 4]
    assert wh.fact().count() == 8


def test_locator_names_the_months_without_reading_the_fact(spark, tmp_path):
    land = str(tmp_path / "land")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    first = [(k * 40_000 + j, 1.0, f"2026-{k + 1:02d}-02") for k in range(6) for j in (1, 32_768, 32_769)]
    orders(land, "orders_2026-01", *first, (0, 1.0, "2026-08-01"), (-5, 1.0, "2026-08-01"), (7, 1.0, None))
    wh.ingest(land)
    wh.build_fact()
    keys = spark.createDataFrame([(1,), (2,), (0,), (-5,), (7,), (40_000 + 32_768,), (5 * 40_000 + 32_769,), (10**12,)], "order_id bigint")
    found = wh._fact.locate(keys)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, 2026, 1), (0, 2026, 8), (-5, 2026, 8), (7, None, None), (40_000 + 32_768, 2026, 2),
         (5 * 40_000 + 32_769, 2026, 6)], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(bucket" in plan
    assert found.inputFiles() and all("/_ids/attempt=" in f for f in found.inputFiles())
    # a later build reads and writes only the month of its orders
    orders(land, "orders_2026-07", (1, 3.0, "2026-01-09"), (999_999, 1.0, "2026-07-01"))
    wh.ingest(land)
    assert wh.build_fact() == 3 + 1
    assert {p: a for p, a in wh._fact.current_parts().items() if a == 2} == {(2026, 1): 2, (2026, 7): 2}
    got = wh.fact([(2026, 1)])
    assert got.count() == 3 and all("month=1/" in f for f in got.inputFiles())


def test_random_ids_are_located_exactly(spark, tmp_path):
    import random
    rnd = random.Random(2)
    land = str(tmp_path / "land")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    where = {}
    for wave in range(3):
        rs = [(rnd.randrange(-200, 200_000), 1.0 + wave, f"2026-{rnd.randrange(1, 6):02d}-0{wave + 1}") for _ in range(60)]
        rs += [(i, 9.0, f"2026-{rnd.randrange(6, 9):02d}-0{wave + 1}") for i in rnd.sample(sorted(where), min(len(where), 10))]
        for i, _, day in rs:
            where[i] = max(where.get(i, ""), day)
        orders(land, f"w{wave}_orders_2026-01", *rs)
        wh.ingest(land)
        wh.build_fact()
    want = sorted((i, int(day[5:7])) for i, day in where.items())
    assert rows(wh.fact(), "order_id", "month") == want
    keys = spark.createDataFrame([(i,) for i in [*where, 500_000, -900]], "order_id bigint")
    assert rows(wh._fact.locate(keys), "order_id", "month") == want


# ------------------------------------------------------------------- late --

def late_case(spark, tmp_path, modes, null_safe=False):
    """A warehouse that gets a file of batch 2 late, and one that had it in time."""
    land, both = str(tmp_path / "land"), str(tmp_path / "both")
    wh = Warehouse(spark, str(tmp_path / "wh"), late="replay", null_safe=null_safe)
    in_time = Warehouse(spark, str(tmp_path / "in_time"), null_safe=null_safe)
    cities = {1: "a", 2: "a", 3: "b", 4: "a", 5: "c"}

    def put(root, m, late):
        if not late:
            feed(root, m, cities[m], f"cat{m % 2}")
            write_customers(root, f"n/customers_2026-{m:02d}.json", [("2", "Bob", cities[m], f"2026-{m:02d}-04")])
        else:
            write_customers(root, f"late/customers_2026-{m:02d}.json", [("1", "Ann", "z", f"2026-{m:02d}-28"), ("9", "New", "q", f"2026-{m:02d}-05"),
                                                                       ("bad", "x", "y", "2026-02-01")])
            write_products(root, f"late_products_2026-{m:02d}.csv", [("P1", "Pen", "late", "1.0", "2025-06-01"), ("P7", "Ink", "k", "2.0", "2025-06-01")])

    for m in (1, 2, 3, 4):
        put(land, m, False)
    wh.ingest(land)
    wh.run_silver(mode=modes[0])
    put(land, 2, True)
    wh.ingest(land)
    report = wh.run_silver(mode=modes[0])
    assert sorted((e, b, n) for e, b, n in report["late"]) == [("customers", "2026-02", 3), ("products", "2026-02", 2)]
    assert report["applied"] == []
    for m in (1, 2, 3, 4, 5):
        put(both, m, False)
    put(both, 2, True)
    in_time.ingest(both)
    in_time.run_silver(mode=modes[1])
    return wh, in_time, land, put


def test_replayed_late_rows_equal_a_build_in_time(spark, tmp_path):
    wh, in_time, land, put = late_case(spark, tmp_path, ("bulk", "fold"))

    def same(bks):
        for bk in bks:
            for e, k in (("customers", "customer_id"), ("products", "product_id")):
                cols = wh.dim2(e, bk).columns
                assert rows(wh.dim2(e, bk), k, "valid_from", "is_current") == rows(in_time.dim2(e, bk), k, "valid_from", "is_current"), bk
                assert sorted(map(repr, wh.dim2(e, bk).select(*cols).collect())) == sorted(map(repr, in_time.dim2(e, bk).select(*cols).collect()))
            assert rows(wh.dim1(bk), "customer_id", "city", "update_date") == rows(in_time.dim1(bk), "customer_id", "city", "update_date")
    same(["2026-02", "2026-03"])
    assert (1, "z", D(2026, 2, 28)) in rows(wh.dim2("customers"), "customer_id", "city", "valid_from")
    put(land, 5, False)
    wh.ingest(land)
    assert wh.run_silver(mode="fold")["applied"] == ["2026-05"]
    same(["2026-04", "2026-05"])
    assert wh.replay_late() == {} and wh.run_silver()["late"] == []
    files = rows(wh.late_rows(), "entity", "batch_key", "n")
    assert files == [("customers", "2026-02", 3), ("products", "2026-02", 2)]
    assert all("late" in r.source_file for r in wh.late_rows().collect())


def test_a_second_late_file_and_stops_in_the_replay(spark, tmp_path):
    wh, in_time, land, put = late_case(spark, tmp_path, ("fold", "fold"))
    put(land, 5, False)
    wh.ingest(land)
    wh.run_silver()
    for root, w in ((land, wh), (str(tmp_path / "both"), None)):
        write_customers(root, "late2/customers_2026-03.json", [("1", "Ann", "y", "2026-03-30"), ("2", "Bob", "w", "2026-03-30")])
    wh.ingest(land)
    commit, wh._late.commit = wh._late.commit, lambda *a: (_ for _ in ()).throw(RuntimeError("stopped"))
    before = rows(wh.dim2("customers"), "customer_id", "city", "valid_from")
    with pytest.raises(RuntimeError):
        wh.run_silver()
    assert rows(wh.dim2("customers"), "customer_id", "city", "valid_from") == before
    wh._late.commit = commit
    wh.run_silver()
    clean = Warehouse(spark, str(tmp_path / "clean"))
    clean.ingest(str(tmp_path / "both"))
    clean.run_silver(mode="fold")
    for bk in ("2026-02", "2026-05"):
        cols = clean.dim2("customers").columns
        assert sorted(map(repr, wh.dim2("customers", bk).select(*cols).collect())) == sorted(map(repr, clean.dim2("customers", bk).select(*cols).collect()))


def test_late_rows_are_recorded_and_not_applied_by_default(spark, tmp_path):
    land = str(tmp_path / "land")
    feed(land, 1, "Rome")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.run(land)
    assert wh.late_rows().isEmpty()
    write_customers(land, "late/customers_2026-01.json", [("1", "Ann", "Bern", "2026-01-20")])
    wh.run(land)
    assert [(r.entity, r.batch_key, r.n) for r in wh.late_rows().collect()] == [("customers", "2026-01", 1)]
    assert rows(wh.dim2("customers"), "city") == [("Rome",)]
    assert rows(wh.run_log().where("item = 'late'"), "name", "n") == [("customers/2026-01", 1)]
    wh.run(land)
    assert wh.late_rows().count() == 1
    assert wh.replay_late() == {"customers": 1}
    assert rows(wh.dim2("customers"), "city") == [("Bern",)]


def test_history_equals_the_fold_across_nulls(spark):
    import random
    rnd = random.Random(8)
    data = [(k, f"2026-{b:02d}", rnd.choice(["x", "y", None]), rnd.choice([1, None]), D(2026, b, 1))
            for k in range(120) for b in range(1, 8) if rnd.random() < 0.8]
    stg = spark.createDataFrame(data, "id int, batch_key string, a string, b int, day date").cache()
    empty = stg.select("id", "a", "b", F.col("day").alias("valid_from")).where("false")
    for null_safe in (False, True):
        open_, closed = empty, []
        for bk in sorted({r[1] for r in data}):
            step = scd.scd2_step(open_, stg.where(F.col("batch_key") == bk).drop("batch_key"), "id", ["a", "b"], F.col("day"), null_safe).cache()
            closed += [tuple(r) for r in step.where("not is_current").collect()]
            open_ = step.where("is_current").select("id", "a", "b", "valid_from")
        want = closed + [(*r, None, True) for r in (tuple(x) for x in open_.collect())]
        got = scd.scd2_history(stg, "id", ["a", "b"], F.col("day"), null_safe)
        assert sorted(map(repr, (tuple(r) for r in got.drop("opened_by", "closed_by").collect()))) == sorted(map(repr, want))
        now = scd.versions_as_of(got, "2026-07").drop("opened_by", "closed_by")
        assert sorted(map(repr, (tuple(r) for r in now.collect()))) == sorted(map(repr, want))
