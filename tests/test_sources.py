"""Files in the layout of the source systems, written by hand."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.dimensions import concat_by_name, mapping_table, require_non_empty
from shelfwise.operators.reports import first_suggestion_date
from shelfwise.sources import files, layouts, ledger, scratch, tables

SOURCE = "43YYYYYYYYYYYYY"


def put(path, lines, mtime=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))


def cost_line(store, item, date, quantity, sale, cost, cmid=43):
    cells = ["skip", store, item, date, "skip", quantity, sale, cost] + ["skip"] * 5 + [cmid]
    return ",".join(map(str, cells))


@pytest.fixture
def bucket(tmp_path):
    for day in (1, 2, 4):
        put(
            tmp_path / f"2024/01/{day:02d}/{SOURCE}/cost/part0.gz",
            [cost_line("007", "0012", f"2024-01-{day:02d}", day, "" if day == 2 else "2.5", "1")],
        )
    put(tmp_path / f"2024/01/04/{SOURCE}/cost/part1.gz", [cost_line("008", "0012", "2024-01-04", 9, "-1", "1")])
    put(tmp_path / f"2024/01/04/{SOURCE}/inventory/part0.gz", ["43,007,0012,2024-01-04,", "43,007,0013,2024-01-04,3.5"])
    put(tmp_path / f"2024/01/04/{SOURCE}/chain_store/chain_store000.gz", ["43,007,Shop,x,x,x,闭店"])
    return tmp_path


def test_cost_by_position_and_window(spark, bucket):
    days = files.days_back("2024-01-04", 3)
    assert days == ["2024-01-02", "2024-01-03", "2024-01-04"]
    rows = sorted(tuple(r) for r in files.read_cost(spark, str(bucket), days, SOURCE).collect())
    assert [(r[1], r[2], r[3].day, float(r[5]), r[7]) for r in rows] == [
        ("007", "0012", 2, 0.0, 0),
        ("007", "0012", 4, 2.5, 1),
        ("008", "0012", 4, -1.0, 0),
    ]


def test_missing_days_are_empty(spark, bucket):
    days = ["2024-03-01", "2024-03-02"]
    with pytest.raises(FileNotFoundError):
        files.read_cost(spark, str(bucket), days, SOURCE)
    none = files.read_cost(spark, str(bucket), days, SOURCE, none_ok=True)
    assert none.isEmpty() and none.columns[0] == "cmid"


def test_only_wanted_columns_are_read(spark, bucket):
    df = files.read_cost(spark, str(bucket), ["2024-01-04"], SOURCE).select("foreign_store_id")
    assert "unused_" not in df._jdf.queryExecution().executedPlan().toString()


def test_inventory_and_stores(spark, bucket):
    stock = files.read_inventory(spark, str(bucket), ["2024-01-04"], SOURCE).collect()
    assert {r.foreign_item_id: float(r.quantity) for r in stock} == {"0012": 0.0, "0013": 3.5}
    assert [tuple(r) for r in files.read_stores(spark, str(bucket), "2024-01-04", SOURCE).collect()] == [
        (43, "007", "Shop", "闭店")
    ]


def goods_line(item, name, lastin, sale, status, code):
    return ",".join(["43", f"69{item}", item, name, lastin, sale, "x", status] + ["x"] * 8 + [code])


def test_goods_newest_object_rejects_and_status(spark, tmp_path):
    folder = tmp_path / f"2024/01/04/{SOURCE}/chain_goods"
    put(folder / "old.gz", [goods_line("0099", "old", "1", "2", "正常", "C99")], mtime=1_700_000_000)
    put(
        folder / "new.gz",
        [
            goods_line("0001", "fine", "1.5", "2", "正常", "C1"),
            goods_line("0002", "no status", "1", "", "", "C2"),
            goods_line("0003", "gone", "1", "2", "淘汰", "C3"),
            goods_line("0004", "gone too", "1", "2", "淘汰品", "C4"),
            goods_line("0005", "split, name", "1", "2", "正常", "C5"),
            goods_line("0005", "same item", "1", "2", "正常", "C5"),
        ],
        mtime=1_700_000_100,
    )
    rows = files.read_goods(spark, str(tmp_path), "2024-01-04", SOURCE).collect()
    assert {r.foreign_item_id: (r.lastin_price and float(r.lastin_price), r.show_code) for r in rows} == {
        "0001": (1.5, "C1"),
        "0002": (1.0, "C2"),
    }


def test_goods_need_an_object(spark, tmp_path):
    (tmp_path / f"2024/01/04/{SOURCE}/chain_goods").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        files.read_goods(spark, str(tmp_path), "2024-01-04", SOURCE)


def test_listing_newest_and_oldest(spark, tmp_path):
    for n, name in enumerate(["dist/43/1/2024-01-02.csv.gz", "dist/43/2/2024-01-01.csv.gz", "dist/43/2/notes.txt"]):
        put(tmp_path / name, ["x"], mtime=1_700_000_000 + n)
    listing = files.object_listing(spark, str(tmp_path), "*.csv.gz")
    assert listing.count() == 2
    assert files.newest_path(listing).endswith("2/2024-01-01.csv.gz")
    assert files.newest_path(listing, oldest=True).endswith("1/2024-01-02.csv.gz")
    keyed = listing.withColumn("cmid", files.path_part(F.col("path"), 3).cast("int"))
    assert [tuple(r) for r in first_suggestion_date(keyed).collect()] == [(43, dt.date(2024, 1, 2))]
    assert files.newest_path(listing.filter("length < 0")) is None


@pytest.fixture
def reports(tmp_path):
    for store, date in (("1", "2024-01-01"), ("1", "2024-01-02"), ("2", "2024-01-03")):
        put(tmp_path / f"detail/43/{store}/{date}.csv.gz", ["item,qty", f"i{store},5"])
    return f"{tmp_path}/detail"


def test_read_by_path(spark, reports):
    rows = files.read_by_path(spark, reports, "item string, qty int", file_glob="*.csv.gz").collect()
    assert sorted((r.item, r.qty, r.cmid, str(r.date)) for r in rows) == [
        ("i1", 5, 43, "2024-01-01"),
        ("i1", 5, 43, "2024-01-02"),
        ("i2", 5, 43, "2024-01-03"),
    ]
    one_day = files.read_by_path(spark, reports, "item string, qty int", "2024-01-02", "2024-01-02")
    assert [r.item for r in one_day.collect()] == ["i1"]
    assert files.read_by_path(spark, reports, "item string, qty int", first="2024-01-02").count() == 2


def test_path_bounds_skip_files(spark, reports):
    df = files.read_by_path(spark, reports, "item string, qty int", first="2024-01-03")
    partitions = df.select("item").rdd.getNumPartitions()
    everything = files.read_by_path(spark, reports, "item string, qty int").select("item").rdd.getNumPartitions()
    assert (partitions, everything) == (1, 3)


@pytest.mark.parametrize("cell", ["1O.0", "1.234567", "x", "1e"])
def test_a_bad_cell_fails_or_is_reported(spark, tmp_path, cell):
    put(tmp_path / f"2024/01/04/{SOURCE}/cost/part0.gz", [cost_line("1", "a", "2024-01-04", 1, cell, 1), cost_line("1", "b", "2024-01-04", 1, "", 1)])
    with pytest.raises(Exception, match="bad cell"):
        files.read_cost(spark, str(tmp_path), ["2024-01-04"], SOURCE).collect()
    kept = files.read_cost(spark, str(tmp_path), ["2024-01-04"], SOURCE, on_bad="reject").collect()
    assert [(r.foreign_item_id, float(r.total_sale)) for r in kept] == [("b", 0.0)]
    raw = files.read_raw_days(spark, str(tmp_path), ["2024-01-04"], SOURCE, "cost")
    assert [(r.foreign_item_id, r.total_sale) for r in layouts.rejected(raw, layouts.COST).collect()] == [("a", cell)]


def test_damaged_files_fail_or_are_left_out_whole(spark, reports, tmp_path):
    whole = gzip.compress(("item,qty\n" + "".join(f"i{n},{n}\n" for n in range(50_000))).encode())
    (tmp_path / "detail/43/1/2024-01-09.csv.gz").write_bytes(b"this is no gzip")
    (tmp_path / "detail/43/1/2024-01-10.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "detail/43/1/2024-01-11.csv.gz").write_bytes(whole)
    schema = "item string, qty int"
    with pytest.raises(Exception):  # noqa: B017
        files.read_by_path(spark, reports, schema, file_glob="*.csv.gz").collect()
    bad = files.damaged_files(spark, reports)
    assert [p.rpartition("/")[2] for p in bad] == ["2024-01-09.csv.gz", "2024-01-10.csv.gz"]
    assert files.read_by_path(spark, reports, schema, file_glob="*.csv.gz", without=bad).count() == 50_003


def test_tables(spark):
    stores = spark.createDataFrame([(43, "a", "x"), (85, "b", "y")], "cmid int, id string, code string")
    assert tables.project_tenant(stores, 43, "id").collect()[0].asDict() == {"id": "a"}
    assert tables.project_tenant(stores).count() == 2
    config = spark.createDataFrame([(43, "A"), (85, "B")], "cmid int, vendor string")
    unified = tables.vendor_unified(config, {"A": stores, "B": stores})
    assert sorted((r.cmid, r.vendor) for r in unified.collect()) == [(43, "A"), (85, "B")]
    unlisted = tables.vendor_unified(config.filter("cmid = 85"), {"A": stores, "B": stores})
    assert sorted((r.cmid, r.vendor) for r in unlisted.collect()) == [(43, "A"), (85, "B")]


def test_dimension_helpers(spark):
    doc = '{"result":[{"store_property":"own","cm_store_property_id":"2"},{"store_property":"franchise","cm_store_property_id":"1"}]}'
    rows = mapping_table(spark.createDataFrame([(doc,)], "document string")).collect()
    assert [tuple(r) for r in rows] == [("own", "2"), ("franchise", "1")]
    with pytest.raises(ValueError, match="goods"):
        require_non_empty(spark.createDataFrame([], "a int"), "goods")
    merged = concat_by_name(spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "c int, a int"))
    assert [tuple(r) for r in merged.collect()] == [(1, 2, None), (4, None, 3)]


def test_scratch_uses_the_configured_folder(spark):
    folder = scratch.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = scratch.settle(spark.range(5), "numbers")
    assert df.count() == 5 and folder in df.inputFiles()[0]


def test_jdbc_reads_are_split():
    assert tables.jdbc_options("u", "select 1") == {"url": "u", "dbtable": "(select 1) source"}
    split = tables.jdbc_options("u", "select * from cost", "date", ("2024-01-01", "2024-01-31"), 31)
    assert (split["partitionColumn"], split["upperBound"], split["numPartitions"]) == ("date", "2024-01-31", "31")


def test_ledger_loads_only_what_changed(spark, tmp_path):
    """New, replaced and deleted objects; a second run opens no file; a crash between rows and ledger is made good."""
    import os
    import shutil
    import time
    import uuid

    root, folder = tmp_path / "in", f"{tmp_path}/tables"
    names = [f"{kind}_{uuid.uuid4().hex[:10]}" for kind in ("rows", "ledger")]
    opened = []

    def put(cmid, day, name, *items, later=0):
        target = root / str(cmid) / day
        target.mkdir(parents=True, exist_ok=True)
        (target / f"{name}.csv").write_text("item\n" + "".join(f"{i}\n" for i in items))
        os.utime(target / f"{name}.csv", (time.time() + later, time.time() + later))

    plain = ledger.reader(spark, "item string")

    def read(paths):
        opened.append(sorted(path.split("/in/")[1] for path in paths))
        return plain(paths)

    def run():
        return ledger.load_new(spark, str(root), read, *names, folder, "item string, cmid int, date date", "*.csv")

    def rows():
        return sorted((r.cmid, str(r.date), r.item) for r in spark.table(names[0]).collect())

    put(43, "2024-01-01", "a", "x", "y")
    put(43, "2024-01-01", "b", "z")
    put(85, "2024-01-02_late", "a", "x")
    put("elsewhere", "nothing", "a", "x")
    assert run() == {"new": 3} and len(opened[-1]) == 3
    before = rows()
    assert before == [(43, "2024-01-01", "x"), (43, "2024-01-01", "y"), (43, "2024-01-01", "z"), (85, "2024-01-02", "x")]
    assert run() == {} and len(opened) == 1 and rows() == before
    put(43, "2024-01-01", "a", "new", later=60)
    put(43, "2024-01-03", "a", "w")
    assert run() == {"replaced": 1, "new": 1} and opened[-1] == ["43/2024-01-01/a.csv", "43/2024-01-01/b.csv", "43/2024-01-03/a.csv"]
    assert rows() == [(43, "2024-01-01", "new"), (43, "2024-01-01", "z"), (43, "2024-01-03", "w"), (85, "2024-01-02", "x")]
    (root / "43/2024-01-01/b.csv").unlink()
    shutil.rmtree(root / "85")
    assert run() == {"gone": 2} and opened[-1] == ["43/2024-01-01/a.csv"]
    assert rows() == [(43, "2024-01-01", "new"), (43, "2024-01-03", "w")]
    put(43, "2024-01-03", "a", "v", later=120)
    real, calls = ledger.days.replace, []

    def crash(df, table, *rest, **choice):
        calls.append(table)
        if table == names[1]:
            raise RuntimeError("lost")
        real(df, table, *rest, **choice)

    ledger.days.replace = crash
    try:
        with pytest.raises(RuntimeError):
            run()
    finally:
        ledger.days.replace = real
    assert calls == names and run() == {"replaced": 1}
    assert rows() == [(43, "2024-01-01", "new"), (43, "2024-01-03", "v")] and run() == {}


def test_prices_are_not_rounded_silently(spark):
    rows = [("a", "1.2345", "2"), ("b", "1.23456", "2"), ("c", "99999999999999999", "2"), ("d", "1e2", None), ("e", "cheap", "2"), ("e", "1", "2")]
    raw = spark.createDataFrame([(43, i, "b", "S", "n", None, p, q) for i, p, q in rows], "cmid int, foreign_item_id string, barcode string, show_code string, item_name string, item_status string, lastin_price string, sale_price string")
    with pytest.raises(Exception, match="more digits than are kept"):
        files.clean_goods(raw).collect()
    assert sorted((r.foreign_item_id, str(r.lastin_price)) for r in files.clean_goods(raw, "reject").collect()) == [("a", "1.2345"), ("d", "100.0000")]
    found = sorted((r.foreign_item_id, ",".join(r.reasons)) for r in files.rejected_goods(raw).collect())
    assert found == [("b", "rounded:lastin_price"), ("c", "rounded:lastin_price"), ("e", "item"), ("e", "type:lastin_price")]
    with pytest.raises(ValueError, match="unknown choice"):
        files.clean_goods(raw, "skip")


def test_asof_days_name_the_unmatched_side(spark):
    import datetime as dt

    from shelfwise.operators import stockout

    day = dt.date(2024, 1, 31)
    held = [(1, day), (1, day - dt.timedelta(1)), (2, day - dt.timedelta(1)), (3, day - dt.timedelta(2)), (4, day + dt.timedelta(1)), (6, day)]
    snapshots = spark.createDataFrame(held, "cmid int, date date")
    asked = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,), (5,)], "cmid int")
    found = sorted((r.cmid, r.date) for r in stockout.asof_days(asked, snapshots, "2024-01-31").collect())
    assert found == [(1, day), (2, day - dt.timedelta(1)), (3, None), (4, None), (5, None)]
    assert sorted((r.cmid, r.date) for r in stockout.asof_days(asked, snapshots, "2024-01-31", 2).collect())[2] == (3, day - dt.timedelta(2))
