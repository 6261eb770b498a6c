"""Plan shapes, hot keys and the daily jobs end to end."""

import datetime as dt
import gzip
import json
import uuid

import pytest
from pyspark.sql import functions as F

from shelfwise.catalog.queries import QUERIES, Data, _bucketed
from shelfwise.operators import delivery_state, presence, presence_state, psd, replenish, reports, stockout
from shelfwise.plans import daily
from shelfwise.sources import files, scratch

SF_DIR = "/root/testdata/sf0.001"
FILE_KEYS = ("scan_", "sink_", "publish_", "mirror_", "load_", "upsert_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(FILE_KEYS)))
def test_no_python_and_no_cross_join(spark, key):
    text = plan(QUERIES[key](spark, SF_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_window_reaches_the_scan(spark):
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(QUERIES["psd"](spark, SF_DIR))


def test_unique_velocity_shuffles_facts_once(spark):
    data = Data(spark, SF_DIR)
    cost, stock = data.e("cost"), data.e("inventory")
    derived = plan(presence.pair_activity(cost, stock, "2024-01-30", unique_days=True)).count("Exchange")
    inputs = plan(cost).count("Exchange") + plan(stock).count("Exchange")
    assert derived - inputs == 1


def hot_facts(spark, n):
    """`n` days-by-store rows, a third of them of one store and item of one day."""
    rows = spark.range(n).select(
        F.lit(43).alias("cmid"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 97).cast("string")).alias("foreign_store_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 89).cast("string")).alias("foreign_item_id"),
        F.expr("CASE WHEN id % 3 = 0 THEN DATE'2024-01-30' ELSE date_sub(DATE'2024-01-30', cast(id % 28 AS int)) END").alias("date"),
        F.lit(1).cast("bigint").alias("quantity"),
        F.lit(2).cast("decimal(18,4)").alias("total_sale"),
        F.lit(1).cast("decimal(18,4)").alias("total_cost"),
    )
    return rows


def test_hot_pair_is_combined_before_the_shuffle(spark):
    n = 300_000
    rows = hot_facts(spark, n)
    result = presence.day_level(rows, rows.drop("total_sale", "total_cost")).filter("foreign_store_id = 'hot'").first()
    hot = n // 3
    assert (result.cost_rows, result.stock_rows) == (hot, hot)
    assert result.listed_days == hot * hot and result.total_sale == 2 * hot * hot
    goods = spark.createDataFrame([(43, "hot", "H", 1.0, 1.0)], "cmid int, foreign_item_id string, show_code string, lastin_price double, sale_price double")
    row = psd.psd(rows, rows, goods, "2024-01-30").first()
    assert row.psd == 2.0


def test_hot_store_is_split_without_broadcast(spark):
    """Report rows of which nine in ten belong to one store, labels too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100kb",
    }
    data = Data(spark, "/root/testdata/sf0.01")
    sheet = data.l("detail_sheet").withColumn("门店ID", F.when(F.col("`今日销量`") > 5, "7").otherwise(F.col("门店ID")))
    sheet = sheet.withColumn("cmid", F.when(F.col("门店ID") == "7", 85).otherwise(F.col("cmid"))).repartition(8)
    labels = scratch.settle(reports.store_labels(data.l("stores"), data.l("trial_stores")), "labels")
    old = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        loaded = reports.load_detail(sheet, labels).select("lost_reason", "store_show_code")
        assert len(loaded.collect()) == 60_000
        assert "skew=true" in plan(loaded)
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def inputs(spark):
    data = Data(spark, SF_DIR)
    tables = {n: data.e(n) for n in ("cost", "inventory", "goods", "stores", "ways", "products", "packs", "cycles", "cm_sku")}
    tables |= {n: data.e(n) for n in ("delivery", "suggestions", "require_orders", "aa_sku", "refunds", "warehouse")}
    tables |= {n: data.s(n) for n in ("user_identity", "users", "store_resources")}
    tables["identity"] = data.s("identity").withColumn("stores", F.to_json(F.array(F.struct(F.col("store_a").alias("id")))))
    return tables


def loads_of(tables, spark):
    """What the load needs beside the report."""
    files = spark.createDataFrame([(43, dt.datetime(2024, 1, 2), "x/2024-01-02.csv.gz")], "cmid int, modification_time timestamp, path string")
    return {"use_cm_stores": tables["stores"].filter("property_id = 0"), "suggestion_files": files}


DAILY = ["psd_info", "report_summary", "report_detail", "store_info", "store_product_info"]


@pytest.fixture
def database(spark):
    """Names of fresh databases."""
    made = []

    def fresh():
        made.append(f"db_{uuid.uuid4().hex[:10]}")
        spark.sql(f"CREATE DATABASE {made[-1]}")
        return made[-1]

    yield fresh
    for name in made:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def content(spark, database, names=DAILY):
    return {name: stored(spark.table(f"{database}.{name}")) for name in names}


def run_day(spark, tables, out, day, database):
    daily.psd_job(tables, out, day, database=database)
    daily.stockout_report_job(tables, out, day, ["A", "N"], database=database)
    daily.report_to_load_job(spark, tables | loads_of(tables, spark), out, day, database)


def test_a_rerun_with_fewer_rows_equals_a_fresh_run(spark, inputs, tmp_path, database):
    """Tenants and items that vanish between two runs of a day leave nothing behind."""
    day = "2024-01-30"
    no_goods = inputs["goods"].filter("cmid <> 43")
    all_closed = inputs["stores"].withColumn("store_status", F.when(F.col("cmid") == 43, "闭店").otherwise(F.col("store_status")))
    full = inputs["cm_sku"].select("cmid", "foreign_store_id", "foreign_item_id").distinct()
    stocked = full.filter("cmid = 85").select("*", F.lit(dt.date(2024, 1, 30)).alias("date"), F.lit(5).cast("bigint").alias("quantity"), F.lit(1).cast("decimal(18,2)").alias("amount"))
    fewer = inputs | {"goods": no_goods, "stores": all_closed, "inventory": inputs["inventory"].filter("date <> DATE'2024-01-30' OR cmid <> 85").unionByName(stocked)}
    again, fresh = database(), database()
    run_day(spark, inputs, f"{tmp_path}/again", day, again)
    before = content(spark, again)
    run_day(spark, fewer, f"{tmp_path}/again", day, again)
    run_day(spark, fewer, f"{tmp_path}/fresh", day, fresh)
    after = content(spark, fresh)
    assert content(spark, again) == after != before
    assert not any("cmid=43" in row for row in after["psd_info"]) and any("cmid=43" in row for row in before["psd_info"])


def test_a_missing_snapshot_deletes_nothing(spark, inputs, tmp_path, database):
    """A rerun in which the store snapshot of one tenant is three days old leaves both its tables as they are."""
    day, name = "2024-01-30", database()
    run_day(spark, inputs, str(tmp_path), day, name)
    before = content(spark, name)
    shown = F.when(F.col("cmid") == 43, F.lit(dt.date(2024, 1, 27))).otherwise(F.lit(dt.date(2024, 1, 30)))
    dated = inputs | {"stores": inputs["stores"].withColumn("date", shown)}
    loads = loads_of(inputs, spark)
    assert daily.report_to_load_job(spark, dated | loads, str(tmp_path), day, name) == {43}
    assert content(spark, name) == before and any("cmid=43" in row for row in before["store_info"])
    assert daily.stockout_report_job(dated, str(tmp_path), day, ["A", "N"], database=name) == {43}
    assert content(spark, name) == before
    # a tenant that the store table does not know at all is the same case
    unknown = inputs | {"stores": inputs["stores"].filter("cmid <> 43")}
    assert daily.report_to_load_job(spark, unknown | loads, str(tmp_path), day, name) == {43}
    assert content(spark, name) == before
    # one within the tolerance is loaded
    near = inputs | {"stores": inputs["stores"].withColumn("date", F.lit(dt.date(2024, 1, 29)))}
    assert daily.report_to_load_job(spark, near | loads, str(tmp_path), day, name) == set()
    assert content(spark, name) == before


def test_a_range_of_days_leaves_no_stale_rows(spark, inputs, tmp_path, database):
    again, fresh = database(), database()
    fewer = inputs | {"goods": inputs["goods"].filter("cmid <> 43")}
    daily.psd_days_job(inputs, f"{tmp_path}/again", "2024-01-28", "2024-01-30", again)
    before = content(spark, again, ["psd_info"])
    daily.psd_days_job(fewer, f"{tmp_path}/again", "2024-01-28", "2024-01-30", again)
    daily.psd_days_job(fewer, f"{tmp_path}/fresh", "2024-01-28", "2024-01-30", fresh)
    assert content(spark, again, ["psd_info"]) == content(spark, fresh, ["psd_info"]) != before
    with pytest.raises(ValueError, match="no rows"):
        daily.psd_days_job(inputs | {"goods": inputs["goods"].limit(0)}, f"{tmp_path}/again", "2024-01-28", "2024-01-30", again)
    with pytest.raises(ValueError, match="no rows"):
        daily.psd_job(inputs | {"goods": inputs["goods"].limit(0)}, f"{tmp_path}/again", "2024-01-30", database=again)
    assert content(spark, again, ["psd_info"]) == content(spark, fresh, ["psd_info"])
    # exports: the folder of a tenant without rows goes
    daily.inventory_psd_job(inputs, f"{tmp_path}/csv", "2024-01-30")
    assert (tmp_path / "csv/psd_inventory/cmid=43").exists()
    daily.inventory_psd_job(fewer, f"{tmp_path}/csv", "2024-01-30")
    assert not (tmp_path / "csv/psd_inventory/cmid=43/update_date=2024-01-30").exists()
    assert (tmp_path / "csv/psd_inventory/cmid=85/update_date=2024-01-30").exists()


def test_maintained_tables_give_the_same_report(spark, inputs, tmp_path, database):
    """Reports and velocity from the maintained tables, moved over two days, equal those from the histories."""
    plain, kept = database(), database()
    daily.delivery_state_job(inputs | {"delivery": inputs["delivery"].filter("delivery_date <= DATE'2024-01-28'")}, database=kept)
    daily.presence_state_job(inputs, "2024-01-28", database=kept)
    for day in ("2024-01-29", "2024-01-30"):
        daily.delivery_state_job(inputs, [day], kept)
        daily.presence_state_job(inputs, day, [day], kept)
    with pytest.raises(ValueError, match="not that of"):
        daily.stockout_report_job(inputs, f"{tmp_path}/kept", "2024-01-29", ["A", "N"], database=kept, maintained=True)
    for name, maintained in ((plain, False), (kept, True)):
        daily.stockout_report_job(inputs, f"{tmp_path}/{name}", "2024-01-30", ["A", "N"], database=name, maintained=maintained)
    daily.psd_job(inputs, f"{tmp_path}/{plain}", "2024-01-30", database=plain)
    daily.psd_state_job(inputs, f"{tmp_path}/{kept}", kept)
    names = ["report_summary", "report_detail", "psd_info"]
    assert content(spark, plain, names) == content(spark, kept, names)
    assert all(content(spark, kept, names).values())
    # run again: the same
    before = content(spark, kept, ["delivery_state", "delivery_items", "presence_state"])
    daily.delivery_state_job(inputs, ["2024-01-30"], kept)
    daily.presence_state_job(inputs, "2024-01-30", ["2024-01-30"], kept)
    assert content(spark, kept, ["delivery_state", "delivery_items", "presence_state"]) == before


def test_a_run_reads_one_day_of_the_histories(spark, inputs, tmp_path):
    inputs["delivery"].write.partitionBy("delivery_date").parquet(f"{tmp_path}/delivery")
    delivery = spark.read.parquet(f"{tmp_path}/delivery")
    state = scratch.settle(delivery_state.rebuilt(delivery), "state")

    def pruned(df, column):
        filters = [line.split("PartitionFilters: ")[1].split("]")[0] for line in plan(df).splitlines() if "PartitionFilters: " in line]
        return [f for f in filters if f"({column}#" in f and "= 2024-01-30)" in f]

    assert len(pruned(delivery_state.merged(state, delivery, ["2024-01-30"]), "delivery_date")) == 1
    for name in ("cost", "inventory"):
        inputs[name].write.partitionBy("date").parquet(f"{tmp_path}/{name}")
    facts = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("cost", "inventory")]
    state = scratch.settle(presence_state.rebuilt(*facts, "2024-01-29"), "state")
    assert len(pruned(presence_state.merged(state, *facts, ["2024-01-30"], "2024-01-30"), "date")) == 2


def test_bucketed_history_is_not_shuffled_between_store_and_fold(spark):
    prepared = _bucketed(Data(spark, SF_DIR))
    text = plan(replenish.replenish_history(prepared))
    exchanges = [line for line in text.splitlines() if "Exchange" in line and "BroadcastExchange" not in line and "Reused" not in line]
    assert not [line for line in exchanges if "foreign_item_id" in line and "foreign_store_id" in line]
    assert len(exchanges) <= 2


def test_weekly_tables_from_bitmaps(spark, database, tmp_path):
    data, name, out = Data(spark, SF_DIR), database(), str(tmp_path)
    tables = {n: data.l(n) for n in ("summary_sheet", "detail_sheet", "stores", "suggestion_files", "psd")} | {"use_cm_stores": data.l("trial_stores")}
    days = [str(r.date) for r in tables["summary_sheet"].select("date").distinct().orderBy("date").tail(6)]
    for day in days[:4]:
        daily.stockout_load_job(tables, out, day, name)
    daily.item_maps_job(spark, out, database=name)
    for day in [*days[4:], days[3]]:  # two new days and one loaded again with fewer rows
        daily.stockout_load_job(tables | {"detail_sheet": tables["detail_sheet"].filter(F.col("`商品show_code`") > "P5")}, out, day, name)
    daily.item_maps_job(spark, out, [*days[4:], days[3]], name)
    daily.weekly_job(spark, tables, days[-1], name)
    plain = content(spark, name, ["store_info_week"])
    daily.weekly_job(spark, tables, days[-1], name, maintained=True)
    assert content(spark, name, ["store_info_week"]) == plain and plain["store_info_week"]


def test_per_day_inputs_are_taken_as_of_the_day(spark, inputs, tmp_path, database):
    """With history in the tables, the report equals the one over the tables of the day."""
    day = "2024-01-30"
    names = ("cm_sku", "aa_sku", "refunds", "goods", "stores")
    dated = {}
    for n in names:
        shown = F.when(F.col("cmid") == 43, F.lit(dt.date(2024, 1, 30))).otherwise(F.lit(dt.date(2024, 1, 29)))
        old = inputs[n].withColumn("foreign_item_id" if "foreign_item_id" in inputs[n].columns else "foreign_store_id", F.lit("gone"))
        dated[n] = inputs[n].withColumn("date", shown).unionByName(old.withColumn("date", F.lit(dt.date(2024, 1, 1))))
    plain, other = database(), database()
    assert daily.stockout_report_job(inputs, f"{tmp_path}/plain", day, ["A", "N"], database=plain) == set()
    assert daily.stockout_report_job(inputs | dated, f"{tmp_path}/dated", day, ["A", "N"], database=other) == set()
    sheets = ["report_summary", "report_detail"]
    assert content(spark, plain, sheets) == content(spark, other, sheets) and all(content(spark, plain, sheets).values())


def test_reference_days_bound_the_suggestions(spark, inputs, tmp_path):
    """One scan of the deliveries; partitions of the suggestions outside the reference days are skipped."""
    for n in ("delivery", "suggestions"):
        inputs[n].write.partitionBy("delivery_date" if n == "delivery" else "date").parquet(f"{tmp_path}/{n}")
    delivery, suggestions = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("delivery", "suggestions"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(stockout.reference_dates(delivery, suggestions, inputs["stores"]))
        assert "delivery_type" not in text  # read once before, for the last days
        scans = [line for line in text.splitlines() if "FileScan" in line and "PartitionFilters: [isnotnull(date" in line]
        assert scans and all("(date#" in line and "2024-01-" in line for line in scans)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def write_lines(root, layout, lines, cmid="43"):
    for kind, rows in lines.items():
        for d in ("03", "04", "05"):
            mine = [r for r in rows if f"2024-01-{d}" in r] if kind != "chain_goods" else rows if d == "05" else []
            if mine:
                folder = root / layout.format(y="2024", m="01", d=d, source_id=f"{cmid}YYYYYYYYYYYYY", table=kind)
                folder.mkdir(parents=True)
                with gzip.open(folder / "part0.gz", "wt") as out:
                    out.write("\n".join(mine) + "\n")


def lines_of(cmid, sales=(("a", "4.5"), ("b", "2"))):
    return {
        "cost": [f"x,s,{item},2024-01-{d:02d},x,1,{sale},1,x,x,x,x,x,{cmid}" for item, sale in sales for d in (3, 4)],
        "inventory": [f"{cmid},s,a,2024-01-{d:02d},3" for d in (3, 4, 5)],
        "chain_goods": [f"{cmid},bc,a,name,2,3,x,ok,x,x,x,x,x,x,x,x,CA", f"{cmid},bc,b,name,1,3,x,ok,x,x,x,x,x,x,x,x,CB"],
    }


def test_files_to_velocity_to_files(spark, tmp_path):
    """Gzip day folders of two tenants in both layouts, through the velocity job, to gzip day folders."""
    results = []
    for layout in (files.DAY_LAYOUT, files.HIVE_DAY_LAYOUT):
        root = tmp_path / layout[:3].strip("{}=")
        write_lines(root, layout, lines_of(43))
        write_lines(root, layout, lines_of(85), "85")
        out = f"{root}-out"
        daily.velocity_files_job(spark, str(root), out, "2024-01-05", [43, 85], layout)
        back = spark.read.option("header", True).csv(f"{out}/psd")
        results.append(sorted((r.cmid, r.foreign_item_id, float(r.psd), r.item_show_code, str(r.date)) for r in back.collect()))
        with pytest.raises(FileNotFoundError, match="44YY"):
            daily.velocity_files_job(spark, str(root), out, "2024-01-05", [43, 44], layout)
    assert results[0] == results[1] == [(c, i, p, s, "2024-01-05") for c in (43, 85) for i, p, s in (("a", 3.0, "CA"), ("b", 2.0, "CB"))]
    with pytest.raises(FileNotFoundError):
        daily.velocity_files_job(spark, str(tmp_path / "y"), f"{tmp_path}/none", "2023-01-05", [43], files.HIVE_DAY_LAYOUT)


def test_rejected_rows_are_kept_with_their_reasons(spark, tmp_path, database):
    name = database()
    lines = lines_of(43, sales=(("a", "4.5"), ("b", "2"), ("c", "0.123456"), ("d", "1O")))
    lines["inventory"].append("43,s,b,2024-01-04,many")
    lines["chain_goods"] += ["43,bc,r,name,1.23456,3,x,ok,x,x,x,x,x,x,x,x,CR", "43,bc,t,name,cheap,3,x,ok,x,x,x,x,x,x,x,x,CT"]
    write_lines(tmp_path / "in", files.DAY_LAYOUT, lines)

    def run(most=1.0, **choice):
        return daily.velocity_files_job(spark, str(tmp_path / "in"), f"{tmp_path}/out", "2024-01-05", [43], on_bad="reject", most_rejected=most, database=name)

    for _ in range(2):
        assert run() == {"cost": {"read": 8, "accepted": 4, "rejected": 4}, "inventory": {"read": 4, "accepted": 3, "rejected": 1}}
        kept = spark.table(f"{name}.load_quarantine").collect()
        found = sorted((r.load, ",".join(r.reasons), json.loads(r.cells)["foreign_item_id"]) for r in kept)
        assert found == [("cost", "rounded:total_sale", "c")] * 2 + [("cost", "type:total_sale", "d")] * 2 + [("goods", "rounded:lastin_price", "r"), ("goods", "type:lastin_price", "t"), ("inventory", "type:quantity", "b")]
        assert all(r.file is None or r.file.endswith("part0.gz") for r in kept)
    with pytest.raises(ValueError, match="4 of 8 rows are bad"):
        run(0.4)
    with pytest.raises(Exception, match="bad cell"):
        daily.velocity_files_job(spark, str(tmp_path / "in"), f"{tmp_path}/out", "2024-01-05", [43], database=name)


def stored(df):
    return sorted(map(str, df.collect()))


def test_fact_jobs_can_be_repeated(spark, inputs, tmp_path, database):
    out, name = str(tmp_path), database()
    tables = ["psd_info", "report_summary", "report_detail"]
    snapshots = ["bd_product_info", "bd_product_store", "store_supervisor", "bd_product_history", "bd_product_history_rejects"]

    def run():
        daily.psd_job(inputs, out, "2024-01-30", database=name)
        daily.product_info_job(inputs, "2024-01-30", database=name)
        daily.stockout_report_job(inputs, out, "2024-01-30", ["A", "N"], database=name)
        daily.assortment_job(inputs, "2024-01-30", database=name)
        daily.supervisor_job(inputs, database=name)
        daily.replenish_job(inputs, "2024-01-30", database=name)
        return content(spark, name, tables + snapshots)

    first = run()
    assert all(first.values())
    assert run() == first
    single = stored(spark.table(f"{name}.psd_info").select("cmid", "foreign_store_id", "foreign_item_id", "psd"))
    other = database()
    daily.psd_days_job(inputs, f"{out}/many", "2024-01-29", "2024-01-30", other)
    many = spark.table(f"{other}.psd_info").filter("date = DATE'2024-01-30'")
    assert stored(many.select("cmid", "foreign_store_id", "foreign_item_id", "psd")) == single
    daily.report_to_load_job(spark, inputs | loads_of(inputs, spark), out, "2024-01-30", name)
    report = spark.table(f"{name}.report_detail")
    loaded = spark.table(f"{name}.store_product_info")
    closed = inputs["stores"].filter("store_status = '闭店'").select("cmid", "foreign_store_id")
    assert loaded.count() == report.join(closed, ["cmid", "foreign_store_id"], "left_anti").count() > 0
    assert loaded.filter("psd_cost IS NOT NULL").count() > 0
    daily.inventory_psd_job(inputs, out, "2024-01-29")
    daily.inventory_psd_job(inputs, out, "2024-01-30")
    export = spark.read.option("header", True).csv(f"{out}/psd_inventory")
    assert {str(r.update_date) for r in export.select("update_date").collect()} == {"2024-01-29", "2024-01-30"}
    daily.backfill_job(inputs, "2024-01-30", name)
    filled = spark.table(f"{name}.bd_product_history")
    assert filled.count() == len(first["bd_product_history"]) and "fill_qty" not in filled.columns


def test_monitoring_jobs(spark, tmp_path, database):
    data, out, name = Data(spark, SF_DIR), str(tmp_path), database()
    tables = {n: data.l(n) for n in ("summary_sheet", "detail_sheet", "stores", "suggestion_files", "psd", "trial_stores")}
    tables["use_cm_stores"] = data.l("trial_stores")
    days = [str(r.date) for r in tables["summary_sheet"].select("date").distinct().orderBy("date").tail(3)]
    for day in days + days[-1:]:
        daily.stockout_load_job(tables, out, day, name)
    daily.stockout_load_job(tables, out, "1990-01-01", name)
    info = spark.table(f"{name}.store_info")
    last = dt.date.fromisoformat(days[-1])
    kept = [d for d in days if dt.date.fromisoformat(d) > last - dt.timedelta(84)]
    assert sorted({str(r.date) for r in info.select("date").collect()}) == kept
    assert info.count() == info.dropDuplicates(["cmid", "foreign_store_id", "date"]).count()
    daily.weekly_job(spark, tables, days[-1], name)
    trials = ["new_store_info", "new_store_product_info"]
    daily.trial_job(tables, out, "2001-06-30", name)
    before = content(spark, name, trials)
    daily.trial_job(tables, out, "2001-06-30", name)
    assert all(before.values()) and content(spark, name, trials) == before
    assert spark.table(f"{name}.use_cm_stores").count() == tables["trial_stores"].count()
    daily.trial_weekly_job(spark, name)
    for table in ("store_product_week", "store_info_week", "new_store_product_week", "new_store_info_week"):
        assert not spark.table(f"{name}.{table}").isEmpty()
    # a store that is no longer due leaves no rows on days that are loaded again
    fewer = tables | {"detail_sheet": tables["detail_sheet"].filter("cmid = 85")}
    daily.trial_job(fewer, out, "2001-06-30", name)
    rows = stored(spark.table(f"{name}.new_store_product_info"))
    assert rows and not any("cmid=43" in row for row in rows)
    assert content(spark, name, ["new_store_info"])["new_store_info"] == before["new_store_info"]
