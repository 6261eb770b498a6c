"""One query per operator, each over whole tables of a fixture set."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.catalog.fixtures import E_AS_OF, EVENTS, L_AS_OF, L_DAYS, LINEITEM, SHARED, STATUSES, TODAY, loader
from shelfwise.functions import calendar, codes, json_urls
from shelfwise.keys import DAY, ITEM, PAIR, STORE
from shelfwise.operators import (
    actual_sale,
    assortment,
    delivery_state,
    dimensions,
    item_bitmaps,
    presence,
    presence_state,
    product_info,
    psd,
    replenish,
    reports,
    stockout,
    supervisor,
    trial,
    weekly,
)
from shelfwise.sinks import days as day_tables
from shelfwise.sinks import mirror
from shelfwise.sinks import tables as sinks
from shelfwise.sources import files, layouts, ledger, quarantine, scratch, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Data:
    """Derived tables of one run: `e` events set, `l` lineitem set, `s` shared dimensions."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.e = loader(spark, sf_dir, EVENTS)
        self.l = loader(spark, sf_dir, LINEITEM)
        self.s = loader(spark, sf_dir, SHARED)

    def path(self, name: str) -> str:
        return scratch.fresh_path(self.spark, name)


def query(build: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Data(spark, sf_dir))
    return build


# --- sources ---------------------------------------------------------------------------

TENANTS = [43, 85]


def _all_days(table: DataFrame) -> list[str]:
    """Every day from the first to the last one of the table."""
    first, last = table.agg(F.min("date"), F.max("date")).first()
    return files.days_back(last.isoformat(), (last - first).days + 1)


def _write_days(df: DataFrame, layout: dict[int, tuple[str, str]], table: str, root: str) -> None:
    """Headerless gzip files in the object layout, one folder per day and tenant."""
    names = {position: name for position, (name, _) in layout.items()}
    cells = [
        F.col(names[i]).cast("string").alias(f"c{i}") if i in names else F.lit("x").alias(f"c{i}")
        for i in range(max(names) + 1)
    ]
    day = F.col("date")
    parts = {
        "y": F.date_format(day, "yyyy"),
        "m": F.date_format(day, "MM"),
        "d": F.date_format(day, "dd"),
        "source_id": codes.source_id(F.col("cmid")),
        "table": F.lit(table),
    }
    day_tables.write_csv_days(df.select(*cells, *[c.alias(n) for n, c in parts.items()]), root, list(parts), header=False)


def _per_source(read: Callable[[str], DataFrame]) -> DataFrame:
    return dimensions.concat_by_name(*[read(codes.source_id_text(cmid)) for cmid in TENANTS])


def _cost_files(data: Data) -> str:
    root = data.path("cost")
    _write_days(data.e("cost"), layouts.COST, "cost", root)
    return root


def _read_inventory(data: Data, days: list[str]) -> DataFrame:
    root = data.path("inventory")
    _write_days(data.e("inventory"), layouts.INVENTORY, "inventory", root)
    read = _per_source(lambda source: files.read_inventory(data.spark, root, days, source, files.HIVE_DAY_LAYOUT))
    return _as_doubles(read, "quantity")


def _as_doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


@query
def scan_cost(data: Data) -> DataFrame:
    root = _cost_files(data)
    days = _all_days(data.e("cost"))
    df = _per_source(lambda source: files.read_cost(data.spark, root, days, source, files.HIVE_DAY_LAYOUT))
    return _as_doubles(df, "sale_quantity", "total_sale", "total_cost")


@query
def scan_inventory(data: Data) -> DataFrame:
    return _read_inventory(data, _all_days(data.e("inventory")))


@query
def scan_rejects(data: Data) -> DataFrame:
    """Sales files in which some cells are no numbers, or have more decimals than are kept."""
    odd = F.col("sale_quantity") % 7
    text = F.col("sale_quantity").cast("string")
    broken = F.when(odd == 0, F.concat(text, F.lit("O"))).when(odd == 1, F.concat(text, F.lit(".123456"))).otherwise(text)
    root = data.path("cost")
    _write_days(data.e("cost").withColumn("sale_quantity", broken), layouts.COST, "cost", root)
    days = _all_days(data.e("cost"))
    read = _per_source(lambda source: files.read_raw_days(data.spark, root, days, source, "cost", files.HIVE_DAY_LAYOUT))
    good = _as_doubles(layouts.typed(read, layouts.COST, "reject").select(*DAY, "sale_quantity"), "sale_quantity")
    bad = layouts.rejected(read, layouts.COST).select(F.col("cmid").cast("int").alias("cmid"), *PAIR[1:], F.to_date("date").alias("date"), F.col("sale_quantity").alias("rejected"))
    return dimensions.concat_by_name(good, bad)


@query
def scan_date_window(data: Data) -> DataFrame:
    return _read_inventory(data, files.days_back(E_AS_OF))


@query
def scan_missing_ok(data: Data) -> DataFrame:
    """The window reaches back before the first file."""
    return _read_inventory(data, files.days_back("2024-01-20", 60))


@query
def scan_store(data: Data) -> DataFrame:
    root = data.path("stores")
    _write_days(data.e("stores").withColumn("date", calendar.as_date(E_AS_OF)), layouts.STORES, "chain_store", root)
    return _per_source(lambda source: files.read_stores(data.spark, root, E_AS_OF, source, files.HIVE_DAY_LAYOUT))


@query
def scan_goods_clean(data: Data) -> DataFrame:
    return _as_doubles(files.clean_goods(data.l("goods_raw")), "lastin_price", "sale_price")


@query
def reject_malformed(data: Data) -> DataFrame:
    return files.reject_malformed(data.l("goods_raw"))


DATED_COST = "foreign_store_id string, foreign_item_id string, sale_quantity bigint"


def _dated_files(data: Data) -> str:
    root = data.path("dated")
    day_tables.write_csv_days(data.e("cost").select("cmid", "date", *DATED_COST.replace(",", "").split()[::2]), root)
    return root


def _read_dated(data: Data, first: str | None = None, last: str | None = None) -> DataFrame:
    return files.read_by_path(
        data.spark, _dated_files(data), DATED_COST, first, last, "*.gz", tenant_from_end=3, date_from_end=2
    )


@query
def scan_path_columns(data: Data) -> DataFrame:
    return _read_dated(data)


@query
def scan_by_date_suffix(data: Data) -> DataFrame:
    return _read_dated(data, "2024-01-15", "2024-01-15")


@query
def scan_date_range_folder(data: Data) -> DataFrame:
    return _read_dated(data, first="2024-01-21")


@query
def scan_glob(data: Data) -> DataFrame:
    """Tenant and day of every listed object."""
    path = F.col("path")
    listing = files.object_listing(data.spark, _dated_files(data), "*.csv.gz")
    return listing.select(
        files.path_part(path, 3).cast("int").alias("cmid"), files.path_date(path, 2).alias("date")
    ).distinct()


@query
def scan_latest_file(data: Data) -> DataFrame:
    """Content of the newest object per tenant and day folder, after a second delivery of the day."""
    path = F.col("path")
    root = data.path("deliveries")
    for n in (1, 2):
        rows = data.e("cost").groupBy("cmid", "date").agg(F.lit(n).alias("delivery"), F.count(F.lit(1)).alias("n_rows"))
        rows.coalesce(1).write.mode("append").partitionBy("cmid", "date").option("compression", "gzip").csv(root)
    listing = files.object_listing(data.spark, root, "*.csv.gz").withColumns(
        {"cmid": files.path_part(path, 3).cast("int"), "date": files.path_date(path, 2)}
    )
    newest = files.newest_objects(listing, "cmid", "date").select("cmid", "date", files.path_part(path, 1).alias("name"))
    name = files.path_part(F.col("_metadata.file_path"), 1).alias("name")
    content = files.read_by_path(data.spark, root, "delivery int, n_rows bigint", tenant_from_end=3, date_from_end=2, header=False, keep=name)
    return content.join(newest, ["cmid", "date", "name"]).drop("name")


@query
def scan_project_tenant(data: Data) -> DataFrame:
    return tables.project_tenant(data.s("store_resources"), 7, "cmid", "showcode")


@query
def scan_vendor_unified(data: Data) -> DataFrame:
    return tables.vendor_unified(data.s("tenant_config"), {"A": data.s("ways_a"), "B": data.s("ways_b")})


@query
def scan_vendor_default(data: Data) -> DataFrame:
    """Some tenants are missing in the configuration and have the default vendor."""
    config = data.s("tenant_config").filter(F.col("cmid") % 3 != 0)
    return tables.vendor_unified(config, {"A": data.s("ways_a"), "B": data.s("ways_b")})


@query
def dim_store_property(data: Data) -> DataFrame:
    entry = F.struct(
        F.col("store_name").alias("store_property"), F.col("property_id").cast("string").alias("cm_store_property_id")
    )
    documents = data.l("stores").select("cmid", F.to_json(F.struct(F.array(entry).alias("result"))).alias("document"))
    return dimensions.mapping_table(documents, keys=["cmid"])


@query
def source_id(data: Data) -> DataFrame:
    source = codes.source_id(F.col("cmid"))
    return data.s("enterprises").select("cmid", source.alias("source_id"), codes.tenant_of(source).alias("tenant"))


@query
def concat_by_name(data: Data) -> DataFrame:
    return dimensions.concat_by_name(
        data.e("cost").select(*DAY, "sale_quantity"), data.e("inventory").select(*DAY, "quantity")
    )


# --- sinks -----------------------------------------------------------------------------


def _table_name(name: str) -> str:
    return f"shelfwise_{name}_{uuid.uuid4().hex[:12]}"


@query
def sink_roundtrip_csv(data: Data) -> DataFrame:
    path = data.path("csv_days")
    cost = data.e("cost").select(*DAY, "sale_quantity")
    day_tables.write_csv_days(cost, path)
    return data.spark.read.schema(cost.schema).option("header", True).csv(path)


@query
def sink_replace(data: Data) -> DataFrame:
    table = _table_name("replace")
    schema = data.spark.createDataFrame(
        [], "cmid int, foreign_store_id string, foreign_item_id string, date date, sale_quantity double"
    ).schema
    sinks.replace_table(data.e("cost"), table, schema, data.path("replace"))
    return data.spark.table(table)


@query
def sink_append(data: Data) -> DataFrame:
    """First half of the month, then the rest appended with its columns in another order."""
    table = _table_name("append")
    cost = data.e("cost").select(*DAY, "sale_quantity")
    later = F.col("date") > F.lit("2024-01-15").cast("date")
    sinks.replace_table(cost.filter(~later), table, path=data.path("append"))
    sinks.append_table(cost.filter(later).select("sale_quantity", *DAY), table)
    return data.spark.table(table)


@query
def publish_swap(data: Data) -> DataFrame:
    """Stock replaces sales under the same name."""
    table = _table_name("swap")
    sinks.publish_swap(data.e("cost").select(*DAY), table)
    sinks.publish_swap(data.e("inventory").select(*DAY, "quantity"), table, keep=1)
    return data.spark.table(table)


def _day_table(data: Data, name: str, schema: str, *rows: DataFrame) -> str:
    """A new daily table with the rows of some loads."""
    table = _table_name(name)
    day_tables.create(data.spark, table, schema, data.path(name))
    for load in rows:
        day_tables.replace(load, table)
    return table


DAY_KEY = "cmid int, foreign_store_id string, foreign_item_id string, date date"
SOLD = f"{DAY_KEY}, sale_quantity bigint"


@query
def mirror_table(data: Data) -> DataFrame:
    """Two tables with their own schemas; the copies were older, so some days differ, some are missing and some are too many."""
    cost, stock = data.e("cost").select(*DAY), data.e("inventory").select(*DAY, "quantity")
    pairs = {}
    for df, schema in ((cost, DAY_KEY), (stock, f"{DAY_KEY}, quantity bigint")):
        old = df.filter(F.dayofmonth("date") % 3 != 0).withColumn("foreign_item_id", F.when(F.dayofmonth("date") % 5 == 0, "old").otherwise(F.col("foreign_item_id")))
        gone = df.withColumn("date", F.date_sub("date", 400)).filter(F.dayofmonth("date") == 1)
        source, target = _day_table(data, "org", schema, df), _table_name("copy")
        root = data.path("copy")
        day_tables.create(data.spark, target, schema, root)
        day_tables.replace(old.unionByName(gone), target)
        pairs[source] = (target, root)
    mirror.mirror_tables(data.spark, pairs)
    return dimensions.concat_by_name(*[data.spark.table(target) for target, _ in pairs.values()])


def _stock_from(data: Data, first: str, last: str | None = None) -> DataFrame:
    """Stock as new sales, from a day on."""
    new = data.e("inventory").filter(F.col("date") >= F.lit(first).cast("date"))
    new = new if last is None else new.filter(F.col("date") <= F.lit(last).cast("date"))
    return new.select(*DAY, F.col("quantity").alias("sale_quantity"))


@query
def upsert_daily_retention(data: Data) -> DataFrame:
    table = _day_table(data, "daily", SOLD, data.e("cost").select(*DAY, "sale_quantity"))
    new = _stock_from(data, "2024-01-28", "2024-01-28")
    day_tables.write_daily(new, table, "2024-01-28", new, retention_days=14)
    return data.spark.table(table)


@query
def upsert_daily_emptied(data: Data) -> DataFrame:
    """Both tenants are loaded, but only one of them has rows for the day."""
    table = _day_table(data, "daily", SOLD, data.e("cost").select(*DAY, "sale_quantity"))
    read = _stock_from(data, "2024-01-28", "2024-01-28")
    day_tables.write_daily(read.filter(F.col("cmid") == 43), table, "2024-01-28", read, retention_days=14)
    return data.spark.table(table)


@query
def upsert_partition(data: Data) -> DataFrame:
    return data.spark.table(_day_table(data, "partitions", SOLD, data.e("cost").select(*DAY, "sale_quantity"), _stock_from(data, "2024-01-21")))


@query
def upsert_days_emptied(data: Data) -> DataFrame:
    """A range of days is loaded again for both tenants, one of which has rows on even days only."""
    table = _day_table(data, "range", SOLD, data.e("cost").select(*DAY, "sale_quantity"))
    some = (F.col("cmid") == 43) | (F.dayofmonth("date") % 2 == 0)
    new = data.e("inventory").filter(F.col("date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date")) & some)
    asked = day_tables.days_of(data.e("inventory"), "2024-01-10", "2024-01-20")
    day_tables.replace(new.select(*DAY, F.col("quantity").alias("sale_quantity")), table, asked)
    return data.spark.table(table)


# --- maintained tables -----------------------------------------------------------------


def _iso(*days: int) -> list[str]:
    return [f"2024-01-{day:02d}" for day in days]


@query
def scan_new_objects(data: Data) -> DataFrame:
    """Day files loaded by ledger in three runs: the first half, a second half with a replaced day, and nothing new."""
    cost = data.e("cost").select("cmid", "date", *DATED_COST.replace(",", "").split()[::2])
    root, folder = data.path("objects"), data.path("ledger")
    names = _table_name("rows"), _table_name("ledger")
    read = ledger.reader(data.spark, DATED_COST)
    late = F.dayofmonth("date")
    wrong = cost.withColumn("foreign_item_id", F.when(late == 9, "wrong").otherwise(F.col("foreign_item_id")))
    for objects in (wrong.filter(late <= 15), cost.filter((late > 15) | (late == 9)), None):
        if objects is not None:
            day_tables.write_csv_days(objects, root)
        ledger.load_new(data.spark, root, read, *names, folder, f"{DATED_COST}, cmid int, date date", "*.gz")
    return data.spark.table(names[0])


@query
def load_quarantine(data: Data) -> DataFrame:
    """Accepted rows of sales files and rejected ones with their reasons, in two loads of which the second replaces the first."""
    odd = F.col("sale_quantity") % 7
    text = F.col("sale_quantity").cast("string")
    table, folder = _table_name("quarantine"), data.path("quarantine")
    for broken in (F.lit("none is good"), F.when(odd == 0, F.concat(text, F.lit("O"))).when(odd == 1, F.concat(text, F.lit(".123456"))).otherwise(text)):
        root = data.path("cost")
        _write_days(data.e("cost").withColumn("sale_quantity", broken), layouts.COST, "cost", root)
        raw = files.read_raw_days(data.spark, root, _all_days(data.e("cost")), [codes.source_id_text(cmid) for cmid in TENANTS], "cost", files.HIVE_DAY_LAYOUT)
        load = quarantine.sorted_out(raw, layouts.COST, "cost")
        quarantine.store(data.spark, load.rejected, table, folder, "cost", E_AS_OF)
    cell = F.from_json("cells", "cmid string, foreign_store_id string, foreign_item_id string, date string, sale_quantity string")
    bad = data.spark.table(table).select(cell.alias("cell"), F.array_join("reasons", ",").alias("reasons"))
    bad = bad.select(F.col("cell.cmid").cast("int").alias("cmid"), "cell.foreign_store_id", "cell.foreign_item_id", F.to_date("cell.date").alias("date"), F.col("cell.sale_quantity").alias("rejected"), "reasons")
    good = _as_doubles(load.accepted.select(*DAY, "sale_quantity"), "sale_quantity")
    return dimensions.concat_by_name(good, bad)


def _early_deliveries(data: Data) -> DataFrame:
    """The deliveries as they were known before late, corrected and deleted days came: some days are missing, on some all
    stores of a tenant are, and one day is there that was deleted later."""
    rows, number = data.l("delivery"), F.dayofyear("delivery_date")
    known = rows.filter((number % 9 != 0) & ~((number % 7 == 0) & (F.col("cmid") == 43)))
    deleted = rows.filter(number == 5).withColumn("delivery_date", F.lit("2002-02-02").cast("date"))
    return known.unionByName(deleted)


def _corrected_days(data: Data) -> list[str]:
    number = F.dayofyear("delivery_date")
    days = data.l("delivery").filter((number % 9 == 0) | (number % 7 == 0)).select("delivery_date").distinct().orderBy("delivery_date").collect()
    return [row.delivery_date.isoformat() for row in days] + ["2002-02-02"]


def _delivery_states(data: Data) -> tuple[DataFrame, DataFrame]:
    """Delivery days and items before the corrections, and the delivery days after them."""
    early = _early_deliveries(data)
    before = scratch.settle(delivery_state.rebuilt(early), "delivery_state")
    after = scratch.settle(delivery_state.merged(before, data.l("delivery"), _corrected_days(data)), "delivery_state")
    return scratch.settle(delivery_state.latest_items(early, before), "delivery_items"), after


@query
def delivery_state_days(data: Data) -> DataFrame:
    """Last delivery per store from a state that corrected days were merged into."""
    return delivery_state.last_days(_delivery_states(data)[1])


@query
def delivery_state_items(data: Data) -> DataFrame:
    """Items of the last delivery, refreshed for the stores that the corrected days moved."""
    items, after = _delivery_states(data)
    return delivery_state.refreshed_items(items, after, data.l("delivery"), _corrected_days(data))


def _presence(data: Data) -> DataFrame:
    """The state of the 20th, moved day by day to the 30th; two days come late and one was wrong at first."""
    cost, stock = data.e("cost"), data.e("inventory")
    late = F.dayofmonth("date")

    def early(df: DataFrame) -> DataFrame:
        return df.filter(~late.isin(13, 17)).withColumn("foreign_item_id", F.when(late == 8, "wrong").otherwise(F.col("foreign_item_id")))

    wrong = early(cost).groupBy(*DAY).agg(F.max("sale_quantity").alias("sale_quantity"), F.max("total_sale").alias("total_sale"), F.max("total_cost").alias("total_cost"))
    held = early(stock).groupBy(*DAY).agg(F.max("quantity").alias("quantity"))
    state = scratch.settle(presence_state.rebuilt(wrong, held, "2024-01-20"), "presence")
    for loaded, day in ((_iso(21, 22, 13), "2024-01-22"), (_iso(*range(23, 30), 8), "2024-01-29"), (_iso(30, 17), E_AS_OF)):
        state = scratch.settle(presence_state.merged(state, cost, stock, loaded, day), "presence")
    return state


@query
def presence_state_psd(data: Data) -> DataFrame:
    return presence_state.psd(_presence(data), psd.active_goods(data.e("goods")))


@query
def presence_state_sales(data: Data) -> DataFrame:
    return _as_doubles(presence_state.sale_history(_presence(data)), "sold_today", "sale_7", "quantity_7")


@query
def asof_unmatched(data: Data) -> DataFrame:
    """Snapshot day and rows of four tenants: one has the day, one the day before, one only an older one, one nothing."""
    stock = data.e("inventory").select(*PAIR, "date")
    old = stock.filter(F.col("cmid") == 43).select(F.lit(99).alias("cmid"), *PAIR[1:], F.date_sub("date", 3).alias("date"))
    late = F.when(F.col("cmid") == 85, F.date_sub("date", 1)).otherwise(F.col("date"))
    snapshots = stock.withColumn("date", late).unionByName(old)
    asked = dimensions.concat_by_name(stock.select("cmid"), old.select("cmid"), stock.select((F.col("cmid") * 0 + 7).alias("cmid"))).distinct()
    days = stockout.asof_days(asked, snapshots, "2024-01-31")
    counted = snapshots.groupBy("cmid", "date").agg(F.count(F.lit(1)).alias("n_rows"))
    return days.join(counted, ["cmid", "date"], "left")


def _item_maps(data: Data, column: str, count_null: bool) -> DataFrame:
    """Bitmaps of all days, made in two runs: the second has new days with new items and loads some days again."""
    rows, number = data.l("product_rows"), F.dayofyear("date")
    first = rows.filter((number % 3 != 0) & (F.length(column) < 5))
    again = rows.filter((number % 3 == 0) | (F.length(column) >= 5)).select("cmid", "date").distinct()
    second = rows.join(again, ["cmid", "date"], "left_semi")
    numbers = scratch.settle(item_bitmaps.numbered(item_bitmaps.no_numbers(data.spark), first, column, count_null), "numbers")
    kept = item_bitmaps.day_maps(first, numbers, column, count_null).join(again, ["cmid", "date"], "left_anti")
    more = scratch.settle(item_bitmaps.numbered(numbers, second, column, count_null), "numbers")
    return kept.unionByName(item_bitmaps.day_maps(second, more, column, count_null))


@query
def week_bitmaps(data: Data) -> DataFrame:
    lost = item_bitmaps.week_items(_item_maps(data, "foreign_item_id", False))
    return weekly.week_store_info(data.l("store_info"), data.l("product_rows"), lost)


@query
def week_bitmaps_df(data: Data) -> DataFrame:
    lost = item_bitmaps.week_items(_item_maps(data, "item_show_code", True), "monday", STORE)
    return weekly.week_store_info_df(data.l("store_info"), data.l("product_rows"), data.l("stores"), "2001-06-28", lost)


# --- presence, velocity, product information -------------------------------------------


@query
def full_sku(data: Data) -> DataFrame:
    return _as_doubles(presence.full_sku(data.e("cost"), data.e("inventory")), "quantity", "total_sale", "total_cost")


def flagship(data: Data) -> DataFrame:
    return psd.psd(
        data.e("cost"), data.e("inventory"), psd.active_goods(data.e("goods")), E_AS_OF, unique_days=True
    )


QUERIES["psd"] = lambda spark, sf_dir: flagship(Data(spark, sf_dir))


@query
def psd_all_days(data: Data) -> DataFrame:
    """Velocity of the line item set over every day it has."""
    return psd.psd(data.l("cost"), data.l("inventory"), psd.active_goods(data.l("goods")), L_AS_OF, L_DAYS)


@query
def psd_dup_goods(data: Data) -> DataFrame:
    """Every goods row twice: totals count twice, the velocity does not change."""
    goods = psd.active_goods(data.e("goods"))
    return psd.psd(data.e("cost"), data.e("inventory"), goods.union(goods), E_AS_OF)


def _twice(df: DataFrame) -> DataFrame:
    """Every row of an odd day twice."""
    return df.unionByName(df.filter(F.dayofmonth("date") % 2 == 1))


@query
def psd_repeated_days(data: Data) -> DataFrame:
    """Repeated rows of a day count as often as a join repeats them."""
    return psd.psd(_twice(data.e("cost")), _twice(data.e("inventory")), psd.active_goods(data.e("goods")), E_AS_OF)


@query
def psd_days(data: Data) -> DataFrame:
    """28 days in one pass."""
    return psd.psd_days(data.e("cost"), data.e("inventory"), psd.active_goods(data.e("goods")), "2024-01-03", E_AS_OF)


@query
def psd_sql(data: Data) -> DataFrame:
    return psd.psd(
        data.e("cost"),
        data.e("inventory"),
        data.e("goods"),
        E_AS_OF,
        presence="stock_or_sale",
        stores=data.e("stores").filter(F.col("store_status") == "营业"),
        show_codes=["SC-purchase", "SC-view", "SC-signup"],
        unique_days=True,
    )


@query
def psd_inventory_driven(data: Data) -> DataFrame:
    return psd.psd_inventory_driven(data.e("cost"), data.e("inventory"), data.e("goods"), data.e("stores"), E_AS_OF)


def _product_info(data: Data, goods: DataFrame, **rules) -> DataFrame:
    return product_info.product_info(
        data.e("cost"), data.e("inventory"), goods, data.e("stores"), data.e("ways"), E_AS_OF, **rules
    )


def _product_info_frame(data: Data) -> DataFrame:
    return _product_info(data, psd.active_goods(data.e("goods")), unique_days=True)


QUERIES["product_info"] = lambda spark, sf_dir: _product_info_frame(Data(spark, sf_dir))


@query
def product_info_sql(data: Data) -> DataFrame:
    return _product_info(data, data.e("goods"), presence="stock_or_sale", null_keys="keep")


@query
def product_info_all_days(data: Data) -> DataFrame:
    return product_info.product_info(
        data.l("cost"),
        data.l("inventory"),
        data.l("goods"),
        data.l("stores"),
        data.l("ways"),
        L_AS_OF,
        L_DAYS,
        presence="stock_or_sale",
        null_keys="keep",
    )


@query
def actual_sale_rank(data: Data) -> DataFrame:
    return actual_sale.actual_sale(data.e("cost"), data.e("inventory"), E_AS_OF, unique_days=True)


@query
def actual_sale_dense(data: Data) -> DataFrame:
    return actual_sale.actual_sale(data.e("cost"), data.e("inventory"), E_AS_OF, rank="dense")


@query
def latest_quantity(data: Data) -> DataFrame:
    return actual_sale.latest_quantity(data.l("inventory"), L_AS_OF, L_DAYS)


@query
def suggest_window(data: Data) -> DataFrame:
    return actual_sale.suggestions_in_window(data.e("suggestions"), E_AS_OF)


@query
def backfill_actual_stock(data: Data) -> DataFrame:
    history = data.e("products").join(data.e("cost").select(*DAY), PAIR)
    history = history.withColumn("theory_stock", F.length("foreign_item_id"))
    return actual_sale.backfill_actual_stock(
        history, actual_sale.actual_sale(data.e("cost"), data.e("inventory"), E_AS_OF, unique_days=True)
    )


# --- stock-out report ------------------------------------------------------------------


@query
def stockout_items(data: Data) -> DataFrame:
    return stockout.stockout_items(data.l("cm_sku"), data.l("inventory"), L_AS_OF, STATUSES)


@query
def latest_delivery(data: Data) -> DataFrame:
    return stockout.latest_delivery(data.l("delivery"))


@query
def asof_suggestion(data: Data) -> DataFrame:
    return stockout.asof_suggestion(data.l("suggestions"), _reference_dates(data.l))


@query
def asof_store_snapshot(data: Data) -> DataFrame:
    """Daily stock as the snapshot. One tenant has the wanted day, the other only the day before."""
    late = F.when(F.col("cmid") == 85, F.date_sub("date", 1)).otherwise(F.col("date"))
    snapshots = data.e("inventory").select(*PAIR, late.alias("date"))
    return stockout.asof_store_snapshot(snapshots, "2024-01-31")


@query
def cost_60d(data: Data) -> DataFrame:
    return stockout.cost_60d(data.l("cost"), L_AS_OF).select(*DAY, "sale_quantity")


def _reference_dates(table: Callable[[str], DataFrame]) -> DataFrame:
    dates = stockout.reference_dates(table("delivery"), table("suggestions"), table("stores"))
    return scratch.settle(dates, "reference_dates")


def _summary(table: Callable[[str], DataFrame], as_of: str) -> DataFrame:
    names = ["inventory", "cm_sku", "delivery", "suggestions", "require_orders"]
    return stockout.stockout_summary(*[table(n) for n in names], _reference_dates(table), as_of, STATUSES)


def _detail(table: Callable[[str], DataFrame], as_of: str) -> DataFrame:
    names = ["cost", "inventory", "cm_sku", "delivery", "suggestions", "require_orders", "aa_sku"]
    names += ["refunds", "warehouse", "goods"]
    return stockout.stockout_detail(*[table(n) for n in names], _reference_dates(table), as_of, STATUSES)


@query
def stockout_summary(data: Data) -> DataFrame:
    return _summary(data.l, L_AS_OF)


@query
def stockout_detail(data: Data) -> DataFrame:
    return _detail(data.l, L_AS_OF)


@query
def stockout_summary_dense(data: Data) -> DataFrame:
    return _summary(data.e, E_AS_OF)


@query
def stockout_detail_dense(data: Data) -> DataFrame:
    return _detail(data.e, E_AS_OF)


def _settings(data: Data) -> DataFrame:
    """Two tenants with different settings; one has no status codes of its own system."""
    codes_of_own = F.when(F.col("code_b").isNotNull(), F.array("code_a", "code_b"))
    return data.e("settings").select(
        "cmid",
        codes_of_own.alias("item_status_code"),
        F.array("code_a").alias("foreign_item_status"),
        "days_delay",
        F.array("ignored").alias("ignored_categories"),
    )


@query
def stockout_summary_settings(data: Data) -> DataFrame:
    names = ["inventory", "cm_sku", "delivery", "suggestions", "require_orders"]
    statuses = stockout.gate_statuses(_settings(data))
    wanted = data.e("stores").filter(F.col("store_status") == "营业")
    return stockout.stockout_summary(*[data.e(n) for n in names], _reference_dates(data.e), E_AS_OF, statuses, wanted)


# --- reasons and loads -----------------------------------------------------------------


def _with_nan(sheet: DataFrame) -> DataFrame:
    """The sheet with NaN in place of some values of each operand of the cause."""
    marked = {"上上次建议单": 9, "上上次订货单": 10, "上次送货单": 11}
    return sheet.withColumns({c: F.when(F.col(f"`{c}`") == v, F.lit(float("nan"))).otherwise(F.col(f"`{c}`")) for c, v in marked.items()})


def _labels(data: Data) -> DataFrame:
    """Stores with property 0 are enrolled."""
    stores = data.l("stores")
    return scratch.settle(reports.store_labels(stores, stores.filter(F.col("property_id") == 0)), "store_labels")


@query
def lost_reason(data: Data) -> DataFrame:
    return reports.load_detail(_with_nan(data.l("detail_sheet")), _labels(data)).select(
        *STORE, "item_show_code", "date", "cm_suggest", "store_book", "inv_delivery", "lost_reason"
    )


@query
def lost_reason_by_date(data: Data) -> DataFrame:
    rows = reports.detail_rows(_with_nan(data.l("detail_sheet")))
    return reports.judge_by_date(rows, data.l("trial_stores")).select(
        *STORE, "item_show_code", "date", "use_date", "cm_suggest", "store_book", "inv_delivery", "lost_reason"
    )


@query
def code_maps(data: Data) -> DataFrame:
    return (
        data.e("stores")
        .join(data.e("cycles"), STORE, "left")
        .select(
            *STORE,
            codes.cycle_code(F.col("dly_cycle")).alias("period_type_num"),
            codes.store_type(F.col("property_id")).alias("store_type"),
            codes.strategy_type(F.when(F.col("store_status") == "营业", "低")).alias("strategy_type"),
        )
    )


@query
def load_summary(data: Data) -> DataFrame:
    return reports.load_summary(data.l("summary_sheet"))


@query
def load_detail(data: Data) -> DataFrame:
    return reports.load_detail(data.l("detail_sheet"), _labels(data)).drop("is_known")


@query
def open_stores_only(data: Data) -> DataFrame:
    return reports.open_stores_only(data.l("store_info"), data.l("stores"))


@query
def join_psd(data: Data) -> DataFrame:
    return reports.join_psd(data.l("product_rows").drop("foreign_item_id"), data.l("psd"))


@query
def store_info_load(data: Data) -> DataFrame:
    return reports.store_info_load(data.l("summary_sheet"), _labels(data))


@query
def product_exception_load(data: Data) -> DataFrame:
    first = scratch.settle(reports.first_suggestion_date(data.l("suggestion_files")), "first_dates")
    sheet, velocity = data.l("detail_sheet"), data.l("psd")
    return reports.product_exception_load(sheet, _labels(data), first, velocity, TODAY)


@query
def trial_date_series(data: Data) -> DataFrame:
    days = calendar.trial_series(F.col("execute_date"), F.col("end_date"), TODAY)
    return data.l("trial_stores").select(*STORE, F.explode(days).alias("date"))


@query
def trial_expand(data: Data) -> DataFrame:
    return trial.trial_expand(data.l("trial_stores"), TODAY)


@query
def trial_load(data: Data) -> DataFrame:
    return trial.trial_product_load(data.l("detail_sheet"), data.l("trial_stores"), data.l("psd"), TODAY)


@query
def trial_load_summary(data: Data) -> DataFrame:
    return trial.trial_store_load(data.l("summary_sheet"), data.l("trial_stores"), TODAY)


@query
def trial_state(data: Data) -> DataFrame:
    return trial.trial_state(data.l("trial_stores"), TODAY)


# --- weekly ----------------------------------------------------------------------------


@query
def week_reasons(data: Data) -> DataFrame:
    return weekly.week_reasons(data.l("product_rows"))


@query
def week_reasons_5(data: Data) -> DataFrame:
    return weekly.week_reasons(data.l("product_rows"), classes=5)


@query
def week_store_info(data: Data) -> DataFrame:
    return weekly.week_store_info(data.l("store_info"), data.l("product_rows"))


@query
def week_store_info_df(data: Data) -> DataFrame:
    return weekly.week_store_info_df(data.l("store_info"), data.l("product_rows"), data.l("stores"), "2001-06-28")


# --- dimensions ------------------------------------------------------------------------


@query
def sku_cache(data: Data) -> DataFrame:
    return assortment.sku_cache(
        data.e("cost"), data.e("inventory"), data.e("goods"), data.e("stores"), E_AS_OF, 1, ["p"]
    )


@query
def sku_cache_settings(data: Data) -> DataFrame:
    names = ("cost", "inventory", "goods", "stores")
    return assortment.sku_cache(*[data.e(n) for n in names], E_AS_OF, settings=_settings(data))


@query
def packsize_vendor(data: Data) -> DataFrame:
    """One tenant is configured for vendor B, the other has the default."""
    vendors = {"A": data.s("packs_a"), "B": data.s("packs_b")}
    return dimensions.packsize_by_tenant(data.s("packs_config"), vendors)


@query
def packsize_distinct(data: Data) -> DataFrame:
    return dimensions.packsize_distinct(data.s("packs_a"))


@query
def packsize_counts(data: Data) -> DataFrame:
    return dimensions.packsize_counts(
        data.s("packs_a").select("cmid", F.col("gid").cast("string").alias("foreign_item_id"), F.col("qpc").alias("mfu"))
    )


@query
def tenants(data: Data) -> DataFrame:
    return dimensions.tenants(data.s("enterprises"))


@query
def tenant_stores(data: Data) -> DataFrame:
    return dimensions.tenant_stores(data.s("store_resources"), 7)


@query
def supervisor_map(data: Data) -> DataFrame:
    listed = F.array(*[F.struct(F.col(c).alias("id")) for c in ("store_a", "store_b", "store_c")])
    identity = data.s("identity").withColumn("stores", F.to_json(listed))
    people = supervisor.active_supervisors(data.s("user_identity"), identity, data.s("users"))
    return supervisor.supervisor_map(people, data.s("store_resources"))


@query
def dq_non_empty(data: Data) -> DataFrame:
    return dimensions.non_empty_report(
        {"cost": data.e("cost"), "late cost": data.e("cost").filter(F.col("date") > calendar.as_date("2025-01-01"))}
    )


# --- JSON ------------------------------------------------------------------------------


def _model_runs(data: Data) -> DataFrame:
    """One document per event: two runs, one of them without plots, errors without a metric."""

    def url(kind: str):
        return F.concat(F.lit(f"s3://{kind}/"), F.col("event_id").cast("string"))

    def entries(*urls):
        return F.array(*[F.struct(u.alias("url")) for u in urls])

    metric = F.when(F.col("event_type") != "error", url("metric")).alias("metric_url")
    full = F.struct(
        F.struct(
            metric,
            entries(url("fit"), F.concat(url("fit"), F.lit("b"))).alias("trainfit_urls"),
            entries(url("plot")).alias("plot_urls"),
        ).alias("result")
    )
    bare = F.struct(
        F.struct(
            url("second").alias("metric_url"),
            entries(F.concat(url("fit"), F.lit("c"))).alias("trainfit_urls"),
            F.lit(None).cast("array<struct<url:string>>").alias("plot_urls"),
        ).alias("result")
    )
    document = F.to_json(F.struct(F.array(full, bare).alias("fm_res")))
    return data.e("event_rows").select("event_id", document.alias("document"))


def _urls(data: Data, extract) -> DataFrame:
    return _model_runs(data).select("event_id", F.explode(extract(F.col("document"))).alias("url"))


QUERIES["json_metric_urls"] = lambda spark, sf_dir: _urls(Data(spark, sf_dir), json_urls.metric_urls)
QUERIES["json_fit_urls"] = lambda spark, sf_dir: _urls(Data(spark, sf_dir), json_urls.fit_urls)
QUERIES["json_plot_urls"] = lambda spark, sf_dir: _urls(Data(spark, sf_dir), json_urls.plot_urls)


# --- dates and replenishment -----------------------------------------------------------


@query
def date_series_back(data: Data) -> DataFrame:
    """The 28 days up to each store's last central delivery."""
    last = stockout.last_delivery_date(data.l("delivery"))
    return last.select(*STORE, F.explode(calendar.series_back(F.col("delivery_date"))).alias("date"))


@query
def date_series_forward(data: Data) -> DataFrame:
    """From each store's last central delivery to yesterday."""
    last = stockout.last_delivery_date(data.l("delivery"))
    return last.select(
        *STORE, F.explode(calendar.series_until_yesterday(F.col("delivery_date"), L_AS_OF)).alias("date")
    )


@query
def can_order(data: Data) -> DataFrame:
    return (
        data.e("cost")
        .select(*DAY)
        .join(data.e("cycles"), STORE, "left")
        .withColumn("period_type_num", F.when(F.col("dly_cycle").isNotNull(), codes.cycle_code(F.col("dly_cycle"))))
        .select(*DAY, codes.can_order(F.col("period_type_num"), F.col("date")).alias("can_request_order"))
    )


def _prepared(data: Data, read: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    series = actual_sale.unique_daily_series(read(data.e("cost")), read(data.e("inventory")), E_AS_OF)
    cycles = data.e("cycles").select(*STORE, codes.cycle_code(F.col("dly_cycle")).alias("period_type_num"))
    return replenish.replenish_input(data.e("products"), data.e("packs").select(*ITEM, "mfu"), cycles, series)


@query
def future_demand(data: Data) -> DataFrame:
    prepared = _prepared(data).filter(F.col("date").isNotNull())
    return replenish.future_demand(prepared.select(*DAY, "demand", "can_request_order"))


def _sequence(data: Data) -> DataFrame:
    prepared = _prepared(data).filter(F.col("date").isNotNull() & F.col("mfu").isNotNull())
    return replenish.replenish(prepared.select(*DAY, "demand", "can_request_order", "opening_stock", "mfu"))


QUERIES["replenish"] = lambda spark, sf_dir: _sequence(Data(spark, sf_dir))


@query
def replenish_history(data: Data) -> DataFrame:
    return replenish.replenish_history(_prepared(data))


@query
def replenish_repeated_stock(data: Data) -> DataFrame:
    """Rows that are read twice do not double the stock."""
    return replenish.replenish_history(_prepared(data, _twice))


@query
def replenish_rejects(data: Data) -> DataFrame:
    return replenish.replenish_rejects(_prepared(data)).select(*DAY, "mfu", "opening_stock")


@query
def replenish_bucketed(data: Data) -> DataFrame:
    """The history over products and series that lie in the same buckets."""
    return replenish.replenish_history(_bucketed(data))


def _bucketed(data: Data) -> DataFrame:
    series = actual_sale.unique_daily_series(data.e("cost"), data.e("inventory"), E_AS_OF)
    buckets = int(data.spark.conf.get("spark.sql.shuffle.partitions"))
    names = _table_name("series"), _table_name("products")
    for name, df in zip(names, (series, data.e("products")), strict=True):
        sinks.replace_bucketed(df, name, buckets, PAIR)
    cycles = data.e("cycles").select(*STORE, codes.cycle_code(F.col("dly_cycle")).alias("period_type_num"))
    return replenish.replenish_input(data.spark.table(names[1]), data.e("packs").select(*ITEM, "mfu"), cycles, data.spark.table(names[0]))
