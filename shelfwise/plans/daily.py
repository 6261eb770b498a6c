"""The batch jobs: sources, operators and sinks put together, all tenants in one pass.

`tables` holds the input frames by name (see FIXTURES.md). Daily tables are catalog tables in
`database`, partitioned by tenant and date, with their files below the root folder `out`.
Snapshots are views in `database`, each on the last of a few version tables. Every job may be run again for the
same day: it leaves neither duplicates nor rows that are no longer right, and a tenant without
input keeps what it has. Table and column names of the output are fixed values.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.codes import cycle_code, source_id_text
from shelfwise.keys import PAIR, STORE
from shelfwise.operators import (
    actual_sale,
    assortment,
    delivery_state,
    dimensions,
    item_bitmaps,
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
from shelfwise.operators.presence import in_window
from shelfwise.sinks import days
from shelfwise.sinks import tables as sinks
from shelfwise.sources import files, layouts, quarantine
from shelfwise.sources.scratch import settle

Tables = Mapping[str, DataFrame]


def _daily(spark: SparkSession, database: str, name: str, schema: str, out: str) -> str:
    """The daily table of that name, created below `out` if missing."""
    table = f"{database}.{name}"
    days.create(spark, table, schema, f"{out}/{name}")
    return table


def _tenants_with_facts(tables: Tables, last: str, span: int) -> DataFrame:
    """Tenants with sales or stock in the window: the others have no input and keep what they have."""
    cost, stock = (in_window(tables[name], last, span).select("cmid") for name in ("cost", "inventory"))
    return cost.union(stock).distinct()


def psd_job(tables: Tables, out: str, as_of: str, unique_days: bool = False, database: str = "default") -> None:
    """Velocity of one day into `psd_info` with the usual retention (C1, K1); a day without any row is an error."""
    goods = psd.active_goods(tables["goods"])
    result = psd.psd(tables["cost"], tables["inventory"], goods, as_of, unique_days=unique_days)
    table = _daily(result.sparkSession, database, "psd_info", schemas.PSD_INFO, out)
    days.write_daily(sinks.conform(result, schemas.PSD_INFO), table, as_of, _tenants_with_facts(tables, as_of, 28), empty_ok=False)


def psd_days_job(tables: Tables, out: str, first: str, last: str, database: str = "default") -> None:
    """Velocity of every day from `first` to `last` into `psd_info`, with one pass over the facts.

    All these days of the tenants with facts are replaced, also where a day has no row any more.
    """
    goods = psd.active_goods(tables["goods"])
    result = psd.psd_days(tables["cost"], tables["inventory"], goods, first, last)
    table = _daily(result.sparkSession, database, "psd_info", schemas.PSD_INFO, out)
    span = 28 + (dt.date.fromisoformat(last) - dt.date.fromisoformat(first)).days
    asked = days.days_of(_tenants_with_facts(tables, last, span), first, last)
    days.replace(sinks.conform(result, schemas.PSD_INFO), table, asked, empty_ok=False)


def presence_state_job(tables: Tables, as_of: str, loaded_days: Sequence[str] | None = None, database: str = "default") -> None:
    """Bring the presence of the last 60 days up to `as_of` (A10).

    The first run reads 60 days of facts. Later ones read `loaded_days` only: all days since the last run, and
    those that were loaded again.
    """
    spark, name = tables["cost"].sparkSession, f"{database}.presence_state"
    facts = tables["cost"], tables["inventory"]
    if sinks.table_exists(spark, name) and loaded_days is not None:
        state = presence_state.merged(spark.table(name), *facts, loaded_days, as_of)
    else:
        state = presence_state.rebuilt(*facts, as_of)
    sinks.publish_swap(sinks.conform(state, presence_state.STATE), name, buckets=(_buckets(spark), PAIR))


def psd_state_job(tables: Tables, out: str, database: str = "default") -> None:
    """Velocity of the day of the presence state into `psd_info`, without reading facts."""
    spark = tables["goods"].sparkSession
    state = spark.table(f"{database}.presence_state")
    as_of = state.agg(F.max("as_of")).first()[0].isoformat()
    result = presence_state.psd(state, psd.active_goods(tables["goods"]))
    table = _daily(spark, database, "psd_info", schemas.PSD_INFO, out)
    days.write_daily(sinks.conform(result, schemas.PSD_INFO), table, as_of, state.select("cmid"), empty_ok=False)


def delivery_state_job(tables: Tables, loaded_days: Sequence[str] | None = None, database: str = "default") -> None:
    """Bring the delivery days and the items of the newest delivery of every store up to date.

    The first run reads the whole history. Later ones read `loaded_days`, which are new, late, corrected or deleted
    days alike, and the newest day of stores that lost theirs.
    """
    delivery = tables["delivery"]
    spark, names = delivery.sparkSession, (f"{database}.delivery_state", f"{database}.delivery_items")
    if loaded_days is not None and all(sinks.table_exists(spark, name) for name in names):
        state = delivery_state.merged(spark.table(names[0]), delivery, loaded_days)
        sinks.publish_swap(sinks.conform(state, delivery_state.STATE), names[0], empty_ok=True)
        items = delivery_state.refreshed_items(spark.table(names[1]), spark.table(names[0]), delivery, loaded_days)
    else:
        sinks.publish_swap(sinks.conform(delivery_state.rebuilt(delivery), delivery_state.STATE), names[0], empty_ok=True)
        items = delivery_state.latest_items(delivery, spark.table(names[0]))
    sinks.publish_swap(sinks.conform(items, delivery_state.ITEMS), names[1], empty_ok=True)


def velocity_files_job(
    spark: SparkSession,
    root: str,
    out: str,
    as_of: str,
    cmids: Sequence[int],
    day_layout: str = files.DAY_LAYOUT,
    on_bad: str = "fail",
    most_rejected: float = 0.01,
    database: str = "default",
) -> dict[str, dict[str, int]]:
    """Day files of the source systems to velocity to day files.

    One scan of each kind of file covers all tenants; a tenant without any file of a kind is an error. With
    `on_bad="reject"` bad rows go to the table `load_quarantine` with their reasons, and the load fails only beyond the
    share `most_rejected` of them. Returns the numbers of rows read, accepted and rejected of each kind that was
    parted.
    """
    window = files.days_back(as_of)
    sources = [source_id_text(cmid) for cmid in cmids]
    for kind in ("cost", "inventory"):
        if missing := files.missing_sources(spark, root, window, sources, kind, day_layout):
            raise FileNotFoundError(f"no {kind} files of {', '.join(missing)} below {root}")
    counts: dict[str, dict[str, int]] = {}
    if on_bad == "fail":
        cost = files.read_cost(spark, root, window, sources, day_layout)
        stock = files.read_inventory(spark, root, window, sources, day_layout)
    else:
        parted = {}
        for kind, layout in (("cost", layouts.COST), ("inventory", layouts.INVENTORY)):
            load = quarantine.sorted_out(files.read_raw_days(spark, root, window, sources, kind, day_layout), layout, kind)
            quarantine.store(spark, load.rejected, f"{database}.load_quarantine", f"{out}/load_quarantine", kind, as_of)
            counts[kind] = {"read": load.n_read, "accepted": load.n_accepted, "rejected": load.n_rejected}
            parted[kind] = quarantine.require(load, kind, most_rejected).accepted
        cost, stock = files.cost_rows(parted["cost"]), files.inventory_rows(parted["inventory"])
    raw_goods = settle(files.read_raw_goods(spark, files.newest_goods(spark, root, as_of, sources, day_layout)), "goods")
    if on_bad != "fail":
        quarantine.store(spark, quarantine.goods_rejects(raw_goods), f"{database}.load_quarantine", f"{out}/load_quarantine", "goods", as_of)
    goods = files.clean_goods(raw_goods, on_bad)
    result = settle(sinks.conform(psd.psd(cost, stock, goods, as_of), schemas.PSD_INFO), "velocity")
    tenants = spark.createDataFrame([(cmid,) for cmid in cmids], "cmid int")
    days.write_csv_days(dimensions.require_non_empty(result, "velocity"), f"{out}/psd", asked=days.days_of(tenants, as_of))
    return counts


def inventory_psd_job(tables: Tables, out: str, as_of: str) -> None:
    """Velocity of stocked goods as gzip CSV per tenant and day."""
    names = ("cost", "inventory", "goods", "stores")
    result = settle(psd.psd_inventory_driven(*[tables[n] for n in names], as_of, ordered=False), "psd_inventory")
    asked = days.days_of(_tenants_with_facts(tables, as_of, 28), as_of).withColumnRenamed("date", "update_date")
    days.write_csv_days(result, f"{out}/psd_inventory", ("cmid", "update_date"), asked=asked)


def _buckets(spark: SparkSession) -> int:
    """As many buckets as shuffles have partitions, so both sides of a join fit."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _publish(df: DataFrame, database: str, table: str, schema: str | None = None, empty_ok: bool = False) -> None:
    conformed = df if schema is None else sinks.conform(df, schema)
    sinks.publish_swap(conformed, f"{database}.{table}", empty_ok=empty_ok)


def product_info_job(tables: Tables, as_of: str, unique_days: bool = False, database: str = "default") -> None:
    """Snapshot of the product information (C4, K3)."""
    goods = psd.active_goods(tables["goods"])
    result = product_info.product_info(
        tables["cost"], tables["inventory"], goods, tables["stores"], tables["ways"], as_of, unique_days=unique_days
    )
    _publish(result, database, "bd_product_info", schemas.PRODUCT_INFO)


def _known_on(table: DataFrame, asked: DataFrame, as_of: str) -> tuple[DataFrame, set[int]]:
    """The table as of the day, and the `asked` tenants that it has nothing for.

    A table with a `date` column is kept by day: a tenant has its rows of the day or of the day before (S18). Another
    one is taken as it is.
    """
    if "date" not in table.columns:
        held = asked.select("cmid").join(table.select("cmid").distinct(), "cmid", "left_anti")
        return table, {row.cmid for row in held.distinct().collect()}
    chosen = settle(stockout.asof_days(asked, table, as_of), "snapshot_days")
    recent = table.filter(F.col("date").between(F.date_sub(F.lit(as_of).cast("date"), 1), F.lit(as_of).cast("date")))
    return recent.join(chosen.filter("date IS NOT NULL"), ["cmid", "date"], "left_semi").drop("date"), {row.cmid for row in chosen.filter("date IS NULL").collect()}


def _without(table: DataFrame, tenants: set[int]) -> DataFrame:
    return table.filter(~F.col("cmid").isin(sorted(tenants))) if tenants else table


def stockout_report_job(
    tables: Tables,
    out: str,
    as_of: str,
    statuses: stockout.Statuses,
    wanted_stores: DataFrame | None = None,
    database: str = "default",
    maintained: bool = False,
) -> set[int]:
    """Summary and detail of the stock-out report (C7, C8, K13); returns the tenants that were left alone.

    `statuses` is one list, or (cmid, busgate) rows from `stockout.gate_statuses`;
    `wanted_stores` (cmid, foreign_store_id) restricts the report. Assortment, labels and
    stores may be kept by day in a `date` column. A tenant with sales or stock files of the day is reported; one
    without an assortment, goods or stores of the day or the day before is left alone: nothing
    of it is written or deleted. `maintained` takes last deliveries and sale days from the tables of
    `delivery_state_job` and `presence_state_job` instead of the histories.
    """
    spark = tables["cm_sku"].sparkSession
    day = F.lit(as_of).cast("date")
    asked = settle(tables["inventory"].filter(F.col("date") == day).select("cmid").union(tables["cost"].filter(F.col("date") == day).select("cmid")).distinct(), "report_tenants")
    known, skipped = {}, set()
    for name in ("cm_sku", "goods", "stores", "aa_sku", "refunds"):
        known[name], missing = _known_on(tables[name], asked, as_of)
        if name == "cm_sku" or (name in ("goods", "stores") and "date" in tables[name].columns):
            skipped |= missing
    reported = _without(asked, skipped)
    tables = dict(tables) | known | {"cm_sku": known["cm_sku"].join(reported, "cmid", "left_semi")}
    last = delivery_state.last_days(spark.table(f"{database}.delivery_state")) if maintained else None
    history = None
    if maintained:
        state = spark.table(f"{database}.presence_state")
        if state.filter(F.col("as_of") != day).limit(1).count():
            raise ValueError(f"the presence state is not that of {as_of}")
        history = presence_state.sale_history(state)
    dates = settle(
        stockout.reference_dates(tables["delivery"], tables["suggestions"], tables["stores"], last), "reference_dates"
    )
    causes = [tables[n] for n in ("inventory", "cm_sku", "delivery", "suggestions", "require_orders")]
    labels = [tables[n] for n in ("aa_sku", "refunds", "warehouse", "goods")]
    summary = stockout.stockout_summary(*causes, dates, as_of, statuses, wanted_stores)
    detail = stockout.stockout_detail(tables["cost"], *causes, *labels, dates, as_of, statuses, wanted_stores, history)
    sheets = (("report_summary", summary, schemas.REPORT_SUMMARY), ("report_detail", detail, schemas.REPORT_DETAIL))
    for name, sheet, schema in sheets:
        table = _daily(spark, database, name, schema, out)
        days.replace(sinks.conform(sheet.select("*", day.alias("date")), schema), table, days.days_of(reported, as_of))
    return skipped


def stockout_load_job(tables: Tables, out: str, as_of: str, database: str = "default") -> set[int]:
    """Report of one day into the monitoring tables (C11, C12, K7); a day without a report is skipped.

    Both tables are replaced for the day of every tenant of the report, also where all its
    stores have closed or no item is empty any more. A tenant without a store snapshot of the day or the day before
    can't be judged: both tables keep what they have for it, and it is returned.
    """
    day = F.to_date("date") == F.lit(as_of).cast("date")
    summary, detail = tables["summary_sheet"].filter(day), tables["detail_sheet"].filter(day)
    asked = settle(summary.select("cmid").distinct(), "report_tenants")
    known, skipped = _known_on(tables["stores"], asked, as_of)
    tenants = settle(_without(asked, skipped), "loaded_tenants")
    if tenants.isEmpty():
        return skipped
    summary, detail = _without(summary, skipped), _without(detail, skipped)
    spark = summary.sparkSession
    labels = settle(reports.store_labels(known, tables["use_cm_stores"]), "store_labels")
    stores = sinks.conform(reports.store_info_load(summary, labels), schemas.STORE_INFO)
    days.write_daily(stores, _daily(spark, database, "store_info", schemas.STORE_INFO, out), as_of, tenants)
    first = settle(reports.first_suggestion_date(tables["suggestion_files"]), "first_dates")
    loaded = reports.product_exception_load(detail, labels, first, tables["psd"], as_of)
    products = sinks.conform(loaded, schemas.STORE_PRODUCT_INFO)
    days.write_daily(products, _daily(spark, database, "store_product_info", schemas.STORE_PRODUCT_INFO, out), as_of, tenants)
    return skipped


def report_to_load_job(spark: SparkSession, tables: Tables, out: str, as_of: str, database: str = "default") -> set[int]:
    """The stored report of one day, with the stored velocity, into the monitoring tables."""
    sheets = {
        "summary_sheet": reports.summary_sheet(spark.table(f"{database}.report_summary")),
        "detail_sheet": reports.detail_sheet(spark.table(f"{database}.report_detail")),
        "psd": spark.table(f"{database}.psd_info"),
    }
    return stockout_load_job(dict(tables) | sheets, out, as_of, database)


def trial_job(tables: Tables, out: str, today: str, database: str = "default") -> None:
    """Trial stores: replace the due days, then publish the new state.

    What is replaced are the due days of tenants whose summary sheet has that day, also where none of their rows is
    left.
    """
    stores = tables["trial_stores"]
    spark = stores.sparkSession
    due = trial.trial_expand(stores, today).select("cmid", "date").distinct()
    sheet_days = tables["summary_sheet"].select("cmid", F.to_date("date").alias("date")).distinct()
    asked = settle(due.join(sheet_days, ["cmid", "date"], "left_semi"), "due_days")
    loads = (
        ("new_store_info", trial.trial_store_load(tables["summary_sheet"], stores, today), schemas.STORE_INFO),
        ("new_store_product_info", trial.trial_product_load(tables["detail_sheet"], stores, tables["psd"], today), schemas.STORE_PRODUCT_INFO),
    )
    for name, rows, schema in loads:
        days.replace(sinks.conform(rows, schema), _daily(spark, database, name, schema, out), asked)
    _publish(trial.trial_state(stores, today), database, "use_cm_stores")


def item_maps_job(spark: SparkSession, out: str, loaded_days: Sequence[str] | None = None, database: str = "default") -> None:
    """Bitmaps of the empty items of every store and day (A5), for the weekly tables.

    `loaded_days` are the days of `store_product_info` that were loaded since the last run; without them all are read.
    """
    products = spark.table(f"{database}.store_product_info")
    if loaded_days is not None:
        products = products.filter(F.col("date").isin([dt.date.fromisoformat(day) for day in loaded_days]))
    asked = None
    if loaded_days:
        every = F.explode(F.array(*[F.lit(dt.date.fromisoformat(day)) for day in loaded_days])).alias("date")
        asked = spark.table(f"{database}.store_info").select("cmid").distinct().select("cmid", every)
    for name, column, count_null in (("item_maps", "foreign_item_id", False), ("code_maps", "item_show_code", True)):
        numbers = f"{database}.{name}_numbers"
        known = spark.table(numbers) if sinks.table_exists(spark, numbers) else item_bitmaps.no_numbers(spark)
        sinks.publish_swap(item_bitmaps.numbered(known, products, column, count_null), numbers, empty_ok=True)
        maps = item_bitmaps.day_maps(products, spark.table(numbers), column, count_null)
        days.replace(sinks.conform(maps, item_bitmaps.DAY_MAPS), _daily(spark, database, name, item_bitmaps.DAY_MAPS, out), asked)


def weekly_job(spark: SparkSession, tables: Tables, as_of: str, database: str = "default", maintained: bool = False) -> None:
    """Weekly tables from the monitoring tables (C15, C18, K12); `maintained` counts items by the bitmaps of `item_maps_job`."""
    info, products = spark.table(f"{database}.store_info"), spark.table(f"{database}.store_product_info")
    by_reason = weekly.week_reasons(products, ordered=False)
    _publish(by_reason, database, "store_product_week", schemas.STORE_PRODUCT_WEEK)
    lost = item_bitmaps.week_items(spark.table(f"{database}.code_maps"), "monday", STORE) if maintained else None
    recent = weekly.week_store_info_df(info, products, tables["stores"], as_of, lost)
    _publish(recent, database, "store_info_week", schemas.STORE_INFO_WEEK)


def trial_weekly_job(spark: SparkSession, database: str = "default") -> None:
    """Weekly tables from the trial tables."""
    info, products = spark.table(f"{database}.new_store_info"), spark.table(f"{database}.new_store_product_info")
    by_reason = weekly.week_reasons(products, classes=5, ordered=False)
    _publish(by_reason, database, "new_store_product_week", schemas.NEW_STORE_PRODUCT_WEEK)
    _publish(weekly.week_store_info(info, products), database, "new_store_info_week", schemas.NEW_STORE_INFO_WEEK)


def assortment_job(
    tables: Tables,
    as_of: str,
    days_delay: int = 0,
    ignored_categories: Sequence[str] = (),
    database: str = "default",
    settings: DataFrame | None = None,
) -> None:
    """Store-item cache (C19); `settings` has the delay and the ignored categories of each tenant."""
    names = ("cost", "inventory", "goods", "stores")
    result = assortment.sku_cache(*[tables[n] for n in names], as_of, days_delay, ignored_categories, settings)
    _publish(result, database, "bd_product_store", schemas.PRODUCT_STORE)


def supervisor_job(tables: Tables, database: str = "default") -> None:
    """Store to supervisor map of every tenant (C20)."""
    people = supervisor.active_supervisors(tables["user_identity"], tables["identity"], tables["users"])
    result = supervisor.supervisor_map(people, tables["store_resources"])
    _publish(result, database, "store_supervisor", schemas.STORE_SUPERVISOR)


def replenish_job(tables: Tables, as_of: str, database: str = "default") -> None:
    """Replenishment history and the rows it had to leave out.

    A row read twice counts once; two different rows of one day fail the job. Products and daily series are written
    in the same buckets of store items, so that joining, windows and the fold read them without another shuffle.
    """
    spark = tables["cost"].sparkSession
    series = actual_sale.unique_daily_series(tables["cost"], tables["inventory"], as_of)
    for name, rows in (("bd_daily_series", series), ("bd_product_pairs", tables["products"])):
        sinks.publish_swap(rows, f"{database}.{name}", empty_ok=True, buckets=(_buckets(spark), PAIR))
    cycles = tables["cycles"].select(*STORE, cycle_code(F.col("dly_cycle")).alias("period_type_num"))
    prepared = replenish.replenish_input(spark.table(f"{database}.bd_product_pairs"), tables["packs"], cycles, spark.table(f"{database}.bd_daily_series"))
    history = replenish.replenish_history(prepared)
    _publish(history, database, "bd_product_history", schemas.PRODUCT_HISTORY)
    _publish(replenish.replenish_rejects(prepared), database, "bd_product_history_rejects", empty_ok=True)


def backfill_job(tables: Tables, as_of: str, database: str = "default") -> None:
    """Replenishment history with the actual stock filled in."""
    spark = tables["cost"].sparkSession
    series = actual_sale.actual_sale(tables["cost"], tables["inventory"], as_of)
    filled = actual_sale.backfill_actual_stock(spark.table(f"{database}.bd_product_history"), series)
    _publish(filled, database, "bd_product_history", schemas.FILLED_HISTORY)
