"""Object-store scans.

Paths are lists of globs or file metadata, never downloads: listings come from Spark's
file index and a filter on the path prunes files before any of them is opened.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.numbers import zero_if_null
from shelfwise.keys import ITEM
from shelfwise.operators.psd import active_goods
from shelfwise.sources import layouts
from shelfwise.sources.scratch import settle

# Object layout of the source systems; `day_layout` also accepts key=value folders.
DAY_LAYOUT = "{y}/{m}/{d}/{source_id}/{table}"
HIVE_DAY_LAYOUT = "y={y}/m={m}/d={d}/source_id={source_id}/table={table}"


def days_back(as_of: str, days: int = 28) -> list[str]:
    """ISO days of the window that ends at `as_of`, oldest first."""
    end = dt.date.fromisoformat(as_of)
    return [(end - dt.timedelta(days=n)).isoformat() for n in range(days - 1, -1, -1)]


def day_folders(dates: Iterable[str], source_id: str | Sequence[str], table: str, layout: str = DAY_LAYOUT) -> list[str]:
    """One folder per day and source, relative to the root."""
    sources = [source_id] if isinstance(source_id, str) else source_id
    return [layout.format(y=date[:4], m=date[5:7], d=date[8:], source_id=source, table=table) for date in dates for source in sources]


def read_existing(
    spark: SparkSession,
    root: str,
    folders: Sequence[str],
    schema: str,
    file_glob: str = "*.gz",
    header: bool = False,
    none_ok: bool = False,
) -> DataFrame:
    """CSV files of the folders that exist.

    All folders form one glob, so a missing day just does not match. That no folder at all
    exists is an error, since it may be a wrong date; with `none_ok` it is an empty table.
    """
    reader = spark.read.schema(schema).option("pathGlobFilter", file_glob).option("header", header)
    try:
        return reader.csv(f"{root}/{{{','.join(folders)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if not none_ok:
            raise FileNotFoundError(f"none of the {len(folders)} folders exists below {root}") from error
        return spark.createDataFrame([], schema)


# The table folder and column layout of each kind of file.
KINDS = {
    "cost": layouts.COST,
    "inventory": layouts.INVENTORY,
    "chain_store": layouts.STORES,
}


def read_raw_days(
    spark: SparkSession,
    root: str,
    dates: Iterable[str],
    source_id: str | Sequence[str],
    table: str,
    day_layout: str = DAY_LAYOUT,
    none_ok: bool = False,
) -> DataFrame:
    """All cells of the days as text, of one source or of several in one scan; `layouts.rejected` finds those that
    cannot be typed. That no source has any folder is an error; `missing_sources` finds single ones.
    """
    folders = day_folders(dates, source_id, table, day_layout)
    return read_existing(spark, root, folders, layouts.file_schema(KINDS[table]), none_ok=none_ok)


def read_cost(
    spark: SparkSession,
    root: str,
    dates: Iterable[str],
    source_id: str | Sequence[str],
    day_layout: str = DAY_LAYOUT,
    on_bad: str = "fail",
    none_ok: bool = False,
) -> DataFrame:
    """Daily sales (S1): null sale as 0 and the flag of a positive sale.

    A cell that is no number is not a null: see `layouts.typed` for `on_bad`.
    """
    return cost_rows(layouts.typed(read_raw_days(spark, root, dates, source_id, "cost", day_layout, none_ok), layouts.COST, on_bad))


def cost_rows(df: DataFrame) -> DataFrame:
    """Typed sales with null sale as 0 and the flag of a positive sale."""
    sale = zero_if_null("total_sale").cast(layouts.MONEY)
    return df.select(
        "cmid",
        "foreign_store_id",
        "foreign_item_id",
        "date",
        "sale_quantity",
        sale.alias("total_sale"),
        "total_cost",
        F.when(sale > 0, 1).otherwise(0).alias("exist"),
    )


def read_inventory(
    spark: SparkSession,
    root: str,
    dates: Iterable[str],
    source_id: str | Sequence[str],
    day_layout: str = DAY_LAYOUT,
    on_bad: str = "fail",
    none_ok: bool = False,
) -> DataFrame:
    """Daily stock (S1): null quantity as 0; a cell that is no number is not a null."""
    return inventory_rows(layouts.typed(read_raw_days(spark, root, dates, source_id, "inventory", day_layout, none_ok), layouts.INVENTORY, on_bad))


def inventory_rows(df: DataFrame) -> DataFrame:
    """Typed stock with null quantity as 0."""
    return df.withColumn("quantity", zero_if_null("quantity").cast(layouts.MONEY))


def missing_sources(spark: SparkSession, root: str, dates: Iterable[str], sources: Sequence[str], table: str, day_layout: str = DAY_LAYOUT) -> list[str]:
    """Sources without any object on all the days; names are listed once for all of them, nothing is opened."""
    try:
        listing = object_listing(spark, f"{root}/{{{','.join(day_folders(dates, sources, table, day_layout))}}}", "*.gz")
        from_end = len(day_layout.split("/")) - next(k for k, part in enumerate(day_layout.split("/")) if "{source_id}" in part) + 1
        found = {row.source for row in listing.select(path_part(F.col("path"), from_end).alias("source")).distinct().collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = set()
    return [source for source in sources if source not in found]


def read_stores(
    spark: SparkSession, root: str, date: str, source_id: str, day_layout: str = DAY_LAYOUT
) -> DataFrame:
    """Store snapshot of a day."""
    return layouts.typed(read_raw_days(spark, root, [date], source_id, "chain_store", day_layout), layouts.STORES)


def read_goods(
    spark: SparkSession, root: str, date: str, source_id: str | Sequence[str], day_layout: str = DAY_LAYOUT, on_bad: str = "fail"
) -> DataFrame:
    """Goods of the newest object of the day, cleaned (S3), of one source or of several in one scan."""
    return clean_goods(settle(read_raw_goods(spark, newest_goods(spark, root, date, source_id, day_layout)), "goods"), on_bad)  # read twice, decompressed once


def newest_goods(spark: SparkSession, root: str, date: str, source_id: str | Sequence[str], day_layout: str = DAY_LAYOUT) -> list[str]:
    """Path of the newest goods object of every source on the day; a source without one is an error."""
    sources = [source_id] if isinstance(source_id, str) else list(source_id)
    if missing := missing_sources(spark, root, [date], sources, "chain_goods", day_layout):
        raise FileNotFoundError(f"no goods object of {', '.join(missing)} in {root} on {date}")
    listing = object_listing(spark, f"{root}/{{{','.join(day_folders([date], sources, 'chain_goods', day_layout))}}}", "*.gz")
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return [row.path for row in newest_objects(listing.withColumn("folder", folder), "folder").collect()]  # one name for each source


def read_raw_goods(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Goods as written, prices still text."""
    raw = spark.read.schema(layouts.file_schema(layouts.GOODS)).csv(path if isinstance(path, str) else list(path))
    return raw.withColumn("cmid", F.col("cmid").cast("int")).select(*layouts.columns(layouts.GOODS))


def reject_malformed(goods: DataFrame, prices: Sequence[str] = ("lastin_price", "sale_price")) -> DataFrame:
    """Drop every row of an item that has a price which is not a number."""
    is_bad = F.lit(False)
    for price in prices:
        is_bad = is_bad | (F.col(price).isNotNull() & F.col(price).try_cast("double").isNull())
    return goods.join(goods.filter(is_bad).select(*ITEM).distinct(), ITEM, "left_anti")


PRICES = ("lastin_price", "sale_price")


def rounds_price(price: str) -> Column:
    """Whether a price, which is a number, has more digits than are kept."""
    kept = F.col(price).try_cast(layouts.MONEY)
    return F.col(price).try_cast("double").isNotNull() & ~F.coalesce(F.col(price).try_cast("decimal(38,18)") == kept, F.lit(False))


def clean_goods(raw: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Well-formed goods that are not discontinued; a null status stays.

    Items with a price that is no number are left out, as the source systems do (F5). A price that could only be kept
    rounded fails the query, or leaves its item out with `on_bad="reject"`; `rejected_goods` has all that is left out.
    """
    if on_bad not in ("fail", "reject"):
        raise ValueError(f"unknown choice {on_bad!r}")
    good = active_goods(reject_malformed(raw))
    if on_bad == "reject":
        good = good.join(_with_rounded_price(raw), ITEM, "left_anti")

    def kept(price: str) -> Column:
        stop = F.raise_error(F.concat(F.lit(f"{price} has more digits than are kept: "), F.col(price))).cast(layouts.MONEY)
        typed = F.col(price).try_cast(layouts.MONEY)
        return (F.when(rounds_price(price), stop).otherwise(typed) if on_bad == "fail" else typed).alias(price)

    return good.select("cmid", "foreign_item_id", "barcode", "show_code", "item_name", "item_status", *[kept(price) for price in PRICES])


def _with_rounded_price(raw: DataFrame) -> DataFrame:
    return raw.filter(rounds_price(PRICES[0]) | rounds_price(PRICES[1])).select(*ITEM).distinct()


def rejected_goods(raw: DataFrame) -> DataFrame:
    """Rows of items that `clean_goods` leaves out for their prices, as read, with the reason of the row: `type:` or
    `rounded:` and the price, or `item` where another row of the item has the fault."""
    codes = [
        F.when(F.col(price).isNotNull() & F.col(price).try_cast("double").isNull(), F.lit(f"type:{price}")).when(rounds_price(price), F.lit(f"rounded:{price}"))
        for price in PRICES
    ]
    marked = raw.withColumn("reasons", F.array_compact(F.array(*codes)))
    faulty = marked.filter(F.size("reasons") > 0).select(*ITEM).distinct()
    whole = F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit("item")))
    return marked.join(faulty, ITEM, "left_semi").withColumn("reasons", whole)


def object_listing(spark: SparkSession, root: str, file_glob: str = "*", recursive: bool = True) -> DataFrame:
    """Objects under a prefix by name pattern: path, modification time, length.

    The content column of the source is not selected, so no object is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", file_glob)
        .option("recursiveFileLookup", recursive)
        .load(root)
        .select("path", F.col("modificationTime").alias("modification_time"), "length")
    )


def newest_objects(listing: DataFrame, *keys: str, oldest: bool = False) -> DataFrame:
    """Newest (or oldest) object per key, or of the whole listing (S8); ties by path."""
    pick = F.min if oldest else F.max
    stamped = F.struct("modification_time", "path")
    return listing.groupBy(*keys).agg(pick(stamped).alias("pick")).select(*keys, "pick.path", "pick.modification_time")


def newest_path(listing: DataFrame, oldest: bool = False) -> str | None:
    """Path of the single newest object: the one row a reader needs as its argument."""
    return newest_objects(listing, oldest=oldest).first().path


MOST_DAMAGED = 1000


def damaged_files(spark: SparkSession, root: str, file_glob: str = "*.gz") -> list[str]:
    """Paths of gzip files that cannot be decompressed to their end, at most 1000; more are an error.

    Each file is decompressed piece by piece in the task that holds it and thrown away. A file is one binary value, so
    one above 2 GB fails the check.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = [path for path, content in zip(*(batch.column(c).to_pylist() for c in ("path", "content")), strict=True) if not _is_whole(content)]
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], names=["path"])

    objects = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).option("recursiveFileLookup", True).load(root)
    found = objects.select("path", "content").mapInArrow(run, "path string").limit(MOST_DAMAGED + 1).collect()
    if len(found) > MOST_DAMAGED:
        raise ValueError(f"more than {MOST_DAMAGED} damaged files below {root}")
    return sorted(row.path for row in found)


def _is_whole(content: bytes) -> bool:
    """Whether `content` is one or more complete gzip members."""
    rest = content
    while rest:
        member = zlib.decompressobj(wbits=31)
        try:
            member.decompress(rest, 1 << 20)
            while member.unconsumed_tail:
                member.decompress(member.unconsumed_tail, 1 << 20)
        except zlib.error:
            return False
        if not member.eof:
            return False
        rest = member.unused_data
    return bool(content)


def path_part(path: Column, from_end: int) -> Column:
    """Folder or file name counted from the end, without a `key=` prefix (ST3)."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -from_end), "^[^=]*=", "")


def path_date(path: Column, from_end: int) -> Column:
    """Date at the start of a folder or file name, suffix removed."""
    return F.to_date(F.regexp_extract(path_part(path, from_end), r"^(\d{4}-\d{2}-\d{2})", 1))


def read_by_path(
    spark: SparkSession,
    root: str,
    schema: str,
    first: str | None = None,
    last: str | None = None,
    file_glob: str = "*",
    tenant_from_end: int = 3,
    date_from_end: int = 1,
    header: bool = True,
    without: Sequence[str] = (),
    keep: Column | None = None,
) -> DataFrame:
    """Many files as one table with `cmid` and `date` taken from the path.

    `first` and `last` bound the date; the bounds are predicates on file metadata and skip
    whole files. A file that cannot be read to its end, or a cell that is not of its type,
    fails the query. To go on without damaged files, find them by `damaged_files`, report
    them and pass their paths as `without`: a file is read whole or not at all. `keep` is a
    further column, of the file's metadata, say.
    """
    path = F.col("_metadata.file_path")
    date = path_date(path, date_from_end)
    df = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_glob)
        .option("header", header)
        .option("mode", "FAILFAST")
        .csv(root)
    )
    if without:
        df = df.filter(~path.isin(list(without)))
    if first is not None:
        df = df.filter(date >= F.lit(first).cast("date"))
    if last is not None:
        df = df.filter(date <= F.lit(last).cast("date"))
    further = [] if keep is None else [keep]
    return df.select("*", path_part(path, tenant_from_end).cast("int").alias("cmid"), date.alias("date"), *further)
