import datetime as dt
import os
import threading
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfwise.sinks import days as day_tables
from shelfwise.sinks import mirror
from shelfwise.sinks import tables as sinks
from shelfwise.sources import scratch

SCHEMA = "cmid int, date date, item string, qty int"


def frame(spark, *rows):
    return spark.createDataFrame([(c, dt.date.fromisoformat(d), i, q) for c, d, i, q in rows], SCHEMA)


def content(df):
    return sorted((r.cmid, str(r.date), r.item, r.qty) for r in df.select("cmid", "date", "item", "qty").collect())


@pytest.fixture
def table(spark, tmp_path):
    """A new daily table."""
    name = f"days_{uuid.uuid4().hex[:10]}"
    day_tables.create(spark, name, SCHEMA, f"{tmp_path}/{name}")
    return name


def test_write_daily(spark, table):
    old = frame(
        spark,
        (43, "2024-01-01", "expired", 1),
        (43, "2024-01-07", "on the limit", 1),
        (43, "2024-01-08", "kept", 1),
        (43, "2024-03-31", "replaced", 1),
        (85, "2024-03-31", "tenant without new rows", 1),
        (34, "2024-03-30", "other day", 1),
    )
    new = frame(spark, (43, "2024-03-31", "new", 2), (34, "2024-03-31", "new", 3))
    expected = [
        (34, "2024-03-30", "other day", 1),
        (34, "2024-03-31", "new", 3),
        (43, "2024-01-08", "kept", 1),
        (43, "2024-03-31", "new", 2),
        (85, "2024-03-31", "tenant without new rows", 1),
    ]
    day_tables.replace(old, table)
    for _ in range(2):
        day_tables.write_daily(new, table, "2024-03-31", new)
        assert content(spark.table(table)) == expected
    assert day_tables.partitions(spark, table) == {(str(c), d) for c, d, _, _ in expected}


def test_partition_replace(spark, table):
    old = frame(spark, (43, "2024-01-01", "a", 1), (43, "2024-01-02", "b", 1), (85, "2024-01-01", "c", 1))
    new = frame(spark, (43, "2024-01-01", "n", 2), (43, "2024-01-03", "m", 2))
    expected = [(43, "2024-01-01", "n", 2), (43, "2024-01-02", "b", 1), (43, "2024-01-03", "m", 2), (85, "2024-01-01", "c", 1)]
    day_tables.replace(old, table)
    day_tables.replace(new, table)
    assert content(spark.table(table)) == expected
    asked = day_tables.days_of(frame(spark, (43, "2024-01-01", "", 0), (77, "2024-01-01", "", 0)), "2024-01-02", "2024-01-04")
    day_tables.replace(frame(spark, (43, "2024-01-04", "z", 3)), table, asked)
    assert content(spark.table(table)) == [expected[0], (43, "2024-01-04", "z", 3), expected[3]]


def test_a_refused_load_changes_nothing(spark, table):
    day_tables.replace(frame(spark, (43, "2024-01-01", "a", 1)), table)
    bad = frame(spark, (43, "2024-01-01", "b", 2)).withColumn("cmid", F.lit(None).cast("int"))
    with pytest.raises(ValueError, match="without cmid or date"):
        day_tables.replace(bad, table)
    with pytest.raises(ValueError, match="no rows"):
        day_tables.replace(bad.limit(0), table, frame(spark, (43, "2024-01-01", "", 0)), empty_ok=False)
    assert content(spark.table(table)) == [(43, "2024-01-01", "a", 1)]


def test_a_reader_never_fails_while_days_are_replaced_and_dropped(spark, table):
    day_tables.replace(frame(spark, (43, "2024-01-01", "a", 0), (85, "2024-01-01", "b", 0)), table)
    stop, seen, errors = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(content(spark.table(table).filter("cmid = 43"))[0][3])
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    asked = frame(spark, (85, "2024-01-01", "", 0))
    for n in range(1, 8):
        rows = [(43, "2024-01-01", "a", n)] + ([(85, "2024-01-01", "b", n)] if n % 2 else [])
        day_tables.replace(frame(spark, *rows), table, asked)
    stop.set()
    reader.join()
    assert not errors and seen == sorted(seen) and len(seen) > 1
    assert content(spark.table(table)) == [(43, "2024-01-01", "a", 7), (85, "2024-01-01", "b", 7)]


def test_left_folders_are_deleted_after_some_loads(spark, table, tmp_path):
    for n in range(7):
        day_tables.replace(frame(spark, (43, "2024-01-01", "a", n)), table)
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")]
    assert len(files) == 1 + day_tables.KEPT_LOADS
    assert content(spark.table(table)) == [(43, "2024-01-01", "a", 6)]


def test_a_crash_before_the_catalog_leaves_the_old_day(spark, table, monkeypatch):
    day_tables.replace(frame(spark, (43, "2024-01-01", "a", 1)), table)

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(day_tables, "partitions", crash)
    with pytest.raises(RuntimeError):
        day_tables.replace(frame(spark, (43, "2024-01-01", "a", 2)), table)
    monkeypatch.undo()
    assert content(spark.table(table)) == [(43, "2024-01-01", "a", 1)]
    day_tables.replace(frame(spark, (43, "2024-01-01", "a", 3)), table)
    assert content(spark.table(table)) == [(43, "2024-01-01", "a", 3)]


def test_retention_is_one_statement(spark, table, monkeypatch):
    day_tables.replace(frame(spark, *[(c, f"2024-01-{d:02d}", "x", 1) for c in (43, 85) for d in range(1, 21)]), table)
    said = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or real(self, text, *a, **k))
    gone = day_tables.expire(spark, table, "2024-01-20", 10)
    assert len(gone) == 20 and len([t for t in said if t.startswith(f"ALTER TABLE {table} DROP")]) == 1
    assert {r[1] for r in content(spark.table(table))} == {f"2024-01-{d:02d}" for d in range(11, 21)}


def test_mirror_copies_only_what_differs(spark, table, tmp_path, monkeypatch):
    rows = [(c, f"2024-01-{d:02d}", "x", d) for c in (43, 85) for d in range(1, 6)]
    day_tables.replace(frame(spark, *rows), table)
    copy, root = f"{table}_copy", f"{tmp_path}/copy"
    assert mirror.mirror(spark, table, copy, root) == 10
    assert mirror.mirror(spark, table, copy, root) == 0
    copied = []
    real = day_tables.replace
    monkeypatch.setattr(day_tables, "replace", lambda df, *a, **k: copied.append(df) or real(df, *a, **k))
    # a null is not an empty text, and a value may move between columns
    real(frame(spark, (43, "2024-01-03", None, 3)), table)
    assert mirror.mirror(spark, table, copy, root) == 1
    assert [(r.cmid, str(r.date)) for r in copied[-1].collect()] == [(43, "2024-01-03")]
    assert "PartitionFilters: [isnotnull" in copied[-1]._jdf.queryExecution().executedPlan().toString()
    day_tables.drop(spark, table, [("85", "2024-01-01")])
    assert mirror.mirror(spark, table, copy, root) == 1
    assert content(spark.table(copy).na.fill("")) == content(spark.table(table).na.fill(""))
    # the order and the number of files do not count
    real(frame(spark, *[r for r in reversed(rows) if r[0] == 43 and r[3] != 3]).repartition(3), table)
    assert mirror.mirror(spark, table, copy, root) == 0
    monkeypatch.setattr(day_tables, "replace", lambda *a, **k: None)
    real(frame(spark, (43, "2024-01-03", "new", 3)), table)
    with pytest.raises(RuntimeError, match="does not agree"):
        mirror.mirror(spark, table, copy, root)


def test_delete_folders(spark, tmp_path):
    folder = tmp_path / "it's a folder"
    frame(spark, (43, "2024-01-01", "a", 1)).write.parquet(str(folder))
    scratch.delete_folders(spark, [str(folder), f"{tmp_path}/missing"])
    assert not folder.exists()


def test_no_private_handles():
    from pathlib import Path

    package = Path(sinks.__file__).parents[1]
    assert not [str(f) for f in package.rglob("*.py") if "llm" not in f.parts and ("_jvm" in f.read_text() or "_jsc" in f.read_text())]


def test_csv_days(spark, tmp_path):
    path = f"{tmp_path}/csv"
    df = frame(spark, (43, "2024-01-01", "a", 1), (43, "2024-01-02", "b,c", None))
    day_tables.write_csv_days(df, path)
    back = spark.read.schema("item string, qty int, cmid int, date date").option("header", True).csv(path)
    assert content(back) == content(df)
    names = [f for _, _, files in os.walk(path) for f in files if f.endswith(".csv.gz")]
    assert len(names) == 2


def test_replace_append_exists(spark):
    assert not sinks.table_exists(spark, "sink_a")
    target = spark.createDataFrame([], "cmid int, date date, item string, qty double").schema
    sinks.replace_table(frame(spark, (43, "2024-01-01", "a", 1)), "sink_a", target)
    assert sinks.table_exists(spark, "sink_a")
    reordered = frame(spark, (43, "2024-01-02", "b", 2)).select("qty", "item", "date", "cmid")
    sinks.append_table(reordered, "sink_a")
    table = spark.table("sink_a")
    assert table.schema["qty"].dataType.simpleString() == "double"
    assert content(table) == [(43, "2024-01-01", "a", 1.0), (43, "2024-01-02", "b", 2.0)]
    sinks.replace_table(frame(spark, (43, "2024-01-05", "z", 9)), "sink_a")
    assert content(spark.table("sink_a")) == [(43, "2024-01-05", "z", 9)]


def test_conform_by_ddl(spark):
    df = sinks.conform(frame(spark, (43, "2024-01-01", "a", 1)), "item string, qty double")
    assert df.dtypes == [("item", "string"), ("qty", "double")]
    with pytest.raises(AnalysisException):
        sinks.conform(df, "missing int")


def test_append_needs_the_columns(spark):
    sinks.replace_table(frame(spark, (43, "2024-01-01", "a", 1)), "sink_b")
    with pytest.raises(AnalysisException):
        sinks.append_table(spark.range(1), "sink_b")


def test_a_tenant_that_has_no_rows_any_more_loses_its_day(spark, table):
    day = "2024-03-31"
    old = frame(spark, (43, day, "gone", 1), (43, "2024-03-30", "kept", 1), (85, day, "not loaded", 1), (34, day, "old", 1))
    day_tables.replace(old, table)
    new = frame(spark, (34, day, "new", 2))
    loaded = spark.createDataFrame([(43,), (34,), (34,)], "cmid int")
    expected = [(34, day, "new", 2), (43, "2024-03-30", "kept", 1), (85, day, "not loaded", 1)]
    for _ in range(2):
        day_tables.write_daily(new, table, day, loaded)
        assert content(spark.table(table)) == expected
    day_tables.write_daily(new.limit(0), table, day, loaded)
    assert content(spark.table(table)) == expected[1:]


def test_swap_keeps_the_last_versions_and_never_fails_a_reader(spark):
    sinks.publish_swap(frame(spark, (43, "2024-01-01", "a", 0)), "read_on")
    stop, seen, errors = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(content(spark.table("read_on"))[0][3])
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 7):
        sinks.publish_swap(frame(spark, (43, "2024-01-01", "a", n)), "read_on")
    stop.set()
    reader.join()
    assert not errors and seen == sorted(seen) and len(seen) > 1
    assert len(sinks.versions(spark, "read_on")) == sinks.KEPT_VERSIONS


def test_a_crash_between_the_steps_leaves_the_old_version(spark, monkeypatch):
    sinks.publish_swap(frame(spark, (43, "2024-01-01", "a", 1)), "crashing")
    saved = sinks._saved

    def crash(*args):
        saved(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "_saved", crash)
    with pytest.raises(RuntimeError):
        sinks.publish_swap(frame(spark, (43, "2024-01-01", "a", 2)), "crashing")
    assert content(spark.table("crashing")) == [(43, "2024-01-01", "a", 1)]
    monkeypatch.undo()
    with pytest.raises(ValueError, match="must not become empty"):
        sinks.publish_swap(frame(spark, (43, "2024-01-01", "a", 2)).limit(0), "crashing")
    assert content(spark.table("crashing")) == [(43, "2024-01-01", "a", 1)]
    sinks.publish_swap(frame(spark, (43, "2024-01-01", "a", 3)), "crashing")
    assert content(spark.table("crashing")) == [(43, "2024-01-01", "a", 3)]


def test_swap_keeps_one_version(spark):
    for n in (1, 2):
        sinks.publish_swap(frame(spark, (43, "2024-01-01", "a", n)), "live", keep=1)
        assert content(spark.table("live")) == [(43, "2024-01-01", "a", n)]
    assert len(sinks.versions(spark, "live")) == 1


def test_jdbc_options_are_chunked():
    options = sinks.jdbc_options("jdbc:postgresql://host/db", "t")
    assert (options["batchsize"], options["dbtable"]) == ("5000", "t")


def test_rows_of_a_large_partition_are_not_brought_together(spark, table):
    """Its folder is found where its rows lie, not by a join that sorts them all in one task."""
    day_tables.replace(frame(spark, (43, "2024-01-07", "a", 1), (43, "2024-01-08", "b", 1), (85, "2024-01-08", "c", 1)), table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = day_tables.within(spark.table(table), day_tables.DAY_PARTITION, {("43", "2024-01-08"), ("85", "2024-01-07")})
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert content(found) == [(43, "2024-01-08", "b", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
