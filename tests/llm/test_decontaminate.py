import duckdb
import pytest

from shelfwise.llm import decontaminate
from shelfwise.llm.queries import ORACLES, QUERIES
from shelfwise.llm.shared import table
from tests.llm.support import awkward, docs_of, rows_of

ITEM = " ".join(f"i{k}" for k in range(24))


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


@pytest.mark.parametrize("data", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    assert rows_of(QUERIES["op7_decontamination"](spark, data)) == sorted(con.sql(ORACLES["op7_decontamination"]).fetchall(), key=str)


def test_items_inside_long_documents(spark):
    padding = " ".join(f"p{k}" for k in range(20_000))
    edited = ITEM.replace("i23", "other")
    broken = ITEM.replace("i5 ", "x ").replace("i11 ", "y ").replace("i17 ", "z ")
    docs = docs_of(spark, [f"{padding} {ITEM.upper()}, {padding}", f"{padding} {edited}", broken, padding, ITEM])
    found = rows_of(decontaminate.contained(docs, items_of(spark, [ITEM, padding])))
    assert found == [(0, 0, 20, 20), (0, 1, 19996, 19996), (1, 0, 19, 20), (1, 1, 19996, 19996), (3, 1, 19996, 19996), (4, 0, 20, 20)]
    assert rows_of(decontaminate.without_contained(docs, items_of(spark, [ITEM])).select("doc_id")) == [(2,), (3,)]


@pytest.mark.parametrize("size", range(1, 60, 7))
def test_the_search_misses_nothing_at_the_threshold(spark, size):
    """Drop as many shingles as the threshold allows, always from the item's smallest hashes."""
    words = [f"v{k}" for k in range(size + 4)]
    items = decontaminate.shingled(items_of(spark, [" ".join(words)]), "item_id")
    sketch = decontaminate.sketches(items, 0.8).count()
    assert sketch >= min(size, int(0.2 * size + 1e-9) + 1)


def test_beyond_the_broadcast_bound_the_result_is_the_same(spark, monkeypatch):
    data = "/root/testdata/sf0.001"
    docs, items = table(spark, data, "documents"), table(spark, data, "benchmark")
    wanted = rows_of(decontaminate.contained(docs, items))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert rows_of(decontaminate.contained(docs, items)) == wanted


def test_no_python_in_the_plan(spark, capsys):
    QUERIES["op7_decontamination"](spark, "/root/testdata/sf0.001").explain()
    QUERIES["op3_url_filter"](spark, "/root/testdata/sf0.001").explain()
    plans = capsys.readouterr().out
    assert not any(word in plans for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_awkward_rows(spark):
    rows = awkward(spark)
    items = items_of(spark, [None, "", "too short", "one two three four five six", "one two three four five six"])
    assert rows_of(decontaminate.contained(rows, items)) == [(5, 3, 2, 2), (5, 4, 2, 2)]
    assert rows_of(decontaminate.contained(rows, items_of(spark, ["", "!?"]))) == []
    left = decontaminate.without_contained(rows, items)
    assert left.columns == rows.columns and left.count() == rows.count() - 2
    assert decontaminate.contained(rows.limit(0), items).count() == 0
    assert decontaminate.contained(rows, items.limit(0)).count() == 0


def test_short_items_and_scripts_without_spaces(spark, tmp_path):
    """Items of one to four words, and sentences in which each character is a word, against the SQL."""
    chinese = "今天天气很好我们去公园散步"
    items = ["Yes", "two words", "a b c", "one two three four", chinese, "好", "one two three four five", "yes yes", ""]
    texts = ["yes, TWO words! a b c", "yesterday words two", "one two, three four five", f"他说{chinese}吗", chinese.replace("天", "田"), "a b x c yes", None, "", "สวัสดีครับ", "yes yes yes"]
    docs, benchmark = docs_of(spark, texts), items_of(spark, items)
    found = rows_of(decontaminate.contained(docs, benchmark))
    con = duckdb.connect()
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents")
    benchmark.write.parquet(f"{tmp_path}/benchmark")
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    assert found == sorted(con.sql(ORACLES["op7_decontamination"]).fetchall(), key=str)
    pairs = {r[:2] for r in found}
    assert pairs >= {(0, 0), (0, 1), (0, 2), (2, 3), (2, 6), (3, 4), (3, 5), (5, 0), (9, 7)} and not {(1, 0), (1, 1), (5, 2), (4, 4)} & pairs
    # the filter leaves items of fewer than five words aside unless it is told to use them
    assert {r.doc_id for r in decontaminate.without_contained(docs, benchmark).collect()} == {0, 1, 4, 5, 6, 7, 8, 9}
    assert {r.doc_id for r in decontaminate.without_contained(docs, benchmark, shortest=4).collect()} == {0, 1, 4, 5, 6, 7, 8, 9}
    assert {r.doc_id for r in decontaminate.without_contained(docs, benchmark, shortest=3).collect()} == {1, 4, 5, 6, 7, 8, 9}
