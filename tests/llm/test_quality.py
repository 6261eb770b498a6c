import pytest
from pyspark.sql import functions as F

from shelfwise.llm import quality
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import table
from tests.llm.support import awkward, docs_of, rows_of

NOTHING = quality.Model(b"", b"", 0.0, 0.0, 0.0)


@pytest.mark.parametrize("data", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_held_out_accuracy(spark, data):
    found = QUERIES["op10_quality"](spark, data)
    assert found.count() == table(spark, data, "documents").count()
    judged = found.where("held_out").join(table(spark, data, "labels").select("doc_id", "quality"), "doc_id").collect()
    bad = [r for r in judged if r.quality == 0]
    good = [r for r in judged if r.quality == 1]
    assert sum(r.predicted == 1 for r in good) >= 0.98 * len(good)
    assert sum(r.predicted == 0 for r in bad) >= 0.9 * len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in judged)


def test_held_out_documents_and_other_columns_are_not_learned_from(spark):
    data = "/root/testdata/sf0.001"
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    changed = docs.withColumn("text", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "x").otherwise(F.col("text")))
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = changed.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("zz"))
    assert quality.train(docs, labels) == quality.train(other, flipped)


def test_awkward_rows(spark):
    data = "/root/testdata/sf0.001"
    model = quality.train(table(spark, data, "documents"), table(spark, data, "labels"))
    rows = awkward(spark)
    found = quality.classify(rows, model).collect()
    assert len(found) == rows.count()
    assert found[0].score == found[1].score == quality.score(model, "")
    assert quality.classify(rows.limit(0), model).count() == 0
    assert quality.keep_good(rows, model).columns == rows.columns


def test_without_labels_everything_stays(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, ["a b c", None])
    assert quality.train(docs, empty) == NOTHING
    assert [r[2:] for r in rows_of(quality.classify(docs, NOTHING))] == [(0.5, 1), (0.5, 1)]
    assert quality.keep_good(docs, NOTHING).count() == 2
