import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfwise.llm import decontaminate, neardup, pii, quality
from shelfwise.llm.shared import table
from tests.llm.support import awkward, rows_of

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, DATA, "documents").cache()
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], DATA).cache())
    return out


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "tokens"]
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_each_stage_equals_brute_force(spark, stages):
    texts = [{r.doc_id: r.text for r in frame.collect()} for frame in stages]
    model = quality.train(stages[0], table(spark, DATA, "labels"))
    assert texts[1] == {i: t for i, t in texts[0].items() if quality.score(model, t or "") >= 0.5}
    classes = dict(rows_of(neardup.classes(stages[1])))
    assert texts[2] == {i: texts[1][i] for i in set(classes.values())}
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    items = [shingles(words(r.text)) for r in table(spark, DATA, "benchmark").collect()]
    clean = {i: t for i, t in texts[2].items() if not any(5 * len(s & shingles(words(t))) >= 4 * len(s) > 0 for s in items)}
    assert texts[3] == clean and len(clean) < len(texts[2])
    spans = dict(zip(clean, (every for _, every in pii.all_spans(pii.train(), list(clean.values()))), strict=True))
    assert texts[4] == {i: pii.masked_text(t, spans[i]) for i, t in clean.items()}
    assert any(spans.values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in stages[-1].collect():
        assert row.token_ids == library.encode(texts[4][row.doc_id], add_special_tokens=False).ids


def test_run_equals_the_stages(spark, stages):
    assert rows_of(corpus_pipeline.run(spark, DATA)) == rows_of(stages[-1])


@pytest.mark.parametrize("stage", range(5))
def test_awkward_rows(spark, stage):
    rows = awkward(spark)
    out = corpus_pipeline.STAGES[stage][1](spark, rows, DATA)
    if stage < 4:
        assert out.columns == rows.columns
    if stage in (1,):  # the repeated row goes, the row without an id stays
        assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 5, 6, 7]
    if stage in (2, 3, 4):
        assert out.count() == rows.count()
    assert corpus_pipeline.STAGES[stage][1](spark, rows.limit(0), DATA).count() == 0


def test_different_texts_of_one_id_stay(spark):
    one, two, three = (" ".join(f"{name}{k}" for k in range(60)) for name in ("red", "green", "blue"))
    rows = [(7, one, "b"), (7, two, "a"), (7, three, "a"), (7, one, "a"), (3, one + " end", "a"), (9, two + " end", "a"), (11, three, "a"), (None, one, "a"), (12, None, "a"), (12, "", "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted = sorted([(3, one + " end", "a"), (7, two, "a"), (7, three, "a"), (None, one, "a"), (12, None, "a"), (12, "", "a")], key=str)
    assert rows_of(corpus_pipeline.drop_near_duplicates(spark, frame, DATA)) == wanted
    again = spark.createDataFrame([(1, one, s) for s in "abcdef"], "doc_id long, text string, source string")
    left = [rows_of(corpus_pipeline.drop_near_duplicates(spark, rows, DATA)) for rows in (again.repartition(5), again.orderBy(F.desc("source")).coalesce(1))]
    assert left[0] == left[1] and len(left[0]) == 1


def test_decontamination_stage_reads_the_benchmark(spark):
    item = table(spark, DATA, "benchmark").first()
    docs = spark.createDataFrame([(1, item.text + " and more words after it"), (2, "clean words only in this one")], "doc_id long, text string")
    assert rows_of(decontaminate.without_contained(docs, table(spark, DATA, "benchmark"))) == [(2, "clean words only in this one")]
