import math

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import langid
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import table
from tests.llm.support import awkward, docs_of


def brute_cost(model_texts, lang, text):
    """Code length by walking dictionaries of contexts, shortest first, one byte at a time."""
    used = sorted(set(b"".join(b"".join(t) for t in model_texts.values())) | {32})
    followed = {}
    for name, texts in model_texts.items():
        data = b"".join(texts)
        for k in (2, 3):
            counts = {}
            for i in range(k, len(data)):
                counts[data[i - k : i + 1]] = counts.get(data[i - k : i + 1], 0) + 1
            followed.setdefault(k, set()).update(g[:-1] for g, n in counts.items() if n > 1)
    followed[3] = {c for c in followed[3] if c[1:] in followed[2]}
    data = b"".join(model_texts[lang])
    counts = {}
    for k in range(4):
        for i in range(k, len(data)):
            counts.setdefault(data[i - k : i], {}).setdefault(data[i], 0)
            counts[data[i - k : i]][data[i]] += 1

    def chances(context):
        shorter = {s: 1 / 256 for s in used} | {-1: (256 - len(used)) / 256} if not context else chances(context[1:])
        seen = counts.get(context, {})
        total = sum(seen.values())
        left = sum(p for s, p in shorter.items() if s not in seen)
        escape = (len(seen) / (total + len(seen)) if total else 1.0) if left > 0 else 0.0
        out = {s: p * escape / left if left > 0 else 0.0 for s, p in shorter.items()}
        return out | {s: n / (total + (len(seen) if left > 0 else 0)) for s, n in seen.items()}

    bits = 0.0
    whole = b"   " + text
    for i in range(3, len(whole)):
        context = next(c for c in (whole[i - 3 : i], whole[i - 2 : i], whole[i - 1 : i], b"") if len(c) < 2 or c in followed[len(c)])
        if any(b not in used for b in context):
            context = b"" if whole[i - 1] not in used else context[-1:]
        bits -= math.log2(chances(context).get(whole[i] if whole[i] in used else -1))
    return bits


def test_costs_equal_a_byte_by_byte_coder():
    texts = {"x": [b" abra cadabra abra "], "y": [b" the cat and the hat ", b" abc "]}
    model = langid.build(texts)
    for text in (b" abra the ", b" ", b" cat hat cab ", b" bra bra "):
        found = langid.code_lengths(model, [text])[0] / langid.UNIT
        wanted = [brute_cost(texts, lang, text) for lang in model.languages]
        assert np.allclose(found, wanted, atol=len(text) / langid.UNIT)


def test_each_context_spends_the_whole_chance():
    model = langid.build({"x": [b" abra cadabra abra "], "y": [b" the cat and the hat "]})
    n = int(model.symbol.max()) + 1
    assert np.allclose(np.exp2(-model.costs / langid.UNIT).reshape(-1, n, 2).sum(axis=1), 1, atol=1e-3)


def test_texts_do_not_influence_each_other():
    model = langid.build({"x": [b" abra cadabra "], "y": [b" the cat and the hat "]})
    texts = [b" the ", b"", b" abra ", b" cat "]
    together = langid.code_lengths(model, texts)
    assert together.tolist() == [langid.code_lengths(model, [t])[0].tolist() for t in texts]
    assert together[1].tolist() == [0, 0]


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    docs = table(spark, data, "documents")
    found = QUERIES["op2_language"](spark, data).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_only_learnable_rows_teach(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "zz").otherwise(F.col("lang")))
    one, other = langid.train(docs), langid.train(changed)
    assert one.languages == other.languages and (one.costs == other.costs).all()


def test_awkward_rows(spark):
    model = langid.train(table(spark, "/root/testdata/sf0.001", "documents"))
    rows = awkward(spark)
    found = langid.identify(rows, model).collect()
    assert len(found) == rows.count()
    by_id = {r.doc_id: r for r in found}
    assert all((by_id[k].lang_pred, by_id[k].score) == ("und", 0.0) for k in (1, 2, 3, 7))
    assert by_id[5].lang_pred != "und" and by_id[None].held_out is False
    assert langid.identify(rows.limit(0), model).count() == 0
    nothing = langid.train(docs_of(spark, ["a b"]).withColumn("lang", F.lit(None).cast("string")))
    assert nothing is None
    assert {r.lang_pred for r in langid.identify(rows, nothing).collect()} == {"und"}
