"""Small tables with the awkward rows that every operator must survive."""

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, **extra):
    """Documents 0, 1, ... with the given texts; a pair gives the id as well."""
    rows = [(k if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1]) for k, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame


def awkward(spark):
    """Null id, null and empty texts, white space, repeated rows, a long text, columns with clashing names."""
    long_text = " ".join(f"word{k % 977} and" for k in range(40_000))
    return docs_of(
        spark,
        [(1, None), (2, ""), (3, " \n "), (None, "text without an id is here now"), (5, "one two three four five six"), (5, "one two three four five six"), (6, long_text), (7, "!!! ###")],
        score=1,
        spans="x",
        class_id=3,
        held_out="no",
        h=2,
        rep=4,
        token_ids="y",
        _kept=1,
    )


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)
