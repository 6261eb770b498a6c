"""Benchmark decontamination by size-partitioned MinHash containment search, in Spark expressions only.

Texts become five-word shingles, hashed to 64 bits; words are lower-cased runs of letters and
digits. If any item has characters of a script that is written without spaces, each of these is a word of its own in
items and documents. A document contains an item if
it holds at least the share `threshold` of the item's distinct shingles, however long the document is.

Items are partitioned by the power of two of their size. The sketch of an item is its m smallest
shingle hashes (a bottom-m MinHash), with m = floor((1 - threshold) * u) + 1 for the largest size u
of its partition. A document that contains the item lacks at most floor((1 - threshold) * size)
of its shingles, fewer than m, so it holds one of the sketch: the search misses nothing. Only
document shingles up to the largest sketch value are looked up. Candidates are then verified by
the exact intersection of the two shingle sets.

An item of one to four words is one shingle of all its words, and is looked up among the document shingles of
that width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwise.llm.shared import bounded_broadcast, settle_counted
from shelfwise.sources.scratch import settle

WIDTH = 5
BROADCAST_ROWS = 2_000_000
"""Sketch rows or ids, of 16 bytes each, up to this many are broadcast; beyond it they are shuffled."""
BROADCAST_BYTES = 32 << 20
"""The same for items with all their shingles."""
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
"""Characters of scripts that are written without spaces between words."""


def _words(unspaced: bool) -> Column:
    text = F.lower("text")
    spaced = F.regexp_replace(text, f"({UNSPACED})", " $1 ") if unspaced else text
    return F.array_remove(F.split(spaced, r"[^\p{L}\p{N}]+"), "")


def has_unspaced(benchmark: DataFrame) -> bool:
    """Whether any item has characters of a script without spaces; only then are texts cut at these."""
    return bool(benchmark.where(F.col("item_id").isNotNull()).agg(F.max(F.col("text").rlike(UNSPACED))).first()[0])


def _shingles(width: int) -> Column:
    """Distinct hashes of the shingles of `w`, none if it has fewer words."""
    joined = ", ".join(f"get(w, i + {k})" for k in range(width))
    return F.array_distinct(F.expr(f"transform(if(size(w) >= {width}, sequence(0, size(w) - {width}), array()), i -> xxhash64({joined}))"))


def _worded(rows: DataFrame, key: str, unspaced: bool) -> DataFrame:
    """`key` and the words `w` of every row that has a key and a text.

    Nothing filters on what is made of the words, and arrays are exploded by `explode_outer`, which implies no filter: one
    would be pushed below, where every reference splits the text again.
    """
    return rows.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(F.col(key).cast("long").alias(key), _words(unspaced).alias("w"))


def shingled(rows: DataFrame, key: str, width: int = WIDTH, unspaced: bool = False) -> DataFrame:
    """`key` and the distinct shingle hashes of `text`, none for texts of fewer words."""
    return _worded(rows, key, unspaced).select(key, _shingles(width).alias("shingles"))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(h, item_id): the smallest hashes of each item, as many as its size partition asks for."""
    size = F.size("shingles")
    largest = F.pow(F.lit(2.0), F.floor(F.log2(size)) + 1) - 1
    wanted = (F.floor(F.lit(1 - threshold) * largest + 1e-9) + 1).cast("int")
    return items.select("item_id", F.explode(F.slice(F.sort_array("shingles"), F.lit(1), wanted)).alias("h"))


def short_contained(docs: DataFrame, benchmark: DataFrame, shortest: int = 1, unspaced: bool = False) -> DataFrame | None:
    """The pairs with items of `shortest` to four words; None if there is no such item.

    A single common word is contained in very many documents; the result has every such pair.
    """
    hashes = F.coalesce(*[F.when(F.size("w") == k, F.element_at(_shingles(k), 1)) for k in range(1, WIDTH)])
    worded = _worded(benchmark, "item_id", unspaced).select("item_id", F.size("w").alias("width"), hashes.alias("h"))
    items = settle(worded.distinct(), "short-items").where((F.col("width") < WIDTH) & (F.col("width") >= shortest))
    found = None
    for row in items.groupBy("width").agg(F.count(F.lit(1)).alias("rows")).orderBy("width").collect():  # four widths at most
        own = bounded_broadcast(items.where(F.col("width") == row.width).select("item_id", "h"), row.rows, BROADCAST_ROWS)
        searched = shingled(docs, "doc_id", row.width, unspaced).select("doc_id", F.explode_outer("shingles").alias("h"))
        pairs = searched.join(own, "h").select("doc_id", "item_id", F.lit(1).cast("long").alias("n_shared"), F.lit(1).cast("long").alias("n_shingles")).distinct()
        found = pairs if found is None else found.union(pairs)
    return found


def _items(benchmark: DataFrame, unspaced: bool) -> tuple[DataFrame, int]:
    """Items with five words or more and their shingles, written, with their bytes."""
    seen = Observation()
    items = shingled(benchmark, "item_id", unspaced=unspaced).distinct()
    size = F.sum(F.size("shingles").cast("long") * 8 + 32)
    written = settle(items.observe(seen, F.coalesce(size, F.lit(0)).alias("bytes")), "items")
    return written.where(F.size("shingles") > 0), seen.get["bytes"]


def contained(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, shortest: int = 1) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles): every item of `shortest` words or more that a document contains.

    Items without words, and rows with a null id or text, match nothing.
    Rows that repeat an id are searched each; a pair is returned once, with the largest overlap.
    Long texts are searched whole. Other columns are ignored; empty tables give an empty result.
    """
    unspaced = has_unspaced(benchmark)
    long = _contained(docs, benchmark, threshold, unspaced)
    short = short_contained(docs, benchmark, shortest, unspaced) if shortest < WIDTH else None
    return long if short is None else long.union(short.select(long.columns))


def _contained(docs: DataFrame, benchmark: DataFrame, threshold: float, unspaced: bool) -> DataFrame:
    """The pairs with items of five words or more."""
    items, n_bytes = _items(benchmark, unspaced)
    sketch, n_sketch = settle_counted(sketches(items, threshold).distinct(), "sketch")
    last = sketch.agg(F.max("h")).first()[0]
    if last is None:
        last = -(1 << 63)
    searched = shingled(docs, "doc_id", unspaced=unspaced).select("doc_id", F.explode_outer("shingles").alias("h")).where(F.col("h") <= last)
    hits = searched.join(bounded_broadcast(sketch, n_sketch, BROADCAST_ROWS), "h")
    candidates, n_candidates = settle_counted(hits.select("doc_id", "item_id").distinct(), "candidates")
    ids = bounded_broadcast(candidates.select("doc_id").distinct(), n_candidates, BROADCAST_ROWS)
    texts = shingled(docs.join(ids, "doc_id", "left_semi"), "doc_id", unspaced=unspaced)
    wanted = bounded_broadcast(items.withColumnRenamed("shingles", "wanted"), n_bytes, BROADCAST_BYTES)
    pairs = texts.join(bounded_broadcast(candidates, n_candidates, BROADCAST_ROWS), "doc_id").join(wanted, "item_id")
    shared = pairs.select("doc_id", "item_id", F.size(F.array_intersect("wanted", "shingles")).cast("long").alias("n_shared"), F.size("wanted").cast("long").alias("n_shingles"))
    kept = shared.where(F.col("n_shared") >= F.ceil(F.lit(threshold) * F.col("n_shingles") - 1e-9))
    return kept.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))


def without_contained(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, shortest: int = WIDTH) -> DataFrame:
    """The rows of `docs` that contain no item of `shortest` words or more; a single common word must not empty a corpus.

    Rows without an id cannot be named by a match and stay, as do null and empty texts. Rows that repeat an id go or
    stay together. All columns stay, whatever their names; an empty table gives an empty result.
    """
    found, n_found = settle_counted(contained(docs, benchmark, threshold, shortest).select("doc_id").distinct(), "contaminated")
    return docs.join(bounded_broadcast(found, n_found, BROADCAST_ROWS), "doc_id", "left_anti").select(docs.columns)


# All pairs by plain text comparison, for the small tables of the correctness check.
ORACLE = r"""
WITH rows AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
  UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(CASE WHEN (SELECT bool_or(regexp_matches(text, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]')) FROM rows WHERE kind = 'b')
    THEN regexp_replace(lower(text), '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g') ELSE lower(text) END, '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM rows),
shingles AS (
  SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) >= 5),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'b' GROUP BY id),
short AS (SELECT DISTINCT id, len(w) AS k, array_to_string(w, ' ') AS s FROM words WHERE kind = 'b' AND len(w) BETWEEN 1 AND 4),
runs AS (
  SELECT DISTINCT d.id, k.k, unnest(list_transform(range(1, len(d.w) - k.k + 2), lambda i: array_to_string(d.w[i:i + k.k - 1], ' '))) AS s
  FROM words d, (SELECT DISTINCT k FROM short) k WHERE d.kind = 'd' AND len(d.w) >= k.k)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, any_value(z.n) AS n_shingles
FROM shingles d JOIN shingles b ON d.s = b.s AND d.kind = 'd' AND b.kind = 'b' JOIN sizes z ON z.id = b.id
GROUP BY d.id, b.id HAVING count(*) * 5 >= any_value(z.n) * 4
UNION ALL SELECT d.id, b.id, CAST(1 AS bigint), CAST(1 AS bigint) FROM runs d JOIN short b ON d.s = b.s AND d.k = b.k
"""
