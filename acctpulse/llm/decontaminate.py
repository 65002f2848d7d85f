"""Benchmark decontamination by a distributed positional inverted index.

A benchmark item's windows are its runs of ``WINDOW`` consecutive words (all
words, if it has fewer).  Corpus frequencies of all test terms are counted over
all documents; each window is looked up by its two rarest terms.  The index
stores the postings (term, doc_id, place) of the looked-up terms.  The lists of
a window's rarest and second rarest term, shifted by their offsets in the
window, are intersected to starts; each surviving start is then compared with
the document's words, so matches are exact.

Proximity matches come from the same index: a document is near an item if a span
of it, ``SLACK`` words longer than one of the item's windows, holds all different
terms of the window, in any order.  Places are told apart by cells as wide as such
a span; cells that the two rarest terms reach are compared with the document's
words.  Every phrase match is a proximity match too.

Words are the maximal runs of ASCII letters, digits and non-ASCII characters,
with A-Z lower-cased.  Defined results: null texts and texts without words have
no words and no windows; items with the same window all count; the windows of an
item with a null item_id are searched like any other (n_hit, contaminated), but
n_items and items_sha256 have no id to count or list; rows with a null doc_id, and rows that repeat a doc_id, are each
judged by their own text; empty tables give no hits; a very long text is split
into words whole, in one task, and its postings are spread like any others; ties
between equally rare terms go to the first in the window; of other columns,
``keep_clean`` keeps all and the rest read none, whatever their names."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from acctpulse.llm.common import fresh, written

WINDOW = 10
SLACK = 5
BROADCAST_ROWS = 200_000  # bound on the benchmark-side rows that are broadcast
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """The words of a text, in order, after a possibly empty first and before a possibly empty last string."""
    return F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)


def n_words(split: Column) -> Column:
    first, last = F.element_at(split, 1) == "", (F.element_at(split, -1) == "") & (F.size(split) > 1)
    return (F.size(split) - first.cast("int") - last.cast("int")).cast("long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def test_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(terms, item_ids): each distinct window and its items (without null ids, so perhaps none)."""
    item = benchmark.select("item_id", F.filter(words(F.col("text")), lambda w: w != "").alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    each = item.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("terms"))
    return each.groupBy("terms").agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids"))


def _term_counts(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """(term, freq) of all test terms over all documents."""
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    found = tokens.join(_small(terms, n_terms), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    return terms.join(found, "term", "left").select("term", F.coalesce("freq", F.lit(0)).alias("freq"))


def lookups(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with the offsets of its two rarest terms (the first of equal
    ones); a window with one term uses it twice."""
    spread = windows.select("window_id", F.posexplode("terms").alias("at", "term")).join(counts, "term")
    ranked = spread.groupBy("window_id").agg(F.array_sort(F.collect_list(F.struct("freq", "at", "term"))).alias("by"))
    pick = lambda i: F.col("by")[i]
    second = F.coalesce(F.get("by", F.lit(1)), pick(0))
    return ranked.select("window_id", pick(0)["term"].alias("term1"), pick(0)["at"].alias("at1"), second["term"].alias("term2"), second["at"].alias("at2")).join(windows, "window_id")


def index(docs: DataFrame, row: str, terms: DataFrame, n_terms: int) -> DataFrame:
    """The postings (term, row, place) of the given terms over all documents."""
    tokens = docs.select(row, F.posexplode(words(F.col("text"))).alias("place", "term"))
    return tokens.join(_small(terms, n_terms), "term", "left_semi")


def _indexed(docs: DataFrame, benchmark: DataFrame, row: str, size: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The windows, their lookups, the postings of the looked-up terms and the number of windows."""
    windows = test_windows(benchmark, size)
    windows = written(windows.select(F.xxhash64("terms").alias("window_id"), "terms", "item_ids"), "windows")
    terms = written(windows.select(F.explode("terms").alias("term")).distinct(), "terms")
    looked = written(lookups(windows, _term_counts(docs, terms, terms.count())), "lookups")
    wanted = written(looked.select(F.explode(F.array("term1", "term2")).alias("term")).distinct(), "wanted")
    return windows, looked, written(index(docs, row, wanted, wanted.count()), "postings"), windows.count()


def occurrences(docs: DataFrame, benchmark: DataFrame, row: str, size: int = WINDOW) -> DataFrame:
    """(row, start, length, item_ids) of all windows in all documents."""
    return _phrases(docs, row, *_indexed(docs, benchmark, row, size))


def _phrases(docs: DataFrame, row: str, windows: DataFrame, looked: DataFrame, postings: DataFrame, n_windows: int) -> DataFrame:
    # all lists of a document meet in one task; a start that the rarest and the
    # second rarest term agree on has both bits
    spots = looked.select("window_id", F.explode(F.array(
        F.struct(F.col("term1").alias("term"), F.col("at1").alias("at"), F.lit(1).alias("role")),
        F.struct(F.col("term2").alias("term"), F.col("at2").alias("at"), F.lit(2).alias("role")))).alias("s")).select("window_id", "s.*")
    starts = postings.repartition(row).join(_small(spots, 2 * n_windows), "term").select(row, "window_id", (F.col("place") - F.col("at")).alias("start"), "role")
    both = starts.filter("start >= 0").groupBy(row, "window_id", "start").agg(F.bit_or("role").alias("roles"))
    candidates = written(both.filter("roles = 3").select(row, "window_id", "start"), "candidates")

    rows = candidates.select(row).distinct()
    texts = docs.join(_small(rows, rows.count()), row, "left_semi").select(row, words(F.col("text")).alias("w"))
    held = candidates.join(_small(windows, n_windows), "window_id").join(texts, row)
    exact = held.filter(F.slice("w", F.col("start") + 1, F.size("terms")) == F.col("terms"))
    return exact.select(row, "start", F.size("terms").alias("length"), "item_ids")


def _with_row(docs: DataFrame) -> tuple[DataFrame, str, bool]:
    """A column that names each row: doc_id if it is a key, else a hash of id and
    text (equal rows are judged alike)."""
    repeated = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if repeated.isEmpty():
        return docs, "doc_id", True
    row = fresh("row_key", docs)
    return docs.withColumn(row, F.md5(F.concat_ws("\0", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))), row, False


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each document by
    phrase matches; n_near_items and near_items_sha256 by proximity matches."""
    docs, row, _ = _with_row(docs.select("doc_id", "text"))
    windows, looked, postings, n_windows = _indexed(docs, benchmark, row, size)
    hits = written(_phrases(docs, row, windows, looked, postings, n_windows).distinct(), "hits")
    near = _near_items(_near(docs, row, looked, postings, n_windows, SLACK), windows).groupBy(row).agg(F.sort_array(F.collect_list("item")).alias("near"))
    items = hits.select(row, F.explode("item_ids").alias("item")).groupBy(row).agg(F.sort_array(F.collect_set("item")).alias("items"))
    # words in the union of the occurrences: what each adds beyond the furthest end before it
    span = hits.groupBy(row, "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = F.max("end").over(W.partitionBy(row).orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    added = span.select(row, "start", "end", F.greatest(F.coalesce(before, F.lit(0)), "start").alias("from"))
    hit = added.groupBy(row).agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"))
    found = hit.join(items, row, "left")
    counted = docs.select("doc_id", *([row] if row != "doc_id" else []), n_words(words(F.col("text"))).alias("n_words"))
    out = counted.join(found, row, "left").join(near, row, "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        F.size(F.coalesce("near", none)).cast("long").alias("n_near_items"),
        F.sha2(F.array_join(F.coalesce("near", none), ","), 256).alias("near_items_sha256"))


def proximity(docs: DataFrame, benchmark: DataFrame, slack: int = SLACK, size: int = WINDOW) -> DataFrame:
    """(doc_id, item_id), each once, of the documents near an item; items without an
    id are not listed, rows without a doc_id are listed under null."""
    docs, row, _ = _with_row(docs.select("doc_id", "text"))
    windows, looked, postings, n_windows = _indexed(docs, benchmark, row, size)
    items = _near_items(_near(docs, row, looked, postings, n_windows, slack), windows)
    named = items if row == "doc_id" else items.join(docs.select(row, "doc_id").distinct(), row)
    return named.select("doc_id", F.col("item").cast(benchmark.schema["item_id"].dataType).alias("item_id")).distinct()


def _near(docs: DataFrame, row: str, looked: DataFrame, postings: DataFrame, n_windows: int, slack: int) -> DataFrame:
    """(row, window_id) with a span of the window's length and ``slack`` more words that holds all its terms."""
    width = F.col("width")
    spots = looked.select("window_id", (F.size("terms") + slack).alias("width"), F.explode(F.array(
        F.struct(F.col("term1").alias("term"), F.lit(1).alias("role")), F.struct(F.col("term2").alias("term"), F.lit(2).alias("role")))).alias("s"))
    spots = spots.select("window_id", "width", "s.*")
    met = postings.repartition(row).join(_small(spots, 2 * n_windows), "term").withColumn("own", F.floor(F.col("place") / width))
    # a span around the second term ends at most one cell from it: the first term is listed in the cells beside its own too
    reach = F.when(F.col("role") == 1, F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)).otherwise(F.array("own"))
    cells = (met.select(row, "window_id", "role", F.explode(reach).alias("cell"))
             .groupBy(row, "window_id", "cell").agg(F.bit_or("role").alias("roles")).filter("roles = 3 AND cell >= 0"))
    cells = written(cells.select(row, "window_id", "cell"), "near-cells")

    rows = cells.select(row).distinct()
    texts = docs.join(_small(rows, rows.count()), row, "left_semi").select(row, words(F.col("text")).alias("w"))
    needed = looked.select("window_id", F.array_distinct("terms").alias("needed"), (F.size("terms") + slack).alias("width"))
    # an empty first or last string of the split holds no term: it can only shorten a span
    begin = F.greatest((F.col("cell") - 1) * width, F.lit(0)).cast("int")
    around = cells.join(_small(needed, n_windows), "window_id").join(texts, row).select(
        row, "window_id", "needed", "width", F.slice("w", begin + 1, 3 * width).alias("around"))
    holds = lambda words_: F.size(F.array_except("needed", words_)) == 0
    spans = F.sequence(F.lit(1), F.greatest(F.size("around") - width + 1, F.lit(1)))
    found = around.filter(holds(F.col("around"))).filter(F.exists(spans, lambda b: holds(F.slice("around", b, width))))
    return found.select(row, "window_id").distinct()


def _near_items(near: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, item), each once; the items of a window are rows of their own."""
    return near.join(windows.select("window_id", F.explode("item_ids").alias("item")), "window_id").drop("window_id").distinct()


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without an occurrence of any window, with their own columns."""
    keyed, row, _ = _with_row(docs)
    leaked = occurrences(keyed, benchmark, row, size).select(F.col(row).alias("leaked_row")).distinct()
    return keyed.join(leaked, keyed[row].eqNullSafe(leaked["leaked_row"]) if row == "doc_id" else keyed[row] == leaked["leaked_row"], "left_anti").select(*docs.columns)


REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM documents),
b AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, w[i : i + least(len(w), 10) - 1] AS terms
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(terms) AS size FROM bw),
dw AS (
  SELECT doc_id, i, size, w[i : i + size - 1] AS terms
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw USING (terms)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
tw AS (
  SELECT row_number() OVER () AS window_id, terms, len(list_distinct(terms)) AS needed, len(terms) + 5 AS width
  FROM (SELECT DISTINCT terms FROM bw)),
wt AS (SELECT window_id, needed, width, unnest(list_distinct(terms)) AS term FROM tw),
seen AS (
  SELECT doc_id, window_id, needed, width, term, p
  FROM (SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS p FROM d) JOIN wt USING (term)),
whole AS (SELECT doc_id, window_id FROM seen GROUP BY doc_id, window_id, needed HAVING count(DISTINCT term) = needed),
spans AS (
  SELECT doc_id, window_id, needed,
    count(DISTINCT term) OVER (PARTITION BY doc_id, window_id ORDER BY p RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING) AS held
  FROM seen SEMI JOIN whole USING (doc_id, window_id)),
near AS (
  SELECT doc_id, count(item) AS n_near, string_agg(item, ',' ORDER BY item) AS near_listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM spans JOIN tw USING (window_id) JOIN bw USING (terms) WHERE held = spans.needed)
  GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items, sha256(coalesce(near_listed, '')) AS near_items_sha256
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""
