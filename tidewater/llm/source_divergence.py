"""Source divergence audit by count cells.

For every language the audit asks how far the words of each source stray from
those of another source (part ``pair``) and from those of the whole language, term
by term (part ``term``). The measure of a term is f = floor((p - q)^2 / q) with the smoothed
shares p, q = 1 + floor(SCALE * (count + 1) / (N + V)), all in whole numbers.

Terms with the same counts have the same f, so f is evaluated per *count cell*, not per term:

* ``term``: terms are grouped by (count in the source, count in the language). Cells are
  ranked by value with the cumulative number of their terms, cells of equal value are merged, and only
  the cells that reach into the first ``top`` ranks are expanded into terms, in UTF-8 order;
* ``pair``: terms are grouped by their whole vector of counts per source first. Each distinct
  vector adds its number of terms to the cells (count in one source, count in the other) of the
  source pairs in it. Cells with a zero are never met as terms: they follow from each source's own
  histogram and V by inclusion and exclusion.

Counting: each task counts words batch by batch with a bounded table and hands on (language, source, term,
occurrences, documents); one shuffle on (language, term) adds these up and finds the terms
that are in at least ``min_docs`` documents. A source or language with a third of all rows, or a word in
every document, comes down to one row per task and table there. Later steps work on the vocabulary.
The ``pair`` part has a row for each ordered pair of a language's sources, as it is asked for; the ranks of
one source are worked out over its partners and over at most ``top`` values.

Defined results: a null text, language or source counts as ''; a document is a row, so repeated
rows count each; a group without terms is reported like any other; V = 0 gives value 0 for pairs and no term. Only the three
named columns are read. Ties go by the item's UTF-8 bytes. An empty table gives an empty
result. There is no limit on a text's length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
# Entries of a task's count table before it is handed on; bounds memory only.
TABLE_ENTRIES = 400_000
# Bytes of one text that are split into words at a time; bounds memory only.
SPLIT_BYTES = 4 << 20

# Bytes that are no part of a term become blanks, A-Z become a-z; bytes of other characters stay.
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of one text, in lists of bounded size."""
    folded = text.translate(_FOLD)
    at = 0
    while len(folded) - at > SPLIT_BYTES:
        end = folded.find(b" ", at + SPLIT_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end
    yield (folded[at:] if at else folded).split()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Partial counts (lang, source, term, n, docs); add them up by (lang, source, term)."""
    rows = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (found, within) in tables.items():
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.binary()).cast(pa.string()), pa.array([source] * n, pa.binary()).cast(pa.string()),
                     pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64()),
                     pa.array([within[w] for w in found], pa.int64())], ["lang", "source", "term", "n", "docs"])
            tables.clear()

        held = 0
        for batch in batches:
            langs, sources, texts = (c.cast(pa.binary()).to_pylist() for c in batch.columns)
            for lang, source, text in zip(langs, sources, texts, strict=True):
                pair = tables.get((lang, source))
                if pair is None:
                    pair = tables[lang, source] = (Counter(), Counter())
                found, within = pair
                held -= len(found)
                parts = list(_words(text)) if len(text) <= SPLIT_BYTES else _words(text)
                distinct: set[bytes] = set()
                for words in parts:
                    found.update(words)
                    distinct.update(words)
                within.update(distinct)
                held += len(found)
                if held > TABLE_ENTRIES:
                    yield from flush()
                    held = 0
        yield from flush()

    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kinds)), exact; null where there is no term."""
    wide = "decimal(20,0)"
    whole = (total + kinds).cast(wide)
    up = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast(wide)
    return F.when(kinds > 0, F.call_function("div", up, whole) + 1)


def divergence_of(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _vocabulary(docs: DataFrame, lang_col: str, source_col: str, text_col: str, min_docs: int) -> DataFrame:
    """(lang, term, source, g, l, head) of the kept terms; head marks one row per (lang, term)."""
    counted = (term_counts(docs, lang_col, source_col, text_col)
               .repartition("lang", "term")  # both the sums and the window below keep to it
               .groupBy("lang", "term", "source").agg(F.sum("n").alias("g"), F.sum("docs").alias("docs")))
    w = Window.partitionBy("lang", "term")
    return (counted.select("lang", "term", "source", "g", F.sum("g").over(w).alias("l"), F.sum("docs").over(w).alias("in_docs"),
                           (F.min("source").over(w) == F.col("source")).alias("head"))
            .filter(F.col("in_docs") >= min_docs).drop("in_docs"))


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) as described above."""
    terms = stored(_vocabulary(docs, lang_col, source_col, text_col, min_docs), "divergence-terms")
    occurring = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a)
                              for c, a in ((lang_col, "lang"), (source_col, "source")))).distinct()
    cells = stored(terms.groupBy("lang", "source", "g", "l").agg(F.count(F.lit(1)).alias("m"), F.count_if("head").alias("heads")),
                   "divergence-cells")
    # per group: N and number of terms; per language: N and V
    per_group = cells.groupBy("lang", "source").agg(F.sum(F.col("g") * F.col("m")).alias("n"), F.sum("m").alias("terms"),
                                                    F.sum("heads").alias("heads"))
    per_lang = per_group.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("heads").alias("v"))
    zero = F.lit(0).cast("long")
    stats = stored(occurring.join(per_group.drop("heads"), ["lang", "source"], "left").join(per_lang, "lang", "left")
                   .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("n", "terms", "lang_n", "v"))),
                   "divergence-groups")
    return _terms_part(terms, cells, stats, top).unionByName(_pairs_part(terms, cells, stats))


def _terms_part(terms: DataFrame, cells: DataFrame, stats: DataFrame, top: int) -> DataFrame:
    p = share(F.col("g"), F.col("n"), F.col("v"))
    q = share(F.col("l"), F.col("lang_n"), F.col("v"))
    valued = (cells.join(stats, ["lang", "source"])
              .select("lang", "source", "g", "l", "m", p.alias("p"), q.alias("q")).filter("p > q")
              .withColumn("value", divergence_of(F.col("p"), F.col("q"))).drop("p", "q"))
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # each value holds a term at least, so the first `top` values are enough to look at
    first = merged.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top)
    reached = (first.withColumn("before", F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)))
               .select("lang", "source", "value", F.coalesce("before", F.lit(0)).alias("before")).filter(F.col("before") < top))
    chosen = valued.join(reached, ["lang", "source", "value"]).select("lang", "source", "g", "l", "value", "before")
    within = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (terms.join(chosen, ["lang", "source", "g", "l"])
            .withColumn("place", F.row_number().over(within)).filter(F.col("place") <= top)
            .withColumn("rank", (F.col("before") + F.col("place")).cast("int")).filter(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def _pairs_part(terms: DataFrame, cells: DataFrame, stats: DataFrame) -> DataFrame:
    a = stats.select("lang", "source", "n", "terms", "v")
    b = stats.select("lang", F.col("source").alias("item"), F.col("n").alias("item_n"), F.col("terms").alias("item_terms"))
    # the rows of the result: each other source of the language
    pairs = stored(a.join(b, "lang").filter("source <> item"), "divergence-pairs")
    own = cells.groupBy("lang", "source", "g").agg(F.sum("m").alias("m"))
    none = F.lit(0).cast("long")
    # terms with the same counts in the same sources, once with their number
    vectors = (terms.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "g"))).alias("vector"))
               .groupBy("lang", "vector").agg(F.count(F.lit(1)).alias("m")).filter(F.size("vector") > 1))
    met = (vectors.select("lang", "vector", "m", F.posexplode("vector").alias("i", "one"))
           .select("lang", "m", "one", F.explode(F.expr("slice(vector, i + 2, size(vector))")).alias("two"))
           .groupBy("lang", F.col("one.source").alias("source"), F.col("two.source").alias("item"),
                    F.col("one.g").alias("x"), F.col("two.g").alias("y")).agg(F.sum("m").alias("m")))
    both = met.unionByName(met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                                      F.col("y").alias("x"), F.col("x").alias("y"), "m"))
    cell = lambda x, y, m: F.struct(x.alias("x"), y.alias("y"), m.alias("m"))
    x, y, m = F.col("x"), F.col("y"), F.col("m")
    corrected = both.select("lang", "source", "item", F.inline(F.array(
        cell(x, y, m), cell(x, none, -m), cell(none, y, -m), cell(none, none, m))))
    one = own.join(pairs, ["lang", "source"]).select("lang", "source", "item", F.col("g").alias("x"), none.alias("y"), "m")
    other = (own.withColumnRenamed("source", "item").join(pairs, ["lang", "item"])
             .select("lang", "source", "item", none.alias("x"), F.col("g").alias("y"), "m"))
    rest = pairs.select("lang", "source", "item", none.alias("x"), none.alias("y"),
                        (F.col("v") - F.col("terms") - F.col("item_terms")).alias("m"))
    filled = (corrected.unionByName(one).unionByName(other).unionByName(rest)
              .groupBy("lang", "source", "item", "x", "y").agg(F.sum("m").alias("m")).filter("m <> 0"))
    p = share(F.col("x"), F.col("n"), F.col("v"))
    q = share(F.col("y"), F.col("item_n"), F.col("v"))
    value = (filled.join(pairs, ["lang", "source", "item"])
             .select("lang", "source", "item", "m", p.alias("p"), q.alias("q"))
             .groupBy("lang", "source", "item")
             .agg(F.sum(F.col("m").cast("decimal(18,0)") * divergence_of(F.col("p"), F.col("q")).cast("decimal(20,0)")).alias("value")))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pairs.select("lang", "source", "item").join(value, ["lang", "source", "item"], "left")
            .withColumn("value", F.coalesce(F.col("value").cast("long"), F.lit(0).cast("long")))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(w).alias("rank")))
