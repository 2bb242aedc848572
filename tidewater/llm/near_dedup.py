"""MinHash near-dedup with DartMinHash signatures.

A document is a weighted set of word shingles (five words; a shorter document
is one shingle). Darts are thrown by hashing: the plane weight x rank over every
shingle is cut into unit cells, a cell holds a Poisson number of darts, and a
dart that lies under the shingle's weight and below the document's rank limit counts. Each
dart has a coordinate; the earliest (lowest rank) dart of a coordinate is its
signature value. A document needs about k ln k darts however many shingles it has, and
two documents agree in a coordinate with probability equal to their weighted Jaccard
similarity. With weights "set" (every weight 1) that is the Jaccard similarity of the
shingle sets, with "count" that of the multisets.

Coordinates are joined in bands. Documents with the same weighted set become one
class before banding, so exact copies are never paired. In a bucket everyone is
compared with a pivot, never all with all; compared pairs are verified on
their whole shingle sets. Members that are in another component than their pivot meet a
second pivot, different in every bucket, and in buckets of at most ``SMALL_BUCKET``
representatives the members of different components then meet pairwise. Larger buckets
that still hold several components get an exact join on shingle prefixes
(``prefix_pairs``), so no link between two members of a bucket is lost; what remains is
the chance that a pair shares no bucket. Verified links give components.

Defined results: null and empty texts, and texts of blanks, have no shingle and
are classes of their own, never copies. Rows with a null identifier are left out
of the classes (and always kept). Rows that share an identifier count as one
document. Only the two named columns are read. Empty tables give empty ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, spread, text_list
from .graph import components, stored
from .words import batch_hashes, combine, mix, window_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 56, 8   # a pair at 0.8 shares a bucket with probability 0.99997
SMALL_BUCKET = 64     # up to here all pairs of a bucket meet, above the prefix join finds them
EPS = 1e-6            # lengths are compared with this margin
_U = np.uint64


def _poisson_steps() -> np.ndarray:
    """Upper ends, as 64-bit numbers, of the chances of 0, 1, 2, ... darts in a unit cell."""
    total, chance, ends = 0.0, math.exp(-1), []
    for n in range(24):
        total += chance
        ends.append(min(int(total * 2.0 ** 64), 2 ** 64 - 1))
        chance /= n + 1
    return np.array(ends, np.uint64)


_steps = _poisson_steps()


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0 ** -53


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, count) of every distinct shingle, sorted by document, then hash."""
    h, counts = batch_hashes(texts)
    doc_of = np.repeat(np.arange(len(texts)), counts)
    g = window_hashes(h, size)
    inside = doc_of[:len(g)] == doc_of[size - 1:size - 1 + len(g)]
    doc, sh = doc_of[:len(g)][inside], g[inside]
    starts = np.r_[0, np.cumsum(counts)]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = []
        for d in short:
            x = np.full(1, counts[d], np.uint64)
            for w in h[starts[d]:starts[d + 1]]:
                x = combine(x, np.full(1, w))
            whole.append(x[0])
        doc, sh = np.r_[doc, short], np.r_[sh, np.array(whole, np.uint64)]
    order = np.lexsort((sh, doc))
    doc, sh = doc[order], sh[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (sh[1:] != sh[:-1])]) if len(doc) else np.zeros(0, int)
    return doc[first], sh[first], np.diff(np.r_[first, len(doc)])


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """n_docs x k matrix of the lowest ranks; rows of documents without elements stay infinite."""
    sig = np.full((n_docs, k), np.inf)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    limit = np.where(total > 0, (k * math.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        active = np.zeros(n_docs, bool)
        active[todo] = True
        rows = np.flatnonzero(active[doc])
        cells_w = np.ceil(weight[rows]).astype(np.int64)
        cells_r = np.ceil(limit[doc[rows]]).astype(np.int64)
        ends = np.cumsum(cells_w * cells_r)
        at = 0
        while at < len(rows):  # some 260,000 cells at a time
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 18), side="right")))
            some = rows[at:stop]
            cells = (cells_w * cells_r)[at:stop]
            row = np.repeat(some, cells)
            cell = np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(cells)[:-1]], cells)
            high = np.repeat(cells_r[at:stop], cells)
            cw, cr = cell // high, cell % high
            seed = mix(element[row] ^ mix((cw.astype(_U) << _U(32)) + cr.astype(_U) + _U(1)))
            darts = np.searchsorted(_steps, seed, side="right")
            row, cw, cr, seed = (np.repeat(x, darts) for x in (row, cw, cr, seed))
            n = np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(darts)[:-1]], darts)
            seed = mix(seed + (n.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
            rank = cr + _unit(seed)
            seed = mix(seed)
            # a weight of 1 fills its cell: every dart in it lies under the weight
            hit = (rank < limit[doc[row]]) & (cw + _unit(seed) < weight[row])
            slot = mix(seed[hit] ^ _U(0x5851F42D4C957F2D)) % _U(k)
            np.minimum.at(sig.reshape(-1), doc[row[hit]] * k + slot.astype(np.int64), rank[hit])
            at = stop
        # a coordinate that no dart has hit: throw again, twice as far
        todo = todo[np.isinf(sig[todo]).any(axis=1)]
        sig[todo] = np.inf
        limit[todo] *= 2
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n_docs x bands matrix of bucket keys, different in every band."""
    raw = sig[:, :bands * rows].view(np.uint64).reshape(len(sig), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
    for r in range(rows):
        keys = combine(keys, raw[:, :, r])
    return keys


def _sketcher(bands: int, rows: int, weights: str):
    k = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1), 1 << 19):
                texts = text_list(batch.column(1), lo, hi)
                doc, sh, count = shingles(texts)
                weight = count.astype(np.float64) if weights == "count" else np.ones(len(sh))
                sig = dart_signatures(doc, sh, weight, len(texts), k)
                keys = band_keys(sig, bands, rows).astype(np.int64)
                item = mix(sh ^ mix(weight.astype(np.uint64)))
                prints = [np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)]
                np.add.at(prints[0], doc, item)
                np.add.at(prints[1], doc, mix(item + np.uint64(0x1234567)))
                size = np.bincount(doc, minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(size.astype(np.int32)),
                     *(pa.array(p.view(np.int64)) for p in prints),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)),
                                              pa.array(keys.reshape(-1)))],
                    ["doc_id", "n_shingles", "print1", "print2", "bands"])
    return run


def _shingle_lists(weights: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1), 1 << 20):
                texts = text_list(batch.column(1), lo, hi)
                doc, sh, count = shingles(texts)
                if weights == "count":  # the copies of a shingle become elements of their own
                    copy = np.arange(count.sum()) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
                    doc, sh = np.repeat(doc, count), combine(np.repeat(sh, count), copy.astype(np.uint64))
                ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(texts)))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(sh.view(np.int64)))],
                    ["doc_id", "sh"])
    return run


def _length_bin(n: Column, threshold: float) -> Column:
    """Number of a length's bin; a factor of the threshold spans six bins."""
    return F.floor(F.log(n) / F.lit(max(-math.log(threshold) / 6, 1e-3))).cast("int")


def _length_bins(low: Column, high: Column, threshold: float) -> Column:
    """The bins of all lengths from ``low`` to ``high``; needs ``low`` <= ``high``."""
    return F.sequence(_length_bin(low - F.lit(EPS), threshold), _length_bin(high + F.lit(EPS), threshold))


def _longest(n: Column, left: Column, threshold: float) -> Column:
    """Length above which no partner of a document of ``n`` shingles can be, if at most ``left`` of them are common."""
    return (left + F.lit(EPS)) / F.lit(threshold / (1 + threshold)) - n


def within_reach(rest: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``rest`` (doc_id, label, sh) that a row of another label may reach the threshold with, by their sizes.

    A shingle that only one document has is in no overlap: of a document of n shingles, a of them its
    own, partners have threshold * n to (n - a) / share - n shingles. A document stays if one of another label lies in its range
    and it lies in that one's, both to the width of a length bin. Lengths are summed up by bins before they meet, so
    the table that is joined grows with the bins, not with the documents. Two columns come with the rows: alone, the number
    of shingles that no other document has, and shortest, a length that no partner falls below.
    """
    alone = (rest.select("doc_id", F.explode("sh").alias("token")).groupBy("token")
             .agg(F.count(F.lit(1)).alias("df"), F.min("doc_id").alias("doc_id")).filter("df = 1")
             .groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone")))
    n = F.col("n")
    sized = (rest.select("doc_id", "label", F.size("sh").alias("n")).join(alone, "doc_id", "left")
             .withColumn("alone", F.coalesce("alone", F.lit(0)))
             .withColumn("most", _longest(n, n - F.col("alone"), threshold)).filter(F.col("most") >= F.lit(threshold) * n))
    spans = sized.select("doc_id", "label", "n", "most", "alone", _length_bin(n, threshold).alias("own"),
                         F.explode(_length_bins(F.lit(threshold) * n, F.col("most"), threshold)).alias("other"))
    offers = spans.groupBy(F.col("own").alias("other"), F.col("other").alias("own")).agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("n").alias("shortest"))
    found = spans.join(F.broadcast(offers), ["own", "other"]).filter(
        ((F.col("label") != F.col("lo")) | (F.col("label") != F.col("hi"))) & (F.col("shortest") <= F.col("most"))
    ).groupBy("doc_id", "alone").agg(F.min("shortest").alias("shortest"))
    return rest.select("doc_id", "label", "sh").join(found, "doc_id")


def prefix_pairs(rest: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a > b: every pair of ``rest`` (doc_id, label, sh) of different labels that can reach the threshold.

    Exact: shingles are put in one order for all documents, those that only one label
    has first, then rare before frequent. A pair's overlap is at most what either
    document holds from their first common shingle on, so the pair meets at a shingle whose
    position leaves both enough. For the shorter of two that is the first ninth of its shingles,
    for the longer one the first fifth (at 0.8), and less where no partner is that short. Such a position also bounds the
    other's length: rows meet by shingle and by both lengths' bins, each only in the bins that it can reach. In a shingle's
    rows the label with most of them does not meet itself, so rows met grow with the pairs of different labels.
    The label with most documents never meets itself either: each of its pairs is found from the other document's first
    shingles, so of its own shingles only those are looked up, and the ones that are not count as if they came later.
    Documents out of reach of all others (``within_reach``) are left out before the shingles are ordered.
    """
    rest = stored(within_reach(rest, threshold), "near-reach")
    flat = rest.select("doc_id", "label", F.size("sh").alias("n"), "alone", "shortest", F.explode("sh").alias("token"))
    common = flat.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi")
                                       ).filter("lo < hi").select("token", "df")
    largest = rest.groupBy("label").count().orderBy(F.desc("count"), "label").select("label").first()
    in_largest = F.col("label") == F.lit(largest["label"] if largest else None)
    own = Window.partitionBy("doc_id")
    place = F.row_number().over(own.orderBy("df", "token"))
    n, most = F.col("n"), F.col("most")

    def first_ones(placed: DataFrame, name: str) -> DataFrame:  # left: shingles from this one on
        return stored(placed.withColumn("most", _longest(n, F.col("left"), threshold))
                      .filter(most >= F.greatest(F.lit(threshold) * n, "shortest"))
                      .select("token", "doc_id", "label", "n", "most", "df"), name)

    others = first_ones(flat.filter(~in_largest).join(spread(common, "token"), "token")
                        .withColumn("left", F.count(F.lit(1)).over(own) + 1 - place), "near-heads")
    asked = others.groupBy("token").agg(F.min("df").alias("df"))
    heads = others.union(first_ones(flat.filter(in_largest).join(spread(asked, "token"), "token")
                                    .withColumn("left", n - F.col("alone") + 1 - place), "near-heads-largest")).drop("df")
    top = (heads.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c"))
           .groupBy("token").agg(F.max(F.struct("c", "label")).alias("t"), F.count(F.lit(1)).alias("labels"))
           .filter("labels > 1").select("token", F.col("t.label").alias("top")))
    rows = heads.join(spread(top, "token"), "token").withColumn("bin", _length_bin(n, threshold))
    long_ = rows.select("token", *(F.col(c).alias(f"{c}_x") for c in ("doc_id", "label", "n", "most", "top", "bin")), F.explode(
        _length_bins(F.lit(threshold) * n, F.least("n", "most"), threshold)).alias("bin"))
    short = rows.filter(most >= n).withColumn("bin_x", F.explode(_length_bins(n, most, threshold)))
    meet = ((F.col("label") != F.col("label_x")) & (F.col("n_x") <= most) & (n <= F.col("most_x")) &
            ((n < F.col("n_x")) | ((n == F.col("n_x")) & (F.col("doc_id") < F.col("doc_id_x")))))
    by = ["token", "bin", "bin_x"]
    met = (short.filter("label <> top").join(long_, by).filter(meet).select("doc_id", "doc_id_x").union(
        short.filter("label = top").join(long_.filter("label_x <> top_x"), by).filter(meet).select("doc_id", "doc_id_x")))
    return met.select(F.greatest("doc_id", "doc_id_x").alias("a"), F.least("doc_id", "doc_id_x").alias("b")).distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 bands: int = BANDS, rows: int = ROWS, weights: str = "set") -> DataFrame:
    """One row per row of ``docs`` with an identifier: it, class_id (smallest identifier), n_links.

    ``n_links`` counts the verified links of the row's distinct set of shingles to other sets.
    """
    if weights not in ("set", "count"):
        raise ValueError("weights: set or count")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
                        ).filter("doc_id is not null")
    kind = texts.schema["doc_id"].dataType.simpleString()
    sketch = stored(texts.mapInArrow(_sketcher(bands, rows, weights),
                                     f"doc_id {kind}, n_shingles int, print1 long, print2 long, bands array<long>"),
                    "near-sketch")
    full = sketch.filter("n_shingles > 0")
    # one representative of each distinct set
    sets = full.groupBy("print1", "print2").agg(F.min("doc_id").alias("rep"))
    member = stored(full.select("doc_id", "n_shingles", "print1", "print2").join(spread(sets, "print1"), ["print1", "print2"])
                    .select("doc_id", "rep", "n_shingles"), "near-member")
    reps = member.filter("doc_id = rep").select("rep").distinct()
    keys = full.join(reps, full.doc_id == reps.rep, "left_semi").select(
        "doc_id", "n_shingles", F.explode("bands").alias("key")).dropDuplicates(["doc_id", "key"])
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("pivot")).filter("size > 1")
    bucket = stored(keys.join(spread(shared, "key"), "key"), "near-buckets")          # doc_id, n_shingles, key, size, pivot
    in_bucket = bucket.select("doc_id").distinct()
    lists = stored(texts.join(in_bucket, "doc_id", "left_semi").mapInArrow(
        _shingle_lists(weights), f"doc_id {kind}, sh array<long>").dropDuplicates(["doc_id"]), "near-shingles")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) whose similarity reaches the threshold."""
        left = lists.select(F.col("doc_id").alias("a"), F.col("sh").alias("sa"))
        right = lists.select(F.col("doc_id").alias("b"), F.col("sh").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        near = both >= F.lit(threshold) * (F.size("sa") + F.size("sb") - both) - F.lit(1e-9)
        return stored(pairs.distinct().join(left, "a").join(right, "b").filter(near).select("a", "b"), name)

    def could(x: str, y: str):
        return F.least(x, y) >= F.lit(threshold) * F.greatest(x, y) - F.lit(1e-9)

    sizes = lists.select(F.col("doc_id").alias("b"), F.size("sh").alias("nb"))
    to_pivot = bucket.filter("doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"),
                                                        F.col("n_shingles").alias("na")).distinct()
    links = verified(to_pivot.join(sizes, "b").filter(could("na", "nb")).select("a", "b"), "near-links-1")
    for turn in (2, 3):
        labels = components(links, f"near-components-{turn}")
        placed = bucket.join(labels, bucket.doc_id == labels.node, "left").select(
            "key", "size", "pivot", "n_shingles", "doc_id", F.coalesce("label", "doc_id").alias("label"))
        mixed = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                          F.min(F.struct(F.xxhash64("doc_id", "key"), "doc_id", "label", "n_shingles")
                                                ).alias("p")).filter("lo < hi")
        mixed = spread(mixed, "key")
        if turn == 2:  # another pivot, by hash, for whoever is in another component
            pairs = (placed.join(mixed, "key").filter((F.col("label") != F.col("p.label")) &
                                                      could("n_shingles", "p.n_shingles"))
                     .select(F.greatest("doc_id", "p.doc_id").alias("a"), F.least("doc_id", "p.doc_id").alias("b")))
        else:          # small buckets: members of different components
            open_ = placed.join(mixed.select("key"), "key", "left_semi").filter(F.col("size") <= SMALL_BUCKET)
            one = open_.select("key", F.col("doc_id").alias("a"), F.col("label").alias("la"), F.col("n_shingles").alias("na"))
            two = open_.select("key", F.col("doc_id").alias("b"), F.col("label").alias("lb"), F.col("n_shingles").alias("nb"))
            pairs = one.join(two, "key").filter((F.col("a") > F.col("b")) & (F.col("la") != F.col("lb")) &
                                                could("na", "nb")).select("a", "b")
        links = links.union(verified(pairs, f"near-links-{turn}")).distinct()
    labels = components(links, "near-components")
    # large buckets that still hold several components: the exact rest
    large = bucket.filter(F.col("size") > SMALL_BUCKET).select("key", "doc_id").join(
        labels, F.col("doc_id") == F.col("node"), "left").select("key", "doc_id", F.coalesce("label", "doc_id").alias("label"))
    split = large.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    open_ = stored(large.join(spread(split, "key"), "key", "left_semi").select("doc_id", "label").distinct(), "near-open")
    if not open_.isEmpty():
        links = links.union(verified(prefix_pairs(lists.join(open_, "doc_id"), threshold), "near-links-4")).distinct()
        labels = components(links, "near-components-5")
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(
        F.count(F.lit(1)).alias("n"))
    classes = stored(labels.join(degree, "node"), "near-classes")
    placed = member.join(classes, member.rep == classes.node, "left").select(
        "doc_id", F.coalesce("label", "rep").alias("class_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"))
    bare = sketch.filter("n_shingles = 0").select("doc_id", F.col("doc_id").alias("class_id"),
                                                  F.lit(0).cast("long").alias("n_links"))
    return placed.union(bare).withColumnRenamed("doc_id", id_col)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns unchanged: one document of each class."""
    gone = near_classes(docs, id_col, text_col, **options).filter(F.col(id_col) != F.col("class_id"))
    return docs.join(gone.select(F.col(id_col).alias("_gone")).distinct(), F.col(id_col) == F.col("_gone"), "left_anti")
