"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Every word that a
window covers whose words also start in a document with a smaller identifier
goes; windows are judged on the input.

1. Anchors. Of the ``PHRASE``-word phrases in a window the one with the smallest hash
   is its anchor, so equal windows have equal anchors, and a document has few of them.
   The stretch of consecutive windows that share an anchor is hashed as a whole.
2. Confirmed passages. Anchors that occur in two documents are kept; for each
   stretch the smallest document that has it is known. The stretches whose anchor has
   several different stretches are taken apart: their windows are hashed, once per
   distinct stretch, and the smallest document of each window follows.
3. Automata. Documents are dealt into blocks of bounded size. Each block
   compiles, with pyahocorasick, an automaton over the words of the confirmed phrases
   that occur in it, and streams its documents through it: every occurrence of a phrase is
   located, and the windows around it are looked up among the confirmed stretches and
   windows, which decides the words that go.

No step holds a group whole: stretches and windows are aggregated before
they are shuffled, and what a block gets is bounded by its own text.

Defined results: a null text has no words. Null identifiers count as larger than
all others and are not copies of each other. Rows that share an identifier are one
document in the sense that none of them is removed because of another. Extra
columns do not matter; an empty table gives an empty one. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, spread, text_list
from .graph import stored
from .words import batch_hashes, combine, mix, window_hashes

WINDOW = 50
PHRASE = 12
BLOCK_TEXT = 8 << 20  # bytes of text a block has on average
SLICE = 1 << 20       # bytes of text that numpy works on at a time
LAST = 2 ** 63 - 1    # stands for a null identifier


def stretches(h: np.ndarray, counts: np.ndarray, window: int = WINDOW, phrase: int = PHRASE) -> tuple[np.ndarray, ...]:
    """Anchors of the documents whose word hashes lie end to end in ``h``, ``counts`` words each.

    (document, phrase start, phrase hash, stretch hash, first window, last window), places in ``h``:
    the windows that start at first..last have their smallest phrase hash at that start, the
    leftmost one if equal. Also the hashes of all windows.
    """
    n = len(h) - window + 1
    if n <= 0:
        e = np.zeros(0, np.int64)
        u = np.zeros(0, np.uint64)
        return e, e, u, u, e, e, u
    g = window_hashes(h, phrase)
    span = window - phrase + 1
    # sliding minimum with its place by doubling; of equal ones the left. Windows that lie in
    # one document see that document's phrases only; the others are left out below.
    value, place, width = g, np.arange(len(g), dtype=np.int32), 1
    while width * 2 <= span:
        right = value[width:] < value[:-width]
        place = np.where(right, place[width:], place[:-width])
        value = np.where(right, value[width:], value[:-width])
        width *= 2
    at = span - width
    place = np.where(value[at:at + n] < value[:n], place[at:at + n], place[:n])
    doc = np.repeat(np.arange(len(counts)), counts)
    inside = np.flatnonzero(doc[:n] == doc[window - 1:])
    own = place[inside]
    new = np.r_[True, (own[1:] != own[:-1]) | (inside[1:] != inside[:-1] + 1)][:len(inside)]
    heads = np.flatnonzero(new)
    first = inside[heads]
    last = inside[np.r_[heads[1:], len(inside)][:len(heads)] - 1]
    start = own[heads].astype(np.int64)
    w = window_hashes(h, window)
    # the words of a stretch lie in its first and its last window, which overlap or touch
    stretch = combine(w[first], w[last])
    stretch = combine(stretch, mix(((last - first).astype(np.uint64) << np.uint64(32)) + (start - first).astype(np.uint64)))
    return doc[first], start, g[start], stretch, first, last, w


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(2), SLICE):
            h, counts = batch_hashes(text_list(batch.column(2), lo, hi))
            doc, _, key, stretch, _, _, _ = stretches(h, counts)
            if len(doc):
                doc = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(doc), batch.column(1).take(doc), pa.array(key.view(np.int64)),
                     pa.array(stretch.view(np.int64))], ["doc", "block", "anchor", "stretch"])


def _pieces(docs: pa.Table) -> Iterator[tuple[list, list[list[bytes]], np.ndarray, np.ndarray]]:
    """(identifiers, words of each document, word hashes end to end, word counts), some documents at a time."""
    docs = docs.combine_chunks()
    for chunk in docs.to_batches():
        texts = chunk.column("text")
        for lo, hi in slices(texts, SLICE):
            some = text_list(texts, lo, hi)
            h, counts = batch_hashes(some)
            yield chunk.column("doc").slice(lo, hi - lo).to_pylist(), [t.encode().split() for t in some], h, counts


def _pair(anchor: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    return combine(anchor.view(np.uint64), stretch.view(np.uint64))


class _Table:
    """Sorted 64-bit keys with a value each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def get(self, keys: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The value of each key; ``missing`` where there is none."""
        if not len(self.keys):
            return missing
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)


def _column(table: pa.Table, name: str, fill=0) -> np.ndarray:
    return pc.fill_null(table.column(name), fill).to_numpy()


def _expand(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """For a block's documents and the (doc, anchor, stretch, phrase, windows) asked of it:
    rows (block, anchor, phrase, window, doc): the phrase's words once, and the hashes of the windows."""
    asked_doc = _column(wanted, "doc", LAST)
    key = combine(_pair(_column(wanted, "anchor"), _column(wanted, "stretch")), asked_doc.view(np.uint64))
    # 1: the phrase is asked for, 2: the windows are
    what = _column(wanted, "phrase", False).astype(np.int64) + 2 * _column(wanted, "windows", False)
    asked = _Table(key, what)
    block = docs.column("block")[0] if len(docs) else None
    out = []

    def add(anchor, phrase, window, doc):
        n = len(anchor)
        out.append(pa.table({"block": pa.repeat(block, n), "anchor": pa.array(anchor.view(np.int64), pa.int64()),
                             "phrase": pa.array(phrase, pa.string()) if phrase is not None else pa.nulls(n, pa.string()),
                             "window": pa.array(window.view(np.int64)) if window is not None else pa.nulls(n, pa.int64()),
                             "doc": pa.array(doc, pa.int64())}))

    for ids, words, h, counts in _pieces(docs):
        me = np.array([LAST if i is None else i for i in ids], np.int64)
        doc, start, anchor, stretch, first, last, w = stretches(h, counts)
        flags = asked.get(combine(_pair(anchor, stretch), me[doc].view(np.uint64)), np.zeros(len(doc), np.int64))
        base = np.r_[0, np.cumsum(counts)]
        some = np.flatnonzero(flags & 1)
        if len(some):
            at = (start - base[doc])[some].tolist()
            phrases = [b" ".join(words[d][k:k + PHRASE]).decode() for d, k in zip(doc[some].tolist(), at, strict=True)]
            add(anchor[some], phrases, None, me[doc[some]])
        some = np.flatnonzero(flags & 2)
        if len(some):
            n = (last - first + 1)[some]
            place = np.repeat(first[some] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            add(np.repeat(anchor[some], n), None, w[place], np.repeat(me[doc[some]], n))
    kinds = {"block": pa.int32(), "anchor": pa.int64(), "phrase": pa.string(), "window": pa.int64(), "doc": pa.int64()}
    return pa.concat_tables(out) if out else pa.table({k: pa.array([], t) for k, t in kinds.items()})


def _automaton(anchors: list[int], phrases: list[str]) -> tuple[ahocorasick.Automaton | None, dict[bytes, int]]:
    """Automaton over word numbers that yields the anchor of each phrase, and the word numbers."""
    if not phrases:
        return None, {}
    number: dict[bytes, int] = {}
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for anchor, phrase in zip(anchors, phrases, strict=True):
        machine.add_word(tuple([number.setdefault(w, len(number) + 1) for w in phrase.encode().split()]), anchor)
    machine.make_automaton()
    return machine, number


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _locate(docs: pa.Table, known: pa.Table) -> pa.Table:
    """Stream a block's documents through its automaton; rows (doc, n_words, n_removed, removed, kept)."""
    has = [known.filter(pc.is_valid(known.column(c))) for c in ("phrase", "stretch", "window")]
    machine, number = _automaton(has[0].column("anchor").to_pylist(), has[0].column("phrase").to_pylist())
    whole = _Table(_pair(_column(has[1], "anchor"), _column(has[1], "stretch")), _column(has[1], "doc"))
    single = _Table(_column(has[2], "window").view(np.uint64), _column(has[2], "doc"))
    out: list[tuple] = []
    for ids, words, h, counts in _pieces(docs):
        gone = np.zeros(len(h) + 1, np.int64)
        if machine is not None:
            # one stream of words; a phrase across two documents is no document's anchor
            stream = tuple([number.get(w, 0) for ws in words for w in ws])
            found = np.fromiter((x for hit in machine.iter(stream) for x in hit), np.int64).reshape(-1, 2)
            located = _Table((found[:, 0] - PHRASE + 1).view(np.uint64), found[:, 1])
            doc, start, anchor, stretch, first, last, w = stretches(h, counts)
            key = anchor.view(np.int64)
            hit = np.flatnonzero(located.get(start.view(np.uint64), ~key) == key)
            me = np.array([LAST if i is None else i for i in ids], np.int64)[doc]
            all_of = whole.get(_pair(anchor[hit], stretch[hit]), me[hit]) < me[hit]
            np.add.at(gone, first[hit[all_of]], 1)
            np.add.at(gone, last[hit[all_of]] + WINDOW, -1)
            rest = hit[~all_of]
            n = (last - first + 1)[rest]
            place = np.repeat(first[rest] - np.r_[0, np.cumsum(n)[:-1]][:len(n)], n) + np.arange(n.sum())
            mine = np.repeat(me[rest], n)
            place = place[single.get(w[place], mine) < mine]
            np.add.at(gone, place, 1)
            np.add.at(gone, place + WINDOW, -1)
        drop = np.cumsum(gone[:-1]) > 0
        base = np.r_[0, np.cumsum(counts)]
        removed = np.diff(np.r_[0, np.cumsum(drop)][base])
        for k, ws in enumerate(words):
            spans, kept = [], ws
            if removed[k]:
                own = drop[base[k]:base[k + 1]]
                edges = np.flatnonzero(np.diff(np.r_[False, own, False].view(np.int8))).tolist()
                spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kept = list(compress(ws, (~own).tolist()))
            out.append((ids[k], len(ws), int(removed[k]), spans, b" ".join(kept).decode()))
    columns = list(zip(*out, strict=True)) if out else [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), _SPANS, pa.string()]
    return pa.table({c: pa.array(x, k) for c, x, k in zip(
        ("doc", "n_words", "n_removed", "removed", "kept"), columns, kinds, strict=True)})


OUT = "doc long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string"


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the identifier, n_words, n_removed, the word ranges removed, the kept text."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, size // BLOCK_TEXT + 1)
    texts = texts.withColumn("block", F.pmod(F.xxhash64("doc", F.substring("text", 1, 64)), F.lit(blocks)).cast("int"))
    texts = texts.select("doc", "block", "text")
    me = F.coalesce("doc", F.lit(LAST))
    seen = stored(texts.mapInArrow(_anchors, "doc long, block int, anchor long, stretch long"), "repeat-anchors")
    # anchors that occur in two documents, and whether all their stretches are alike
    shared = seen.groupBy("anchor").agg(
        F.min(me).alias("lo"), F.max(me).alias("hi"), F.min("stretch").alias("s1"), F.max("stretch").alias("s2")
    ).filter("lo < hi").select("anchor", (F.col("s1") != F.col("s2")).alias("mixed"))
    here = stored(seen.join(spread(shared, "anchor"), "anchor"), "repeat-shared")
    # (anchor, stretch): the smallest document that has it, asked for its windows if the anchor is mixed;
    # of each anchor one stretch is asked for the words of the phrase
    whole = here.groupBy("anchor", "stretch").agg(F.min(F.struct(me.alias("doc"), "block")).alias("m"),
                                                  F.count(F.lit(1)).alias("n"), F.any_value("mixed").alias("mixed"))
    whole = stored(whole.select("anchor", "stretch", "m.doc", "m.block", "n", "mixed"), "repeat-stretches")
    first = whole.groupBy("anchor").agg(F.min(F.struct("doc", "stretch")).alias("f")).select(
        "anchor", F.col("f.stretch").alias("fs"))
    wanted = whole.join(spread(first, "anchor"), "anchor").select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc"), "block", "anchor", "stretch",
        (F.col("stretch") == F.col("fs")).alias("phrase"), F.col("mixed").alias("windows")).filter("phrase or windows")

    def by_block(fn, with_texts: DataFrame, rows: DataFrame, schema: str) -> DataFrame:
        return with_texts.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(fn, schema)

    passages = stored(by_block(_expand, texts, wanted, "block int, anchor long, phrase string, window long, doc long"),
                      "repeat-passages")
    phrases = passages.filter("phrase is not null").groupBy("anchor").agg(F.min("phrase").alias("phrase"))
    # windows of a distinct stretch that start in a smaller document too
    parts = passages.filter("window is not null").select("block", "window", me.alias("doc")).distinct()
    least = spread(parts.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("hi"))
                   .filter("least < hi"), "window")
    windows = parts.join(least, "window").filter("least < doc").select("block", "window", "least").distinct()
    # what each block has to know: only of anchors that occur in it
    at = here.select("anchor", "block").distinct()
    null = lambda kind: F.lit(None).cast(kind)
    facts = (at.join(spread(phrases, "anchor"), "anchor").select("block", "anchor", "phrase", null("long").alias("stretch"),
                                               null("long").alias("window"), null("long").alias("doc"))
             .union(here.select("anchor", "block", "stretch").distinct().join(
                 whole.filter("n > 1").select("anchor", "stretch", "doc"), ["anchor", "stretch"]).select(
                     "block", "anchor", null("string"), "stretch", null("long"), "doc"))
             .union(windows.select("block", null("long"), null("string"), null("long"), "window", "least")))
    return by_block(_locate, texts, facts, OUT).withColumnRenamed("doc", id_col)


def repeat_digest(docs: DataFrame) -> DataFrame:
    return drop_repeats(docs).select("doc_id", "n_words", "n_removed",
                                     F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
