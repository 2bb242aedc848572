"""Packing by length patterns: non-negative least squares on the histogram of lengths.

Documents are tokenised and closed with an end id; only those longer than a sequence are cut, into whole
sequences and a rest. How the pieces share sequences is decided on their lengths alone:

* the histogram of piece lengths has at most ``max_len`` counts, however many documents there are;
* patterns of two to four lengths that fill a sequence exactly are enumerated by their sums (for each sum
  the pair of lengths that is missing most); patterns that would lower the remaining error enter the
  fit, those that fall to zero leave it, and their repeat counts are the non-negative least squares fit to the
  histogram (accelerated projected gradient on the patterns in play);
* the repeat counts are rounded, never above what the histogram holds;
* the residual is packed best fit, longest first, whole groups of equal lengths at a time, into new
  sequences and any room that is open. The shortest pieces (``FILLER_SHARE`` of all ids) are kept out of the
  patterns for it, as they are what fills the gaps.

The plan is a list of (pattern, repeats) of a size that does not grow with the data. Each piece gets its ordinal among the pieces
of its length: its place within its task plus the counts of the tasks before it (a sum over tasks and lengths,
no task ever sees all pieces of a length), and the plan says in which sequence and where that ordinal
lies. So a length that a third of all pieces share is dealt with like any other.

The pieces are written once to the shared scratch folder, with their places: a lost task is run again as a
whole before anything reads them, and nothing is numbered twice.

Defined results: a null text counts as empty, and an empty text is the end id alone. Repeated rows and equal
identifiers are packed like any others. Only the two named columns are read. An empty table gives an empty
one. There is no limit on a text's length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_by_worker, slices, struct_udf, text_list
from .graph import stored

MAX_LEN = 2048
END_ID = 0
# Share of the ids, shortest pieces first, that only fill gaps.
FILLER_SHARE = 1 / 8
# The fit: rounds of new patterns, patterns a round, gradient steps a round, and the gain below which a pattern stays out.
ROUNDS, PATTERNS_A_ROUND, STEPS, LEAST_GAIN = 40, 600, 60, 1e-3
# Words whose ids a worker remembers, and the longest word that is; they bound memory only.
CACHE_WORDS, CACHE_WORD_CHARS = 1_000_000, 64
# New parts that are encoded as one text.
PARTS_A_TEXT = 500
# Text that one step tokenises; bounds memory only.
STEP_BYTES = 1 << 20

# Texts where Python's and the tokeniser's blanks differ, or with its special tokens, are encoded in one go.
_odd = re.compile(r"[\x1c-\x1f]|<\|(?:start|end)oftext\|>")
_SPECIAL = "oftext|>"
# Characters that a text in Latin letters does not have (those of other scripts, and numerals that are no digits).
_other = re.compile("[^\t-\r -~\x85\xa0-±´-¸º»¿-ɏ‐-⁞]")
# The tokeniser's parts of such a text, lower-cased.
_part = re.compile(r"[a-zªµºß-öø-ɏ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zªµºß-öø-ɏ0-9]+")


# ---------------------------------------------------------------- tokens

class WordEncoder:
    """Ids (little-endian uint32) by a tokeniser that drops white space and case, and splits at it.

    A text in Latin letters is cut into the tokeniser's own parts (runs of letters, single digits, runs of
    marks, shortened forms), other texts into words; either are encoded by themselves once and remembered. New
    parts go through the tokeniser many at a time and are told apart by the id that closes each.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        out = []
        groups = [parts[k:k + PARTS_A_TEXT] for k in range(0, len(parts), PARTS_A_TEXT)]
        for group, raw in zip(groups, self._encode([" ".join(g) for g in groups]), strict=True):
            at = (4 * (np.flatnonzero(self.closes[np.frombuffer(raw, "<u4")]) + 1)).tolist()
            whole = len(at) == len(group) and at[-1] == len(raw)
            out += [raw[i:j] for i, j in zip([0, *at], at, strict=False)] if whole else self._encode(group)
        return out

    @staticmethod
    def _look_up(known: dict[str, bytes], encode, pieces: list[str]) -> list[bytes]:
        if len(known) > CACHE_WORDS:
            known.clear()
        ids = list(map(known.get, pieces))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            names = list({pieces[i] for i in missing})
            new = dict(zip(names, encode(names), strict=True))
            for i in missing:
                ids[i] = new[pieces[i]]
            known.update((w, x) for w, x in new.items() if len(w) <= CACHE_WORD_CHARS)
        return ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        latin, others = [], []
        for i, t in enumerate(texts):
            if not _other.search(t) and _SPECIAL not in t:
                latin.append((i, _part.findall(t.lower())))
            elif _odd.search(t):
                out[i] = self._encode([t])[0]
            else:
                others.append((i, t.split()))
        for known, encode, cuts in ((self.parts, self._encode_parts, latin), (self.words, self._encode, others)):
            ids, at = self._look_up(known, encode, list(chain.from_iterable(c for _, c in cuts))), 0
            for i, c in cuts:
                out[i] = b"".join(ids[at:at + len(c)])
                at += len(c)
        return out


# ---------------------------------------------------------------- the plan

def _best_pairs(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every sum s: the largest r[b] + r[s - b], and that b."""
    best, arg = np.full(len(r), -np.inf), np.zeros(len(r), np.int64)
    for s in range(2, len(r)):
        half = s // 2
        v = r[1:half + 1] + r[s - 1:s - half - 1:-1]
        k = int(np.argmax(v))
        best[s], arg[s] = v[k], k + 1
    return best, arg


def _candidates(r: np.ndarray, least: float) -> list[tuple[int, ...]]:
    """Patterns of two to four lengths that fill a sequence, by how much is missing of them."""
    top = len(r) - 1
    best, arg = _best_pairs(r)
    a = np.arange(1, top)
    gain = np.concatenate([[best[top]], r[a] + best[top - a], best[a] + best[top - a]])
    out = []
    for o in np.argsort(-gain, kind="stable")[:PATTERNS_A_ROUND].tolist():
        if not gain[o] > least:
            break
        pair = lambda s: (int(arg[s]), int(s - arg[s]))
        parts = pair(top) if o == 0 else (o, *pair(top - o)) if o < top else (*pair(o - top + 1), *pair(2 * top - o - 1))
        out.append(tuple(sorted(parts, reverse=True)) + (0,) * (4 - len(parts)))
    return out


def fit_patterns(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, repeats): the non-negative least squares fit of exactly filling patterns to ``counts``.

    ``counts[n]`` is how many pieces have n ids; index 0 and the full length take no part. Unused
    places of a pattern hold length 0.
    """
    top = len(counts) - 1
    b = counts.astype(float)
    b[0] = b[top] = 0
    there = b > 0
    patterns, x, y = np.zeros((0, 4), np.int64), np.zeros(0), np.zeros(top + 1)

    def filled(v: np.ndarray) -> np.ndarray:
        out = np.bincount(patterns.ravel(), weights=np.repeat(v, 4), minlength=top + 1)
        out[0] = 0
        return out

    for _ in range(ROUNDS):
        r = np.where(there, b - y, -np.inf)
        have = set(map(tuple, patterns.tolist()))
        new = [p for p in dict.fromkeys(_candidates(r, LEAST_GAIN * max(1.0, float(np.abs(r[there]).max(initial=0)))))
               if p not in have]
        if not new:
            break
        patterns, x = np.vstack([patterns, np.array(new, np.int64)]), np.r_[x, np.zeros(len(new))]
        v = np.ones(len(x))
        for _ in range(15):  # the largest curvature, by power iteration
            u = filled(v)[patterns].sum(1)
            curve = float(np.linalg.norm(u) / np.linalg.norm(v))
            v = u / np.linalg.norm(u)
        z, t = x.copy(), 1.0
        for _ in range(STEPS):
            nxt = np.maximum(0, z - (filled(z) - b)[patterns].sum(1) / (1.05 * curve))
            if float(((z - nxt) * (nxt - x)).sum()) > 0:  # overshot: start the acceleration anew
                z, t = nxt.copy(), 1.0
            else:
                after = (1 + (1 + 4 * t * t) ** 0.5) / 2
                z, t = nxt + (t - 1) / after * (nxt - x), after
            x = nxt
        patterns, x = patterns[x > 1e-6], x[x > 1e-6]
        y = filled(x)
    return patterns, x


def plan_sequences(counts: np.ndarray) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(repeats, ((length, how many), ...)) that hold every piece of ``counts`` once."""
    top = len(counts) - 1
    left = counts.astype(np.int64).copy()
    left[0] = 0
    out = [(int(left[top]), ((top, 1),))] if left[top] else []
    left[top] = 0
    fitted = left.copy()
    ids = np.cumsum(left * np.arange(top + 1))
    fitted[:int(np.searchsorted(ids, FILLER_SHARE * ids[-1], side="right"))] = 0
    patterns, x = fit_patterns(fitted)
    for j in np.argsort(-x, kind="stable").tolist():
        need: dict[int, int] = {}
        for length in patterns[j].tolist():
            if length:
                need[length] = need.get(length, 0) + 1
        n = min(int(x[j] + 0.5), *(int(left[length]) // k for length, k in need.items()))
        if n:
            for length, k in need.items():
                left[length] -= n * k
            out.append((n, tuple(need.items())))
    return out + _best_fit(left)


def _best_fit(left: np.ndarray) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best fit, longest first; sequences with the same contents are handled as one group."""
    top = len(left) - 1
    rooms: list[int] = []
    waiting: dict[int, list] = {}
    out = []

    def put(room: int, n: int, held: tuple) -> None:
        if not n:
            return
        if not room:
            out.append((n, held))
            return
        if room not in waiting:
            insort(rooms, room)
            waiting[room] = []
        waiting[room].append((n, held))

    for length in range(top, 0, -1):
        c = int(left[length])
        while c:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                n, held = waiting[room].pop()
                if not waiting[room]:
                    del waiting[room], rooms[at]
            else:  # as many new sequences as it takes
                room, held = top, ()
                n = -(-c // (top // length))
            k = room // length
            whole = min(n, c // k)
            put(room - k * length, whole, (*held, (length, k)))
            c -= whole * k
            n -= whole
            if c and n:  # one sequence takes the rest
                put(room - c * length, 1, (*held, (length, c)))
                c, n = 0, n - 1
            put(room, n, held)
    return out + [(n, held) for room in rooms for n, held in waiting[room]]


def plan_table(plan: list) -> dict[str, np.ndarray]:
    """For every length, ranges of ordinals and the sequences and offsets they go to, sorted by (length, ordinal)."""
    rows, next_ordinal, sequence = [], {}, 0
    for n, held in plan:
        offset = 0
        for length, k in held:
            start = next_ordinal.get(length, 0)
            rows.append((length, start, k, sequence, offset))
            next_ordinal[length] = start + n * k
            offset += k * length
        sequence += n
    names = ("length", "start", "many", "sequence", "offset")
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {name: columns[:, i].copy() for i, name in enumerate(names)}


# ---------------------------------------------------------------- pieces

def cut_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
               ids: bool = True) -> DataFrame:
    """One row per piece with its place (``task``, ``nth``) among the pieces of its length in its task.

    ``ids`` (little-endian uint32), or only their checksum.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, "
              f"{'ids binary' if ids else 'ids_crc32 long'}, task int, nth long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("word encoder", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        task = TaskContext.get().partitionId()
        end, size = np.array([END_ID], "<u4").tobytes(), 4 * max_len
        seen = [0] * (max_len + 1)
        for batch in batches:
            docs_, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts, STEP_BYTES):
                out = []
                for doc, raw in zip(docs_.slice(a, b - a).to_pylist(), encoder(text_list(texts, a, b)), strict=True):
                    raw += end
                    for piece, at in enumerate(range(0, len(raw), size)):
                        part = raw[at:at + size]
                        length = len(part) // 4
                        out.append((doc, piece, at // 4, length, part if ids else zlib.crc32(part), task, seen[length]))
                        seen[length] += 1
                kinds = [docs_.type, pa.int32(), pa.int64(), pa.int64(), pa.binary() if ids else pa.int64(), pa.int32(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids" if ids else "ids_crc32", "task", "nth"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.mapInArrow(run, schema)


def pack_patterns(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
                  ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids or ids_crc32, sequence_id, offset), one row per piece.

    ``tokenizer_path`` must be readable by every executor.
    """
    pieces = stored(cut_pieces(docs, tokenizer_path, id_col, text_col, max_len, ids), "pattern-pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(max_len + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # at most max_len rows
        counts[length] = n
    plan = plan_table(plan_sequences(counts))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    keys = plan["length"] << 48 | plan["start"]

    def place(length: pa.Array, ordinal: pa.Array) -> pa.Array:
        size, nth = length.to_numpy(zero_copy_only=False), ordinal.to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, size << 48 | nth, side="right") - 1
        repeat, slot = np.divmod(nth - plan["start"][at], plan["many"][at])
        return pa.StructArray.from_arrays([pa.array(plan["sequence"][at] + repeat), pa.array(plan["offset"][at] + slot * size)],
                                          ["sequence_id", "offset"])

    placed = struct_udf(place, "sequence_id long, offset long")
    return (pieces.join(bases, ["task", "length"]).withColumn("at", placed(F.col("length"), F.col("base") + F.col("nth")))
            .select("doc_id", "piece", "start", "length", "ids" if ids else "ids_crc32", "at.sequence_id", "at.offset"))
