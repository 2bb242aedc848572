"""Hierarchical multi-length packing of tokenised documents.

Documents are tokenised, closed with an end id and routed by length to context-size
tiers (128 to 2048 ids). A document longer than the largest tier gives whole
windows of that tier first; its rest is routed. Each tier is packed from the longest
down: a window starts with a document of its own tier, its gap is filled with the
largest fitting documents of shorter tiers, and what is still open is closed by a cut
from another document, whose rest goes back to its tier. So every window is
exactly full. What is left at the end of a partition, less than a window, is
cut into powers of two. Sequences of one tier form step groups of ``STEP_IDS`` ids
each, so all training steps weigh the same.

Each partition packs its own rows as they come, with a bounded pool of waiting
documents and no shuffle; sequence numbers hold the partition's number. Where rows come in
an order that matters (range partitions, sorted), a small pool keeps it: sequences by
number then follow the rows, and no more than the pool and one slice of text come out of turn.

Defined results: a null text counts as empty, and an empty text is the end id alone.
Repeated rows and equal identifiers are packed like any others. Only the two
named columns are read. An empty table gives an empty one. There is no limit on a
text's length; a long text goes out window by window.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_by_worker, slices, text_list

TIERS = (128, 256, 512, 1024, 2048)
END_ID = 1
STEP_IDS = 16_384
# Ids that may wait in a partition's pool before windows are closed; bounds memory only.
POOL_IDS = 1 << 20
# The same where sequences have to follow the order of the rows.
ORDERED_IDS = 1 << 16
# Words whose ids are remembered before those that were not met again are forgotten; bounds memory only.
CACHE_WORDS = 400_000
# Text that is encoded at a time; bounds memory only.
ENCODED_BYTES = 2 << 20
# New words that are encoded as one text.
WORDS_A_TEXT = 500
# Fixed value: how the byte-level vocabulary writes a space.
SPACE = "Ġ"

# Cuts between pre-tokens of the byte-level BPE: a letter run before a blank or simple
# punctuation, any other non-blank run, and the blanks that the next word does not take.
_piece = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[ \n,.;:!?]|\Z)| ?\S+|\s+(?!\S)|\s")
# Texts that are cut by the pattern above, not at spaces: with blanks beside a space or at an end, blanks other
# than space and line end, or the special token.
_uneven = ("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]"
           "| [ \n]|\n |\\A[ \n]|[ \n]\\z|<\\|endoftext\\|>")
# A word of letters, punctuation after it, and letters on the next line: pre-tokens of their own.
_ended = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&$#*]*)(?:\n([A-Za-zÀ-ÖØ-öø-ÿ]+))?")
# Texts where Python's and the tokeniser's blanks differ, or with its special token, are encoded in one go.
_odd = re.compile(r"[\x1c-\x1f]|<\|endoftext\|>")


def _grown(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` after its first ``used`` values, in twice the room where it does not fit."""
    if used + len(more) > len(held):
        held = np.r_[held[:used], np.zeros(used + 2 * len(more), held.dtype)]
    held[used:used + len(more)] = more
    return held


class Encoder:
    """Little-endian uint32 ids of texts, by a ``tokenizers`` file; ids of word pieces are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        # places of what is remembered: words with a space before them, and pieces as they are
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        # the ids of place i are ids[starts[i]:starts[i + 1]]
        self.ids, self.starts, self.made = np.zeros(1 << 16, "<u4"), np.zeros(1 << 12, np.int64), 0
        # the places before this one are older than the texts at hand; those of them that were looked up again
        self.older, self.again = 0, np.zeros(0, bool)

    def _forget(self) -> None:
        """Only what later texts have asked for again stays, or nothing if that is more than ``CACHE_WORDS``."""
        again = self.again
        if np.count_nonzero(again) > CACHE_WORDS:
            again[:] = False
        ids, lengths = self._gather(np.flatnonzero(again))
        stays, place = again.tolist(), (np.cumsum(again) - 1).tolist()
        self.words, self.pieces = ({name: place[at] for name, at in known.items() if stays[at]}
                                   for known in (self.words, self.pieces))
        self.ids, self.starts, self.made = ids, np.r_[0, np.cumsum(lengths)], len(lengths)
        self.again = np.zeros(self.made, bool)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of a space and each word: many words as one text, told apart by the ids that start with a space."""
        out = []
        groups = [words[k:k + WORDS_A_TEXT] for k in range(0, len(words), WORDS_A_TEXT)]
        for group, raw in zip(groups, self._encode([" " + " ".join(g) for g in groups]), strict=True):
            at = (4 * np.flatnonzero(self.spaced[np.frombuffer(raw, "<u4")])).tolist()
            whole = len(at) == len(group) and at[0] == 0
            out += [raw[i:j] for i, j in zip(at, [*at[1:], len(raw)], strict=True)] if whole else \
                self._encode([" " + w for w in group])
        return out

    def _keep(self, known: dict[str, int], names: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        end = self.starts[self.made]
        self.ids = _grown(self.ids, int(end), ids)
        self.starts = _grown(self.starts, self.made + 1, end + np.cumsum(lengths))
        known.update(zip(names, range(self.made, self.made + len(names)), strict=True))
        self.made += len(names)

    def _keep_encoded(self, known: dict[str, int], names: list[str], encode) -> None:
        for k in range(0, len(names), 20_000):
            raw = encode(names[k:k + 20_000])
            self._keep(known, names[k:k + 20_000], np.frombuffer(b"".join(raw), "<u4"), np.array([len(r) // 4 for r in raw]))

    def _keep_words(self, names: list[str]) -> None:
        """Words with punctuation or a line end after their letters are put together from their parts."""
        parts = {w: m.groups("") for w in names if (m := _ended.fullmatch(w)) and m[1] != w}
        alone = dict.fromkeys(w for w in names if w not in parts) | dict.fromkeys(
            word for word, _, _ in parts.values() if word not in self.words)
        self._keep_encoded(self.words, list(alone), self._encode_words)
        if parts:
            words, marks, nexts = zip(*parts.values(), strict=True)
            places = np.stack([self._word_places(words), self._piece_places(marks),
                               self._piece_places(["\n" if x else "" for x in nexts]), self._piece_places(nexts)], axis=1)
            ids, lengths = self._gather(places.reshape(-1))
            self._keep(self.words, list(parts), ids, lengths.reshape(-1, 4).sum(axis=1))

    def _places(self, known: dict[str, int], names: Sequence[str], keep) -> np.ndarray:
        places = list(map(known.get, names))
        missing = [i for i, x in enumerate(places) if x is None]
        if missing:
            keep(list(dict.fromkeys(names[i] for i in missing)))
            for i in missing:
                places[i] = known[names[i]]
        out = np.array(places, np.int64)
        self.again[out[out < self.older]] = True
        return out

    def _word_places(self, names: Sequence[str]) -> np.ndarray:
        return self._places(self.words, names, self._keep_words)

    def _piece_places(self, names: Sequence[str]) -> np.ndarray:
        return self._places(self.pieces, names, lambda new: self._keep_encoded(self.pieces, new, self._encode))

    def _gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all places one after the other, and the number of each place's."""
        ends = self.starts[places + 1]
        lengths = ends - self.starts[places]
        stops = np.cumsum(lengths)
        return self.ids[np.arange(stops[-1] if len(stops) else 0) + np.repeat(ends - stops, lengths)], lengths

    def _by_pieces(self, text: str) -> bytes:
        if _odd.search(text):
            return self._encode([text])[0]
        return self._gather(self._piece_places(_piece.findall(text)))[0].tobytes()

    def _by_words(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts in which every space stands alone between other characters: a space starts a pre-token and goes
        with the next word. Each distinct word is looked up once, and the ids of all words are gathered at once."""
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy()
        first = offsets[:-1]  # the word that no space comes before
        coded = lists.values.dictionary_encode()
        code = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        spaced = np.ones(len(code), bool)
        spaced[first] = False
        used = np.zeros(len(distinct), bool)
        used[code[spaced]] = True
        place = np.zeros(len(distinct), np.int64)
        place[used] = self._word_places(distinct[used].tolist())
        heads = self._piece_places(distinct[code[first]].tolist())
        places = place[code]
        places[first] = heads
        ids, lengths = self._gather(places)
        stops = np.r_[0, np.cumsum(lengths)][offsets].tolist()
        return [ids[a:b].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        self.again = np.r_[self.again, np.zeros(self.made - len(self.again), bool)]
        if self.made > CACHE_WORDS:
            self._forget()
        self.older = self.made
        column = pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(column, _uneven)
        out = [self._by_pieces(t) if u else b"" for t, u in zip(texts, uneven.to_pylist(), strict=True)]
        even = [i for i, u in enumerate(uneven.to_pylist()) if not u]
        if even:
            for i, ids in zip(even, self._by_words(column.filter(pc.invert(uneven))), strict=True):
                out[i] = ids
        return out


class Pool:
    """Waiting pieces by length: (document, start, ids, document's ids)."""

    def __init__(self):
        self.by_size: dict[int, list] = {}
        self.sizes: list[int] = []
        self.ids = 0

    def put(self, piece: tuple) -> None:
        size = len(piece[2])
        self.ids += size
        if size not in self.by_size:
            insort(self.sizes, size)
            self.by_size[size] = []
        self.by_size[size].append(piece)

    def _take(self, size: int) -> tuple:
        waiting = self.by_size[size]
        piece = waiting.pop()
        self.ids -= size
        if not waiting:
            del self.by_size[size]
            del self.sizes[bisect_left(self.sizes, size)]
        return piece

    def fitting(self, most: int) -> tuple | None:
        """The longest piece of at most ``most`` ids."""
        at = bisect_right(self.sizes, most)
        return self._take(self.sizes[at - 1]) if at else None

    def cut(self, size: int) -> tuple:
        """The first ``size`` ids of the longest piece; its rest stays in the pool."""
        doc, start, ids, total = self._take(self.sizes[-1])
        if len(ids) > size:
            self.put((doc, start + size, ids[size:], total))
        return doc, start, ids[:size], total


class Packer:
    """Packs the documents of one partition; ``rows`` collects one row per piece, ending with ``show`` of its ids."""

    def __init__(self, partition: int, tiers: tuple[int, ...], show=np.ndarray.tobytes):
        self.base, self.show = partition << 36, show
        self.tiers = sorted(tiers)
        self.pool, self.rows, self.made = Pool(), [], 0
        self.tier_ids = dict.fromkeys(self.tiers, 0)

    def _emit(self, pieces: list[tuple], tier: int) -> None:
        at = 0
        group = self.base + (self.tiers.index(tier) << 30) + self.tier_ids[tier] // STEP_IDS
        self.tier_ids[tier] += tier
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), total, self.base + self.made, at, tier, group, self.show(ids)))
            at += len(ids)
        self.made += 1

    def add(self, doc, ids: np.ndarray) -> None:
        top = self.tiers[-1]
        whole = len(ids) - len(ids) % top
        for start in range(0, whole, top):
            self._emit([(doc, start, ids[start:start + top], len(ids))], top)
        if whole < len(ids):
            self.pool.put((doc, whole, ids[whole:], len(ids)))

    def _window(self) -> None:
        first = self.pool.fitting(self.tiers[-1])
        tier = self.tiers[bisect_left(self.tiers, len(first[2]))]
        pieces, gap = [first], tier - len(first[2])
        while gap and self.pool.ids:
            piece = self.pool.fitting(gap) or self.pool.cut(gap)
            pieces.append(piece)
            gap -= len(piece[2])
        if not gap:
            return self._emit(pieces, tier)
        # the last pieces of the partition: powers of two
        size = tier - gap
        for bit in reversed(range(size.bit_length())):
            part, need = [], size & 1 << bit
            while need:
                doc, start, ids, total = pieces.pop(0)
                if len(ids) > need:
                    pieces.insert(0, (doc, start + need, ids[need:], total))
                part.append((doc, start, ids[:need], total))
                need -= len(part[-1][2])
            if part:
                self._emit(part, tier if size == tier else self.tiers[bisect_left(self.tiers, min(1 << bit, self.tiers[-1]))])

    def close(self, most_waiting: int) -> None:
        while self.pool.ids > most_waiting:
            self._window()


def _together(cuts: list[tuple[int, int]], texts: pa.Array) -> Iterator[list[tuple[int, int]]]:
    """Successive row ranges in groups of up to ``ENCODED_BYTES`` of text; a larger range is alone."""
    group, size = [], 0
    for a, b in cuts:
        more = pc.sum(pc.binary_length(texts.slice(a, b - a))).as_py() or 0
        if group and size + more > ENCODED_BYTES:
            yield group
            group, size = [], 0
        group.append((a, b))
        size += more
    if group:
        yield group


PIECES = ("doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, tier int, "
          "step_group long, {ids}")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         tiers: tuple[int, ...] = TIERS, pool_ids: int | None = None, ids: bool = True) -> DataFrame:
    """One row per piece of a document; ``ids`` holds its ids as little-endian uint32, or ``ids_crc32`` their checksum.

    ``tokenizer_path`` must be readable by every executor. ``pool_ids``: ids that may wait. No shuffle.
    """
    most = POOL_IDS if pool_ids is None else pool_ids
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString(), ids="ids binary" if ids else "ids_crc32 long")
    show = np.ndarray.tobytes if ids else zlib.crc32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("encoder", tokenizer_path), lambda: Encoder(tokenizer_path))
        packer = Packer(TaskContext.get().partitionId(), tiers, show)
        end = np.array([END_ID], "<u4").tobytes()
        id_type = pa.int64()

        def out() -> Iterator[pa.RecordBatch]:
            done, packer.rows = packer.rows, []
            if done:
                columns = list(zip(*done, strict=True))
                kinds = [id_type, *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.binary() if ids else pa.int64()]
                names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step_group",
                         "ids" if ids else "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            docs_, texts = batch.column(0), batch.column(1)
            id_type = docs_.type
            cuts = list(slices(texts, min(1 << 20, most)))
            for some in _together(cuts, texts):  # the more text at a time, the fewer look-ups of one word
                first, last = some[0][0], some[-1][1]
                encoded = encoder(text_list(texts, first, last))
                for a, b in some:
                    for doc, raw in zip(docs_.slice(a, b - a).to_pylist(), encoded[a - first:b - first], strict=True):
                        packer.add(doc, np.frombuffer(raw + end, "<u4"))
                    if packer.pool.ids > most:
                        packer.close(most // 2)
                    yield from out()
        packer.close(0)
        yield from out()

    return rows.mapInArrow(run, schema)


def packed_pieces(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """The pieces with a checksum of their ids instead of the ids."""
    return pack(docs, tokenizer_path, ids=False, **options)
