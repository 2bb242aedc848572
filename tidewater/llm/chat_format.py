"""Chat formatting by columnar byte assembly.

A turn becomes ``<|role|>\\n`` + text + ``<|end|>\\n``; a conversation is its
turns in order. Control strings inside roles and texts are escaped: where a
control string (or an escaped one) starts, one backslash goes in after its first
character, so ``</s>`` becomes ``<\\/s>`` and ``<\\/s>`` becomes ``<\\\\/s>``. Taking one
backslash out again gives back exactly the text that went in.

The turns of a batch are laid out at once: lengths of headers, texts and
trailers give cumulative offsets, the offsets give scatter indices, and headers and
texts are copied into one preallocated buffer that becomes an Arrow column. The
loss mask of a row is the span of each assistant text in it.

Turns are dealt out by conversation and sorted within a partition; a
conversation is one row per Arrow batch it touches (``part`` counts them), so no
task ever holds a whole long conversation, and joined in order the parts are
the conversation.

Defined results: a null text or role counts as empty; null conversation
ids form one conversation; a null turn comes first; equal turns are ordered by role,
then text, and repeated rows all stay. Only the four named columns are read,
so extra columns do not matter. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

OPEN, CLOSE, END = b"<|", b"|>\n", b"<|end|>\n"
ASSISTANT = "assistant"
# Start of a control string, escaped any number of times; and the backslash that escaping put in.
_control = re.compile(rb"<(?=\\*(?:\||/?s>|</?SYS>>))|\[(?=\\*/?INST\])|\|(?=\\*>)")
_escaped = re.compile(rb"(<\\*)\\(?=\||/?s>|</?SYS>>)|(\[\\*)\\(?=/?INST\])|(\|\\*)\\(?=>)")

FORMATTED = "conv_id long, part long, formatted binary, loss array<struct<start:int,end:int>>"
_LOSS = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_OUT = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.binary()),
                  ("loss", pa.list_(_LOSS))])
# Rows of one assembled piece; bounds memory only.
PIECE_BYTES = 8 << 20


def escape(text: bytes) -> bytes:
    return _control.sub(lambda m: m[0] + b"\\", text)


def unescape(text: bytes) -> bytes:
    return _escaped.sub(lambda m: m[1] or m[2] or m[3], text)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end, and n + 1 offsets; nulls count as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def escaped_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Like ``_bytes``, with a backslash scattered in after the first byte of every control string."""
    data, offsets = _bytes(column)
    raw = data.tobytes()
    at = np.fromiter((m.start() for m in _control.finditer(raw)), np.int64)
    if len(at):  # none that the end of one row and the start of the next make up together
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = [k for k, (p, stop) in enumerate(zip(at.tolist(), offsets[row + 1].tolist(), strict=True))
                  if _control.match(raw[p:stop])]
        at = at[inside]
    if not len(at):
        return data, offsets
    grown = np.zeros(len(data) + 1, np.int64)
    grown[at + 1] = 1
    shift = np.cumsum(grown)
    out = np.full(len(data) + len(at), ord("\\"), np.uint8)
    out[np.arange(len(data)) + shift[:-1]] = data
    return out, offsets + np.r_[0, np.searchsorted(at, offsets[1:], side="left")]


def scatter(out: np.ndarray, starts: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy row k of (data, offsets) to ``out`` at starts[k]."""
    lengths = np.diff(offsets)
    out[np.repeat(starts - offsets[:-1], lengths) + np.arange(len(data))] = data


def assemble(conv: pa.Array, role: pa.Array, text: pa.Array, first_parts: np.ndarray) -> pa.RecordBatch:
    """Format rows that are sorted by conversation: one output row per run of equal ids.

    ``first_parts`` has the part number of the first run, 0 for the others.
    """
    n = len(conv)
    roles, role_at = escaped_column(role)
    texts, text_at = escaped_column(text)
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    size = len(OPEN) + role_len + len(CLOSE) + text_len + len(END)
    start = np.r_[0, np.cumsum(size)]
    out = np.empty(start[-1], np.uint8)
    at = start[:-1].copy()
    for piece, length in ((OPEN, None), ((roles, role_at), role_len), (CLOSE, None), ((texts, text_at), text_len),
                          (END, None)):
        if length is None:
            out[at[:, None] + np.arange(len(piece))] = np.frombuffer(piece, np.uint8)
            at = at + len(piece)
        else:
            if piece[0] is texts:
                text_start = at
            scatter(out, at, *piece)
            at = at + length
    key = pc.fill_null(conv, 0).to_numpy(zero_copy_only=False)
    null = conv.is_null().to_numpy(zero_copy_only=False)
    head = np.r_[True, (key[1:] != key[:-1]) | (null[1:] != null[:-1])]
    runs = np.flatnonzero(head)
    bounds = np.r_[start[runs], start[-1]]
    run_of = np.cumsum(head) - 1
    is_loss = pc.fill_null(pc.equal(role, ASSISTANT), False).to_numpy(zero_copy_only=False)
    base = bounds[run_of]
    spans = pa.StructArray.from_arrays([pa.array((text_start - base)[is_loss].astype(np.int32)),
                                        pa.array((text_start + text_len - base)[is_loss].astype(np.int32))],
                                       fields=list(_LOSS))
    per_run = np.bincount(run_of[is_loss], minlength=len(runs))
    formatted = pa.Array.from_buffers(pa.binary(), len(runs),
                                      [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out)])
    loss = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_run)].astype(np.int32)), spans)
    assert n == len(run_of)
    return pa.RecordBatch.from_arrays([conv.take(pa.array(runs)), pa.array(first_parts[:len(runs)]), formatted, loss],
                                      schema=_OUT)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = base = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, base + PIECE_BYTES, side="right")))
            yield batch.slice(lo, hi - lo)
            lo, base = hi, int(ends[hi - 1])


def _assemble_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple | None = None
    part = 0
    for b in _pieces(batches):
        conv = b.column("conv_id")
        part = part + 1 if last == (conv[0].as_py(),) else 0
        parts = np.zeros(b.num_rows, np.int64)
        parts[0] = part
        yield (made := assemble(conv, b.column("role"), b.column("text"), parts))
        if made.num_rows > 1:
            part = 0
        last = (conv[-1].as_py(),)


def chat_format(conversations: DataFrame) -> DataFrame:
    """Columns of ``FORMATTED``: the formatted conversations, cut in parts, each with its loss spans (bytes).

    One shuffle by conversation. The parts of a conversation leave one partition
    in order, one after the other.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    n = shuffle_partitions(conversations.sparkSession)
    dealt = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_assemble_all, FORMATTED)


def read_turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of each turn, read back from a formatted part."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError("not a formatted conversation")
        # neither mark can occur in an escaped role or text
        role_end = formatted.index(CLOSE, at + len(OPEN))
        end = formatted.index(END, role_end)
        yield unescape(formatted[at + len(OPEN):role_end]), unescape(formatted[role_end + len(CLOSE):end])
        at = end + len(END)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


class _Reader:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, formatted: bytes, loss: list[dict]) -> None:
        for role, text in read_turns(formatted):
            self.turns += 1
            self.all.update(role + b"\n" + text + b"\n")
        for span in loss:
            text = unescape(formatted[span["start"]:span["end"]])
            self.loss_chars += len(text.decode())
            self.loss.update(text)
        self.chars += len(formatted.decode())

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Reader | None = None
    for batch in batches:
        done = []
        for row in range(batch.num_rows):
            conv_id, part, formatted, loss = (batch.column(k)[row].as_py() for k in range(4))
            if part == 0:
                if now:
                    done.append(now.row())
                now = _Reader(conv_id)
            now.feed(formatted, loss)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_DIGEST)
    if now:
        yield pa.RecordBatch.from_pylist([now.row()], schema=_DIGEST)


def chat_digest(conversations: DataFrame) -> DataFrame:
    """Per conversation the counts and digests, all read back from ``chat_format``'s output.

    Runs in the tasks that format: the parts of a conversation come one after the other there.
    """
    return chat_format(conversations).mapInArrow(_digests, DIGEST)
