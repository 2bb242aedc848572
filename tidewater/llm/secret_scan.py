"""Secret scan over a trigram inverted index.

For every rule a Boolean trigram query is derived from its regular expression:
strings that each match must hold become conjunctions of their trigrams,
alternatives become disjunctions. A slice of documents gets an inverted index
(trigram -> documents) of the trigrams that any rule asks for; postings are
intersected and united as the query says, and only the candidate documents
are verified by the regular expression itself. A rule without a mandatory
trigram scans every document. The index is of lower-case text, so one index
serves rules of either case and never misses a match.

Spans are code points, end exclusive. Defined results: a null or empty
text has no spans. Rows are scanned one by one and whole, so ties, repeated
rows, extra columns and very long texts need no special care; an empty table
gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from re import _constants as sre
from re import _parser as sre_parse
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, struct_udf, text_list


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0       # this group must have
    min_length: int = 1  # so many characters


# The base rules come first; the order breaks ties between spans.
BASE_RULES = (
    Rule("assign", r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
)
RULES = BASE_RULES + MORE_RULES

# A trigram query: True (any document), ("tri", t), ("and", ...) or ("or", ...).
MAX_STRINGS = 64


def _all(parts: Iterable) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts: Iterable) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _holds(strings: Iterable[str]) -> object:
    """Query of documents that hold one of ``strings``."""
    return _any(_all(("tri", s.encode()[i:i + 3]) for i in range(len(s.encode()) - 2)) for s in sorted(strings))


def _exact(op, arg) -> set[str] | None:
    """All strings (lower case) that one regex item matches, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN and len(arg) <= 8 and all(k is sre.LITERAL for k, _ in arg):
        return {chr(v).lower() for _, v in arg}
    if op is sre.BRANCH:
        sets = [_strings(x) for x in arg[1]]
        return None if None in sets else set().union(*sets)
    if op is sre.SUBPATTERN:
        return _strings(arg[3])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1:
        own = _strings(arg[2])
        return own if own is None or arg[0] else own | {""}
    return None


def _strings(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        own = _exact(op, arg)
        if own is None or len(own) * len(out) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def _query(items) -> object:
    parts, held = [], {""}
    for op, arg in items:
        own = _exact(op, arg)
        if own is not None and len(own) * len(held) <= MAX_STRINGS:
            held = {a + b for a in held for b in own}
            continue
        parts.append(_holds(held))
        held = own if own is not None and len(own) <= MAX_STRINGS else {""}
        if own is None:
            if op is sre.SUBPATTERN:
                parts.append(_query(arg[3]))
            elif op is sre.BRANCH:
                parts.append(_any(_query(x) for x in arg[1]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0]:
                parts.append(_query(arg[2]))
    return _all([*parts, _holds(held)])


def trigram_query(pattern: str) -> object:
    """Boolean trigram query that every text with a match of ``pattern`` satisfies."""
    return _query(sre_parse.parse(pattern))


def trigrams(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams, query[1:]))


class Index:
    """Postings of the wanted trigrams over a slice of texts."""

    def __init__(self, wanted: Iterable[bytes]):
        self.ids = {t: i + 1 for i, t in enumerate(sorted(set(wanted)))}
        if len(self.ids) > 65_534:
            raise ValueError("too many trigrams for one index")
        self.code = np.zeros(1 << 24, np.uint8 if len(self.ids) < 255 else np.uint16)
        for t, i in self.ids.items():
            self.code[t[0] << 16 | t[1] << 8 | t[2]] = i

    def postings(self, texts: list[str]) -> np.ndarray:
        """Boolean matrix: trigram id x document."""
        out = np.zeros((len(self.ids) + 1, len(texts)), bool)
        raw = [t.encode().lower() for t in texts]
        data = np.frombuffer(b"\0\0".join(raw), np.uint8).astype(np.uint32)
        if len(data) < 3:
            return out
        found = self.code[data[:-2] << 16 | data[1:-1] << 8 | data[2:]]
        at = np.flatnonzero(found)
        ends = np.cumsum(np.fromiter((len(r) + 2 for r in raw), np.int64, len(raw)))
        out[found[at], np.searchsorted(ends, at, side="right")] = True
        return out

    def candidates(self, query: object, postings: np.ndarray) -> np.ndarray:
        if query is True:
            return np.ones(postings.shape[1], bool)
        if query[0] == "tri":
            return postings[self.ids[query[1]]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(
            [self.candidates(q, postings) for q in query[1:]])


def scanner(rules: tuple[Rule, ...] = RULES):
    """Function of a list of texts: for each text its spans as (start, rule number, end), sorted."""
    compiled = [re.compile(r.pattern) for r in rules]
    queries = [trigram_query(r.pattern) for r in rules]
    index = Index(set().union(*map(trigrams, queries)))

    def spans(rule: Rule, number: int, text: str) -> Iterator[tuple[int, int, int]]:
        for m in compiled[number].finditer(text):
            if len(m[rule.group]) >= rule.min_length:
                yield m.start(), number, m.end()

    def scan(texts: list[str]) -> list[list[tuple[int, int, int]]]:
        postings = index.postings(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
            for k in np.flatnonzero(index.candidates(query, postings)):
                found[k].extend(spans(rule, number, texts[k]))
        return [sorted(x) for x in found]

    return scan


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def secret_scan(docs: DataFrame, text_col: str = "text", out_col: str = "secrets",
                rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with an array column ``out_col`` of the spans found, ordered by start, then by rule.

    All columns stay; the caller picks an ``out_col`` that ``docs`` lacks. No shuffle.
    """
    state: list = []

    def find(texts: pa.Array) -> pa.Array:
        if not state:  # once per Python worker
            state.append(scanner(rules))
        rows = [[{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in found]
                for lo, hi in slices(texts) for found in state[0](text_list(texts, lo, hi))]
        return pa.StructArray.from_arrays([pa.array(rows, pa.list_(_SPAN))], ["spans"])

    found = struct_udf(find, "spans array<struct<kind:string,start:int,end:int>>")
    return docs.withColumn(out_col, found(F.col(text_col).cast("string")).getField("spans"))


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the spans, derived from the operator's array column."""
    found = secret_scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), out_col="secrets")
    base = [r.kind for r in BASE_RULES]
    shown = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, base),
                        F.sha2(shown(F.filter("secrets", lambda x: x.kind.isin(base))), 256).alias("base_sha256"),
                        shown(F.col("secrets")).alias("spans"))
