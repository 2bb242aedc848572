"""Line-first quality rules.

Every line of a document is judged on its own by a punctuation, a
repetition, a navigation and a boilerplate rule. Failing lines are removed,
and a document that loses more than a fixed share of its words is rejected.
A document-level base test (too few words, too many repeated five-word
windows) is applied to the text as it came.

Words are runs of characters other than ASCII white space; lines are split at
``\\n``. A line without a word is dropped from the cleaned text and counts
neither as kept nor as lost.

Defined results: a null or empty text has no words, fails the base test
and has an empty cleaned text. Rows are judged one by one, so repeated rows,
ties and extra columns do not matter, and an empty table gives an empty one.
There is no limit on the length of a text or of a line.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, struct_udf, text_list

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
# A document is rejected when more than this share of its words is on failing lines.
MAX_LOST_PERCENT = 60
SYMBOLS = "#*$%&|<>"
MARKS = SYMBOLS + "!"
BLANKS = " \t\n\r\x0b\x0c"

# Phrases of boilerplate lines (lower case) and words of navigation lines.
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "licensed under",
    "privacy policy", "released under the", "sign up for", "subscribe to our", "terms of service",
    "terms of use", "use of cookies", "uses cookies",
)
BOILERPLATE_MAX_WORDS = 25
NAVIGATION = (
    "about", "account", "back", "blog", "contact", "faq", "help", "home", "login", "logout", "menu",
    "next", "previous", "register", "search", "share", "sitemap", "top",
)
NAVIGATION_MAX_WORDS = 12

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lines long, lost_lines long, lost_words long, base_failed boolean, kept boolean, clean_text string")

_symbols = [c.encode() for c in SYMBOLS]
_marks = [c.encode() for c in MARKS]
_blanks = [c.encode() for c in BLANKS]
_boiler = re.compile(b"|".join(re.escape(p.encode()) for p in BOILERPLATE))
_nav = frozenset(w.encode() for w in NAVIGATION)


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """Verdict of the line rules; ``words`` are the words of ``line``."""
    n = len(words)
    marks = sum(map(line.count, _marks))
    if marks >= 3 and 3 * marks >= n:                                 # punctuation
        return True
    if n >= 4 and 2 * sum(map(bytes.__eq__, words, words[1:])) >= n:  # one word again and again
        return True
    if n <= NAVIGATION_MAX_WORDS and 2 * sum(w.lower() in _nav for w in words) >= n:
        return True
    return n <= BOILERPLATE_MAX_WORDS and _boiler.search(line.lower()) is not None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a five-word window found at least twice."""
    grams = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    seen: set = set()
    again = {g for g in grams if g in seen or seen.add(g)}
    if not again:
        return 0
    total = end = 0
    for i, g in enumerate(grams):
        if g in again:
            total += i + WINDOW - max(i, end)
            end = i + WINDOW
    return total


def may_repeat(word_lists: list[list[bytes]]) -> np.ndarray:
    """Documents that can hold a repeated window: equal window hashes within a document.

    Equal windows always have equal hashes; unequal ones with equal hashes are
    sorted out by ``repeated_words``, which compares the words themselves.
    """
    sizes = np.fromiter(map(len, word_lists), np.int64, len(word_lists))
    total = int(sizes.sum())
    out = np.zeros(len(word_lists), bool)
    if total < WINDOW:
        return out
    h = np.fromiter((hash(w) for ws in word_lists for w in ws), np.int64, total).view(np.uint64)
    doc = np.repeat(np.arange(len(word_lists)), sizes)
    g = np.zeros(total - WINDOW + 1, np.uint64)
    for i in range(WINDOW):
        g = (g ^ h[i:total - WINDOW + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        g ^= g >> np.uint64(29)
    d = doc[:len(g)]
    whole = d == doc[WINDOW - 1:]
    g, d = g[whole], d[whole]
    g = (g ^ d.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(g)
    g, d = g[order], d[order]
    out[d[1:][g[1:] == g[:-1]]] = True
    return out


def judge(texts: list[str]) -> list[tuple]:
    """One tuple of ``SCHEMA`` for each text."""
    # bytes.split() cuts at ASCII white space, as the rule for words says; str.split() cuts at more
    lines_of = [[(line, line.split()) for line in t.encode().split(b"\n")] for t in texts]
    words_of = [[w for _, ws in lines for w in ws] for lines in lines_of]
    repeats = may_repeat(words_of)
    out = []
    for t, lines, words, repeat in zip(texts, lines_of, words_of, repeats, strict=True):
        n = len(words)
        n_repeat = repeated_words(words) if repeat else 0
        base_failed = n < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n
        lines = [x for x in lines if x[1]]
        failed = [line_fails(*x) for x in lines]
        lost = sum(len(ws) for (_, ws), bad in zip(lines, failed, strict=True) if bad)
        data = b"\n".join(line for line, _ in lines)
        out.append((n, len(t) - sum(map(t.count, BLANKS)), sum(map(data.count, _symbols)),
                    len(lines) - len({line for line, _ in lines}), n_repeat, len(lines), sum(failed), lost,
                    base_failed, not base_failed and 100 * lost <= MAX_LOST_PERCENT * n,
                    b"\n".join(line for (line, _), bad in zip(lines, failed, strict=True) if not bad).decode()))
    return out


NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
TYPES = [{"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[x.split()[1]] for x in SCHEMA.split(", ")]


def _judge(texts: pa.Array) -> pa.Array:
    rows = [r for start, stop in slices(texts) for r in judge(text_list(texts, start, stop))]
    columns = zip(*rows, strict=True) if rows else [()] * len(NAMES)
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], NAMES)


def quality_rules(docs: DataFrame, text_col: str = "text", out_col: str = "quality_rules") -> DataFrame:
    """``docs`` with a struct column ``out_col`` of counts, verdicts and the cleaned text.

    All columns of ``docs`` stay as they are; the caller picks a name for
    ``out_col`` that ``docs`` does not have. No shuffle.
    """
    return docs.withColumn(out_col, struct_udf(_judge, SCHEMA)(F.col(text_col).cast("string")))


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The kept documents with their cleaned text, under the columns of ``docs``."""
    out = "quality_rules"
    while out in docs.columns:
        out = f"_{out}"
    judged = quality_rules(docs, text_col, out).filter(F.col(f"{out}.kept"))
    return judged.withColumn(text_col, F.col(f"{out}.clean_text")).drop(out)
