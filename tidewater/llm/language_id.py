"""Language of words and documents by a linear-chain conditional random field.

Every word with a letter gets a label. Its features are the word itself (the
lexicon), prefixes, suffixes and character n-grams, hashed into one weight
table; neighbouring labels are tied by learned transition weights.
Forward-backward gives the chance of each label for each word, so text that
switches between languages is labelled piece by piece. A document's language is the
one with the largest sum of these chances over its words, and its score is their mean.

The model is trained here, on the driver, from at most ``TRAIN_DOCS`` labelled documents of
each language (those with the smallest hash of their identifier, of at most
``TRAIN_CHARS`` characters each): lines of them, spliced into code-switched sequences.
Every document is then labelled whole; a line is a chain, and a line of more than
``CHAIN`` words is labelled in pieces of that many.

Defined results: null text, empty text and text without a letter give ``und`` with
score 0. Without any labelled document everything is ``und``. Ties go to the
label first in order. A null identifier counts as the empty text in the split.
Rows are labelled one by one, so repeated rows and extra columns need no care; an
empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, struct_udf, text_list
from .words import combine, mix

TRAIN_DOCS = 250
TRAIN_CHARS = 20_000
SEQUENCES = 5000   # spliced training sequences
EPOCHS = 3
CHAIN = 512
TABLE_BITS = 16
CACHE_WORDS = 200_000  # words whose scores a Python worker remembers; bounds memory only
UNKNOWN = "und"
_trim = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…–—¿¡"


def _slot(x: np.ndarray, kind: int) -> np.ndarray:
    return (mix(x + np.uint64(kind << 56)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, slot in the weight table) of every feature of ``words``, in order of the words.

    Features: the word, every two and three characters of ^word$ (so prefixes and
    suffixes of one and two), and its first and its last three characters.
    """
    marked = [f"^{w.lower().strip(_trim)}$" for w in words]
    x = np.frombuffer("".join(marked).encode("utf-16-le", "replace"), np.uint16).astype(np.uint64)
    sizes = np.fromiter((len(m.encode("utf-16-le", "replace")) // 2 if not m.isascii() else len(m) for m in marked),
                        np.int64, len(marked))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word = np.repeat(np.arange(len(marked)), sizes)
    one = mix(x + np.uint64(1))
    two = combine(one[:-1], one[1:]) if len(x) > 1 else one[:0]
    three = combine(two[:-1], one[2:]) if len(x) > 2 else one[:0]
    four = combine(three[:-1], one[3:]) if len(x) > 3 else one[:0]
    step = np.arange(len(x), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
    whole = np.add.reduceat(mix(one + step), starts) if len(starts) else one[:0]
    in2, in3 = word[:-1] == word[1:], word[:-2] == word[2:]
    long = np.flatnonzero(sizes >= 4)
    parts = [(np.arange(len(marked)), _slot(whole, 1)),
             (word[:-1][in2], _slot(two[in2], 2)), (word[:-2][in3], _slot(three[in3], 3)),
             (long, _slot(four[starts[long]], 4)), (long, _slot(four[ends[long] - 4], 5))]
    number = np.concatenate([n for n, _ in parts])
    order = np.argsort(number, kind="stable")
    return number[order], np.concatenate([f for _, f in parts])[order]


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def word_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the feature weights of each word, per label."""
    if not words:
        return np.zeros((0, weights.shape[1]), np.float32)
    number, slot = features(words)
    first = np.searchsorted(number, np.arange(len(words)))
    return np.add.reduceat(weights[slot], first, axis=0)


def forward_backward(score: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Label chances of chains that are laid out longest first.

    ``score``: time x chain x label; ``lengths`` falls. With ``pairs`` also the expected
    number of each transition.
    """
    steps, n, labels = score.shape
    e = np.exp(score - score.max(axis=2, keepdims=True))
    t = np.exp(trans - trans.max())
    live = np.searchsorted(-lengths, -np.arange(steps), side="left")  # chains longer than the step
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    alpha[0] = e[0] / e[0].sum(axis=1, keepdims=True)
    for k in range(1, steps):
        m = live[k]
        a = (alpha[k - 1, :m] @ t) * e[k, :m]
        alpha[k, :m] = a / a.sum(axis=1, keepdims=True)
    for k in range(steps - 2, -1, -1):
        m = live[k + 1]
        b = (e[k + 1, :m] * beta[k + 1, :m]) @ t.T
        beta[k, :m] = b / b.sum(axis=1, keepdims=True)
    chance = alpha * beta
    chance /= np.maximum(chance.sum(axis=2, keepdims=True), 1e-30)
    if not pairs:
        return chance
    expected = np.zeros((labels, labels))
    for k in range(1, steps):
        m = live[k]
        x = alpha[k - 1, :m, :, None] * t * (e[k, :m] * beta[k, :m])[:, None, :]
        expected += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return chance, expected


class Model:
    """Weights of a trained chain: labels, feature weights, transitions."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray):
        self.labels, self.weights, self.trans = labels, weights, trans


def train(texts: list[tuple[str, str]], seed: int = 7) -> Model:
    """Model from (language, text) pairs; conditional likelihood, AdaGrad over small batches."""
    labels = sorted({lang for lang, _ in texts})
    lines: dict[str, list[list[str]]] = {lang: [] for lang in labels}
    for lang, text in texts:
        for line in text.split("\n"):
            words = [w for w in line.split() if has_letter(w)]
            if words:
                lines[lang].append(words)
    rng = np.random.default_rng(seed)
    k = len(labels)
    usable = [i for i, lang in enumerate(labels) if lines[lang]]
    weights, trans = np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((k, k))
    if not usable:
        return Model(labels, weights, trans)
    chains = []
    for _ in range(SEQUENCES):
        words, gold = [], []
        for _ in range(rng.integers(1, 4)):
            y = usable[rng.integers(len(usable))]
            line = lines[labels[y]][rng.integers(len(lines[labels[y]]))]
            size = int(rng.integers(3, 21))
            at = int(rng.integers(0, max(1, len(line) - size + 1)))
            words += line[at:at + size]
            gold += [y] * len(line[at:at + size])
        chains.append((words, gold))
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in chains for w in words))}
    number, slot = features(list(vocabulary))
    bounds = np.searchsorted(number, np.arange(len(vocabulary) + 1))
    slots = [slot[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    grad2, trans2 = np.full_like(weights, 1e-3), np.full_like(trans, 1e-3)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(chains))
        for lo in range(0, len(order), 50):
            batch = sorted((chains[i] for i in order[lo:lo + 50]), key=lambda c: -len(c[0]))
            lengths = np.array([len(words) for words, _ in batch])
            ids = [vocabulary[w] for words, _ in batch for w in words]
            sizes = np.array([len(slots[i]) for i in ids])
            flat = np.concatenate([slots[i] for i in ids])
            emission = np.add.reduceat(weights[flat], np.r_[0, np.cumsum(sizes)[:-1]], axis=0)
            chain = np.repeat(np.arange(len(batch)), lengths)
            step = np.arange(len(chain)) - np.repeat(np.r_[0, np.cumsum(lengths)[:-1]], lengths)
            score = np.zeros((lengths[0], len(batch), k))
            score[step, chain] = emission
            chance, expected = forward_backward(score, lengths, trans, pairs=True)
            gold = np.array([y for _, ys in batch for y in ys])
            g = chance[step, chain]
            g[np.arange(len(gold)), gold] -= 1
            seen = np.zeros((k, k))
            follows = step[1:] > 0
            np.add.at(seen, (gold[:-1][follows], gold[1:][follows]), 1)
            gt = (expected - seen) / len(batch) + 1e-3 * trans
            trans2 += gt * gt
            trans -= 0.2 * gt / np.sqrt(trans2)
            touched, place = np.unique(flat, return_inverse=True)
            gw = np.zeros((len(touched), k), np.float32)
            np.add.at(gw, place, np.repeat(g, sizes, axis=0).astype(np.float32))
            gw = gw / len(batch) + 1e-5 * weights[touched]
            grad2[touched] += gw * gw
            weights[touched] -= 0.2 * gw / np.sqrt(grad2[touched])
    return Model(labels, weights, trans)


class Labeller:
    """Applies a model to lists of texts."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1024, len(model.labels)), np.float32)

    def _ids(self, words: list[str]) -> np.ndarray:
        """Row in ``scores`` of each word; -1 for a word without a letter."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = list(set(words).difference(self.known))
        plain = [w for w in new if has_letter(w)]
        used = 1 + max(len(self.known), 0)
        need = used + len(plain) + 1
        if need > len(self.scores):
            self.scores = np.resize(self.scores, (2 * need, self.scores.shape[1]))
        self.known.update(dict.fromkeys(new, -1))
        # rows are numbered by the size of the table, which only grows until it is cleared
        rows = range(used, used + len(plain))
        self.known.update(zip(plain, rows, strict=True))
        for lo in range(0, len(plain), 20_000):
            some = plain[lo:lo + 20_000]
            self.scores[used + lo:used + lo + len(some)] = word_scores(some, self.model.weights)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def chances(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word number in it, label chances) of every word with a letter, in order."""
        words, lines, docs = [], [], []
        for d, t in enumerate(texts):
            for line in t.split("\n"):
                own = line.split()
                if own:
                    words += own
                    lines.append(len(own))
                    docs.append(d)
        lines, docs = np.array(lines, np.int64), np.array(docs, np.int64)
        line_of = np.repeat(np.arange(len(lines)), lines)
        doc_of = docs[line_of] if len(lines) else np.zeros(0, np.int64)
        ids = self._ids(words)
        starts = np.searchsorted(doc_of, np.arange(len(texts)))
        number = np.arange(len(words)) - starts[doc_of] if len(words) else np.zeros(0, np.int64)
        keep = np.flatnonzero(ids >= 0)
        ids, line_of, doc_of, number = ids[keep], line_of[keep], doc_of[keep], number[keep]
        out = np.zeros((len(ids), len(self.model.labels)), np.float32)
        if not len(ids):
            return doc_of, number, out
        first = np.flatnonzero(np.r_[True, line_of[1:] != line_of[:-1]])
        place = np.arange(len(ids)) - np.repeat(first, np.diff(np.r_[first, len(ids)]))
        heads = np.flatnonzero(place % CHAIN == 0)
        sizes = np.diff(np.r_[heads, len(ids)])
        order = np.argsort(-sizes, kind="stable")
        # chains of like length together, some 100,000 cells at a time
        at = 0
        while at < len(order):
            longest = int(sizes[order[at]])
            some = order[at:at + max(1, 100_000 // longest)]
            some = some[:int(np.searchsorted(-sizes[some], -(longest // 2), side="right")) or 1]
            n = sizes[some]
            rows = np.repeat(heads[some], n)
            step = np.arange(len(rows)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
            rows, chain = rows + step, np.repeat(np.arange(len(some)), n)
            score = np.zeros((longest, len(some), out.shape[1]), np.float32)
            score[step, chain] = self.scores[ids[rows]]
            out[rows] = forward_backward(score, n, self.model.trans.astype(np.float32))[step, chain]
            at += len(some)
        return doc_of, number, out

    def __call__(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """(language, score, runs of words with one language) of each text."""
        doc, number, chance = self.chances(texts)
        total = np.zeros((len(texts), chance.shape[1]))
        np.add.at(total, doc, chance)
        counts = np.bincount(doc, minlength=len(texts))
        best = chance.argmax(axis=1) if len(chance) else np.zeros(0, np.int64)
        cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (best[1:] != best[:-1])]) if len(doc) else []
        runs: list[list[dict]] = [[] for _ in texts]
        ends = np.r_[cut[1:], len(doc)] if len(doc) else []
        for a, b in zip(cut, ends, strict=True):
            runs[doc[a]].append({"first_word": int(number[a]), "last_word": int(number[b - 1]),
                                 "lang": self.model.labels[best[a]]})
        out = []
        for d in range(len(texts)):
            if not counts[d]:
                out.append((UNKNOWN, 0.0, []))
                continue
            y = int(total[d].argmax())
            out.append((self.model.labels[y], float(min(1.0, total[d, y] / counts[d])), runs[d]))
        return out


def held_out(id_col: Column) -> Column:
    """Documents that no model may learn from: crc32 of the identifier as text, modulo 4, is 2."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_docs: int = TRAIN_DOCS) -> Model:
    """Train on a bounded sample of the labelled documents that are not held out."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"),
                       F.col(lang_col).cast("string").alias("_l")).filter(
        ~held_out(F.col("_id")) & F.col("_id").isNotNull() & F.col("_l").isNotNull()
        & (F.char_length("_t") <= TRAIN_CHARS))
    first = Window.partitionBy("_l").orderBy(F.xxhash64("_id"), "_id")
    # the limit reaches the map side, so a language with most of the rows is no hot group
    chosen = rows.select("_id", "_l").withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= train_docs)
    ids = [r["_id"] for r in chosen.select("_id").collect()]
    if not ids:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((0, 0)))
    sample = rows.filter(F.col("_id").isin(ids)).select("_l", "_t", "_id").collect()
    return train([(r["_l"], r["_t"]) for r in sorted(sample, key=lambda r: (r["_id"], r["_l"], r["_t"]))])


SCHEMA = "lang string, score double, runs array<struct<first_word:int,last_word:int,lang:string>>"
_RUN = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string())])


def language_id(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out_col``: language, score and the runs of words of one language.

    Word numbers count white-space separated words from 0. All columns stay; the caller picks an
    ``out_col`` that ``docs`` lacks. No shuffle.
    """
    state: list[Labeller] = []

    def label(texts: pa.Array) -> pa.Array:
        if not state:  # once per Python worker
            state.append(Labeller(model))
        rows = []
        for a, b in slices(texts, 1 << 20):
            some = text_list(texts, a, b)
            rows += state[0](some) if model.labels else [(UNKNOWN, 0.0, [])] * len(some)
        columns = list(zip(*rows, strict=True)) if rows else [()] * 3
        kinds = (pa.string(), pa.float64(), pa.list_(_RUN))
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          ["lang", "score", "runs"])

    return docs.withColumn(out_col, struct_udf(label, SCHEMA)(F.col(text_col).cast("string")))


def language_digest(docs: DataFrame) -> DataFrame:
    model = fit(docs)
    labelled = language_id(docs.select("doc_id", "text"), model, out_col="language")
    return labelled.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                           F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
