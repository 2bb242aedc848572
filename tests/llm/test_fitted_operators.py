"""Pattern packing, source divergence and conversation repair."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import conversation_repair as R
from tidewater.llm import pattern_packing as P
from tidewater.llm import queries as QS
from tidewater.llm import source_divergence as D

from .cases import no_documents, odd_documents, odd_texts, words

WORDS = QS.tokenizer_path("word_bpe_49k.json")


# ---------------------------------------------------------------- pattern packing

def _plan_holds(counts: np.ndarray) -> int:
    """Checks a plan against its histogram; returns its sequences."""
    plan, held = P.plan_sequences(counts), Counter()
    for n, parts in plan:
        assert n > 0 and sum(length * k for length, k in parts) <= len(counts) - 1
        for length, k in parts:
            held[length] += n * k
    assert held == Counter({i: int(c) for i, c in enumerate(counts) if c})
    return sum(n for n, _ in plan)


@pytest.mark.parametrize(("seed", "low", "high"), [(1, 1, 256), (2, 1, 40), (3, 60, 250), (4, 129, 256), (5, 7, 8)])
def test_plan_holds_every_piece_in_few_sequences(seed, low, high):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(low, high, 20_000), minlength=257)
    used, long = _plan_holds(counts), int(counts[129:].sum())
    bound = max(-(-int((counts * np.arange(257)).sum()) // 256), long)
    assert used <= 1.03 * bound if low != 60 else used <= 1.08 * bound


def test_plan_of_odd_histograms():
    assert P.plan_sequences(np.zeros(17, np.int64)) == []
    for counts in ({16: 5}, {1: 1}, {9: 3}, {8: 3}, {5: 7, 11: 7}, {1: 40}, {3: 1, 13: 1, 16: 2}, {6: 1_000_000_000, 10: 1_000_000_001}):
        table = np.zeros(17, np.int64)
        for length, n in counts.items():
            table[length] = n
        used = _plan_holds(table)
        assert used >= -(-sum(length * n for length, n in counts.items()) // 16)
        if counts in ({5: 7, 11: 7}, {3: 1, 13: 1, 16: 2}):
            assert used * 16 == sum(length * n for length, n in counts.items())


def test_fit_repeats_patterns_that_make_up_the_histogram():
    counts = np.zeros(101, np.int64)
    counts[[70, 30]] = 500
    counts[[55, 25, 20]] = 300
    patterns, x = P.fit_patterns(counts)
    assert (patterns.sum(1) == 100).all() and (x > 0).all()
    made = np.bincount(patterns.ravel(), weights=np.repeat(x, 4), minlength=101)
    assert np.abs(made[1:] - counts[1:]).max() < 5


def _packed(rows, max_len):
    """Pieces by document and filled places by sequence; fails on gaps, overlaps and too long sequences."""
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= max_len
    return len(at)


@pytest.mark.parametrize("max_len", [64, 2048])
def test_packing_covers_every_id_once(spark, max_len):
    from tokenizers import Tokenizer
    docs = odd_documents(spark).repartition(3)
    rows = P.pack_patterns(docs, WORDS, max_len=max_len).collect()
    encode = Tokenizer.from_file(WORDS).encode
    want = Counter()
    for d in docs.select("doc_id", "text").collect():
        ids = [*encode(d["text"] or "", add_special_tokens=False).ids, P.END_ID]
        for i in range(0, len(ids), max_len):
            want[d["doc_id"], i // max_len, i, np.array(ids[i:i + max_len], "<u4").tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in rows) == want
    total = sum(r["length"] for r in rows)
    assert _packed(rows, max_len) <= 1.1 * -(-total // max_len) + 1
    assert P.pack_patterns(no_documents(spark), WORDS).collect() == []


def test_packing_with_one_length_for_a_third_of_the_pieces(spark):
    texts = [" ".join(words(i, 300 if i % 3 else 40)) if i % 3 != 1 else "same words here" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    rows = P.pack_patterns(docs, WORDS, max_len=512, ids=False).collect()
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows) and {r["doc_id"] for r in rows} == set(range(600))
    assert _packed(rows, 512) <= 1.05 * -(-sum(r["length"] for r in rows) // 512) + 1


def test_word_encoder_equals_whole_texts(monkeypatch):
    texts = [t or "" for t in odd_texts()] + ["L'été déjà-vu I'll don't 12345 x_y <|startoftext|> ok", "ΌΣΟΣ ΟΔΟΣ. İstanbul ŒUVRE", "á é́"]
    encoder = P.WordEncoder(WORDS)
    for _ in range(2):
        assert encoder(texts) == [encoder._encode([t])[0] for t in texts]
    monkeypatch.setattr(P, "CACHE_WORDS", 10)
    assert encoder(texts) == [encoder._encode([t])[0] for t in texts]


# ---------------------------------------------------------------- source divergence

def _plain_divergence(rows, min_docs=3, top=200):
    fold = {i: i + 32 for i in range(65, 91)}
    term = lambda c: ord(c) >= 128 or "a" <= c <= "z"
    count, docs, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        groups.add((lang, source))
        found = "".join(c if term(c) else " " for c in text.translate(fold)).split(" ")
        count.update((lang, source, t) for t in found if t)
        docs.update({(lang, t) for t in found if t})
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= min_docs:
            kept[lang].append(t)
    out = set()
    for lang in {g[0] for g in groups}:
        terms, sources = kept[lang], sorted(s for la, s in groups if la == lang)
        table = {s: {t: count[lang, s, t] for t in terms} for s in sources}
        table[None] = {t: sum(table[s][t] for s in sources) for t in terms}
        p = {s: {t: 1 + 10**9 * (c + 1) // (sum(cs.values()) + len(terms)) for t, c in cs.items()} for s, cs in table.items()}
        for s in sources:
            f = lambda t, o: (p[s][t] - p[o][t]) ** 2 // p[o][t]
            pair = sorted(((sum(f(t, o) for t in terms), o) for o in sources if o != s), key=lambda x: (-x[0], x[1].encode()))
            hits = sorted(((f(t, None), t) for t in terms if table[s][t] and p[s][t] > p[None][t]), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "pair", o, v, i) for i, (v, o) in enumerate(pair, 1)}
            out |= {(lang, s, "term", t, v, i) for i, (v, t) in enumerate(hits[:top], 1)}
    return out


def _divergence_rows(spark, n=160, seed=3):
    rng = random.Random(seed)
    letters = ["a", "b", "É", "ß", "K", "z", "ж", "𝒳", "c"]
    make = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 3)))
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None, "é"]),
             rng.choice([" ", ", ", "1", "\x7f", "-\n"]).join(make() for _ in range(rng.randint(0, 40)))) for _ in range(n)]
    rows += [("lonely", "x", "one two"), ("void", "x", None), ("void", "y", "..."), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("top", [200, 7])
def test_divergence_equals_the_plain_count(spark, monkeypatch, top):
    rows = _divergence_rows(spark)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, value long, rank long").repartition(5)
    got = {tuple(r) for r in D.source_divergence(docs, top=top).collect()}
    assert got == _plain_divergence(rows, top=top)


def test_divergence_in_small_steps_and_of_nothing(spark, monkeypatch):
    text = "Abc déf " * 50 + "x" * 300
    monkeypatch.setattr(D, "SPLIT_BYTES", 16)
    assert [w for part in D._words(text.encode()) for w in part] == [w.encode() for w in text.lower().split()]
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert D.source_divergence(empty).collect() == []


def test_divergence_with_few_table_entries(spark, monkeypatch):
    monkeypatch.setattr(D, "TABLE_ENTRIES", 5)
    rows = _divergence_rows(spark, 40, 9)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    assert {tuple(r) for r in D.source_divergence(docs).collect()} == _plain_divergence(rows)


# ---------------------------------------------------------------- conversation repair

def _all_repairs(rows, most_inserts=2):
    """Every edit string of a few rows with its cost, by trying all."""
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product(range(most_inserts + 1), repeat=len(rows) + 1):
            state, cost, audit, ok = R.START, 0, "", True
            for i in range(len(rows) + 1):
                for _ in range(gaps[i]):
                    state, cost, audit = R.NEXT[state], cost + 2, audit + "I"
                if i == len(rows):
                    break
                initial, fault, e = *rows[i], edits[i]
                audit += e
                if e == "D":
                    cost += 3
                    continue
                cost += (fault == "truncated") + (2 if e == "R" else 0)
                if fault in ("blank", "duplicate"):
                    ok = False
                elif e == "R":
                    state = R.NEXT[state]
                elif initial == "s" and state == R.START:
                    state = R.SYSTEM
                elif initial == R.ROLE_OF[R.NEXT[state]][0]:
                    state = R.NEXT[state]
                else:
                    ok = False
                if not ok:
                    break
            if ok and state in (R.START, R.ASSISTANT) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


SYMBOL = {"": 0, "truncated": 1}


def _string(rows):
    return bytes(R.GONE if f in ("blank", "duplicate") else 2 * "sua".find(i) + SYMBOL[f] if i in "sua" else 6 + SYMBOL[f] for i, f in rows)


def test_cheapest_repairs_equal_all_repairs_tried():
    rng = random.Random(5)
    cases = [[]] + [[(rng.choice("suax"), rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randint(1, 4))] for _ in range(150)]
    grammar = R.Grammar(sorted({_string(c) for c in cases}))
    for rows in cases:
        assert R.cheapest(grammar.carry(R.opening(), _string(rows))) == _all_repairs(rows)


def _row_by_row(string):
    costs = R.opening()
    for s in string:
        costs = R.product([costs], R.symbol_matrix(s))[0]
    return R.cheapest(costs)


def test_grammar_gives_what_single_rows_give():
    rng = random.Random(6)
    base = bytes(rng.randrange(9) for _ in range(60))
    strings = sorted({bytes(rng.randrange(9) for _ in range(rng.randint(0, 300))) for _ in range(20)} | {base * 40, b"\x02\x04" * 500, b"\x08" * 333})
    grammar = R.Grammar(strings)
    assert len(grammar.compressed[b"\x02\x04" * 500]) < 12
    for s in strings:
        assert R.cheapest(grammar.carry(R.opening(), s)) == _row_by_row(s)


def test_re_pair_keeps_the_strings():
    rng = random.Random(7)
    strings = [bytes(rng.randrange(3) for _ in range(rng.randint(0, 80))) for _ in range(60)] + [b"\0" * 97, b"", b"\1"]
    rules, out = R.re_pair(strings, 9)

    def expand(symbol):
        return bytes([symbol]) if symbol < 9 else expand(rules[symbol - 9][0]) + expand(rules[symbol - 9][1])
    assert [b"".join(map(expand, s)) for s in out] == strings
    assert sum(map(len, out)) < sum(map(len, strings)) / 2
    pairs = Counter(p for s in out for p in zip(s, s[1:], strict=False) if p[0] != p[1])
    assert not pairs or max(pairs.values()) < 2


def test_ropes_compare_like_strings():
    rng = random.Random(8)
    ropes = [R.Rope("")]
    for _ in range(200):
        ropes.append(R.joined(rng.choice(ropes), rng.choice([*ropes[-4:], R.Rope(rng.choice("DIKR") * rng.randint(1, 60))])))
        if ropes[-1].size > 5000:
            ropes.append(R.Rope("K"))
    for a in ropes[::3]:
        for b in ropes[::7]:
            assert R.less(a, b) == (str(a) < str(b))


def _plain_repair(rows, damage):
    """(conv_id -> result) in plain Python, one conversation after the other."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        by_conv[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, found in by_conv.items():
        mark = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), mark(r)))
        seen, faults = set(), []
        for _, role, text in found:
            stripped = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in found]
        cost, audit = _row_by_row(_string(list(zip([i or "x" for i in initials], faults, strict=True))))
        lines, left, state = [], iter(found), R.START
        for e in audit:
            row = None if e == "I" else next(left)
            if e == "D":
                continue
            state = R.SYSTEM if e == "K" and row[1][:1] == "s" else R.NEXT[state]
            lines.append(f"{R.ROLE_OF.get(state) if e != 'K' else row[1]}:{row[2] if row else ''}")
        turns = [r[0] for r in found if r[0] is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string, audit string, kind int, mark string, copies int"


def _conversations():
    rng = random.Random(9)
    texts = ["Yes.", "no", "", " \n", None, "What?", "Done!\t ", "a. b", "é…", "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "User"]
    rows = [(conv, t if rng.random() < .9 else None, rng.choice(roles), rng.choice(texts)) for conv in range(60)
            for t in rng.choices(range(12), k=rng.randint(1, 9))]
    rows += rows[:20] + [(None, 1, "user", "x."), (None, None, "assistant", "y.")] * 2
    rows += [(999, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(2500)] + [(998, 5, "user", "long " * 50_000 + ".")]
    return rows


@pytest.mark.parametrize(("damage", "held"), [(True, 400_000), (False, 400_000), (True, 150)])
def test_repair_equals_the_plain_one(spark, monkeypatch, damage, held):
    monkeypatch.setattr(R, "GRAMMAR_SYMBOLS", held)
    rows = _conversations()
    df = spark.createDataFrame([(*r, "x", 7, "m", 3) for r in rows], CONVERSATIONS).repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repair_conversations(df, damage=damage).collect()}
    assert got == _plain_repair(rows, damage)


def test_repair_of_nothing_and_of_dropped_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair_conversations(empty, damage=True).collect() == []
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    one = spark.createDataFrame([(conv, 1, "user", "gone.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in R.repair_conversations(one, damage=True).collect()] == \
        [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_damage_is_the_stated_one(spark):
    rows = [(c, t, "assistant", "One. Two? Three!") for c in range(20) for t in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in R.damaged(df).withColumn("kind", F.crc32(F.concat_ws(":", "conv_id", "turn")) % 20).collect():
        assert r["copies"] == {0: 0, 3: 2}.get(r["kind"], 1)
        assert r["role"] == ("user" if r["kind"] == 4 else "assistant")
        assert r["text"] == {1: "", 2: "One Two Three"}.get(r["kind"], "One. Two? Three!")
