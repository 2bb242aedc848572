"""Operators that bring rows together: dedup of three kinds, mixing, packing, chat, the pipeline."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import chat_format as C
from tidewater.llm import exact_dedup as X
from tidewater.llm import near_dedup as N
from tidewater.llm import packing as P
from tidewater.llm import queries as QS
from tidewater.llm import repeats as R
from tidewater.llm import source_mix as M
from tidewater.llm import words as W

from .cases import no_documents, odd_documents, words

SF = "/root/testdata/sf0.001"
BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def docs_frame(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts, strict=True)), "doc_id long, text string")


# ---------------------------------------------------------------- word hashes

def test_word_hashes_follow_the_words(monkeypatch):
    text = "  ".join(words(1, 3000)) + "\n\tdé ß  " + "q" * 500 + " end"
    raw = text.encode()
    whole = W.word_hashes(raw)
    assert len(whole) == len(raw.split())
    assert len(set(whole.tolist())) == len(set(raw.split()))
    monkeypatch.setattr(W, "BLOCK_BYTES", 97)
    assert (W.word_hashes(raw) == whole).all()
    flat, counts = W.batch_hashes([text, "", " ", "a b"])
    assert counts.tolist() == [len(whole), 0, 0, 2] and (flat[:-2] == whole).all()


@pytest.mark.parametrize("size", [1, 2, 5, 12, 50])
def test_window_hashes_are_equal_where_windows_are(size):
    ws = words(2, 2000, size=3)
    h = W.word_hashes(" ".join(ws).encode())
    seen = {}
    for i, g in enumerate(W.window_hashes(h, size).tolist()):
        assert seen.setdefault(tuple(ws[i:i + size]), g) == g
    assert len(set(seen.values())) == len(seen)


# ---------------------------------------------------------------- exact dedup

def plain_exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[BLANKS.sub(" ", text or "")].append(doc)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        stays = iter([True])
        for i in ids:
            out.append((i, keep, len(ids), i == keep and next(stays, False), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup_matches_a_plain_version(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in X.exact_dedup(docs).collect())
    assert got == plain_exact(rows)
    kept = X.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k in got.elements() if k[3])
    assert X.exact_dedup(no_documents(spark)).count() == 0


def test_exact_dedup_splits_a_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same  text").otherwise(
        F.concat(F.lit("own "), F.col("id"))).alias("text"))
    sizes = [r["count"] for r in X._runs(docs.select(F.col("doc_id").alias("_id"), X.normalised(F.col("text")).alias("_norm")))
             .withColumn("p", F.spark_partition_id()).filter("_norm = 'same text'").groupBy("p").count().collect()]
    assert len(sizes) >= 2 and max(sizes) < 900
    got = X.exact_dedup(docs).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in got} == {True: 2001, False: 999}


# ---------------------------------------------------------------- near dedup

def shingle_set(text):
    ws = (text or "").encode().split()
    return frozenset(zip(*(ws[k:] for k in range(5)), strict=False)) if len(ws) >= 5 else frozenset([tuple(ws)]) if ws else frozenset()


def plain_classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and both >= 0.8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def near_texts():
    rng = random.Random(9)
    base = words(7, 200, 5000)
    texts = []
    for n in range(60):  # near copies of one text, each with a change of its own
        t = list(base)
        for _ in range(rng.choice((1, 1, 2, 4, 8))):
            t[rng.randrange(len(t))] = f"x{n}"
        texts.append(" ".join(t))
    common = words(8, 60, 5000)
    texts += [" ".join(common + words(100 + n, 70, 5000)) for n in range(40)]  # one passage, different texts
    texts += [" ".join(base)] * 5 + ["", None, " ", "a b", "a b", "a  b\n", "a c"]
    return texts


def test_near_classes_match_brute_force(spark):
    texts = near_texts()
    got = {r.doc_id: r.class_id for r in N.near_classes(docs_frame(spark, texts)).collect()}
    assert got == plain_classes(enumerate(texts))


def test_near_links_inside_large_template_families_are_found(spark):
    texts, want = [], {}
    for f in range(4):  # 0.70 to each other, but two of them 0.806
        passage = [f"f{f}p{i}" for i in range(1004)]
        for n in range(400):
            doc = len(texts)
            own = 120 if n in (250, 333) else 214
            texts.append(" ".join(passage + [f"d{doc}w{k}" for k in range(own)]))
            want[doc] = doc - 83 if n == 333 else doc
    got = {r.doc_id: r.class_id for r in N.near_classes(docs_frame(spark, texts).repartition(8)).collect()}
    assert got == want


def test_prefix_pairs_hold_every_pair_at_the_threshold(spark):
    rng = random.Random(5)
    sets = [frozenset(rng.sample(range(60), 60 - rng.choice((4, 5, 6, 7, 8, 20)))) for _ in range(120)]
    label = [i if i % 4 else 0 for i in range(len(sets))]
    rest = spark.createDataFrame([(i, label[i], sorted(s)) for i, s in enumerate(sets)], "doc_id long, label long, sh array<long>")
    got = {(r.a, r.b) for r in N.prefix_pairs(rest, 0.8).collect()}
    near = {(a, b) for b, a in itertools.combinations(range(len(sets)), 2)
            if label[a] != label[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert near and near <= got and all(label[a] != label[b] for a, b in got)


def near_pairs(docs, threshold):
    return {(a, b) for b, a in itertools.combinations(sorted(docs), 2) if docs[a][0] != docs[b][0]
            and len(docs[a][1] & docs[b][1]) >= threshold * len(docs[a][1] | docs[b][1])}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_prefix_pairs_of_all_lengths_are_exact(spark, threshold):
    rng = random.Random(11)
    docs = {}
    for i in range(160):
        base = range(rng.choice((1, 4, 5, 20, 45, 90)))
        kept = rng.sample(base, max(1, round(len(base) * rng.choice((1, 1, 0.9, 0.8, 0.6)))))
        docs[i] = (rng.randrange(40), frozenset(kept) | {1000 * i + k for k in range(rng.choice((0, 0, 1, 4, 12)))})
    rest = spark.createDataFrame([(i, l, sorted(s)) for i, (l, s) in docs.items()], "doc_id long, label long, sh array<long>")
    got = {(r.a, r.b) for r in N.prefix_pairs(rest, threshold).collect()}
    want = near_pairs(docs, threshold)
    assert want and want <= got and all(docs[a][0] != docs[b][0] for a, b in got)


def test_prefix_join_takes_no_document_out_of_reach(spark, monkeypatch):
    # a component of near copies and documents with a fifth of shingles of their own: too many to reach a copy
    rng = random.Random(3)
    docs = {i: (0, frozenset(range(100)) - {rng.randrange(100)}) for i in range(60)}
    docs |= {i: (i, frozenset(range(80)) | {1000 * i + k for k in range(20)}) for i in range(100, 220)}
    docs |= {1000: (1000, frozenset(range(85)) | {7}), 2000: (2000, frozenset(range(30)) | {-1})}
    rest = spark.createDataFrame([(i, l, sorted(s)) for i, (l, s) in docs.items()], "doc_id long, label long, sh array<long>")
    made, stored = {}, N.stored
    monkeypatch.setattr(N, "stored", lambda df, name: made.setdefault(name, stored(df, name)))
    got = {(r.a, r.b) for r in N.prefix_pairs(rest, 0.8).collect()}
    assert near_pairs(docs, 0.8) <= got and (1000, 5) in got
    assert {r.doc_id for r in made["near-heads"].collect()} <= {*range(60), 1000}


def test_prefix_join_orders_no_shingles_of_the_largest_component(spark, monkeypatch):
    # a hundred near copies and twelve documents of other components: the copies' shingles are only looked up
    rng = random.Random(8)
    docs = {i: (0, frozenset(range(200)) - set(rng.sample(range(200), rng.randrange(1, 9)))) for i in range(100)}
    docs |= {i: (i, frozenset(rng.sample(range(200), 165)) | {1000 * i + k for k in range(20)}) for i in range(100, 110)}
    docs |= {i: (i, frozenset(range(i - 500, 190)) | {-i}) for i in (510, 520)}
    rest = spark.createDataFrame([(i, l, sorted(s)) for i, (l, s) in docs.items()], "doc_id long, label long, sh array<long>")
    made, stored = {}, N.stored
    monkeypatch.setattr(N, "stored", lambda df, name: made.setdefault(name, stored(df, name)))
    got = {(r.a, r.b) for r in N.prefix_pairs(rest, 0.8).collect()}
    want = near_pairs(docs, 0.8)
    assert len(want) > 100 and want <= got
    others, largest = made["near-heads"].collect(), made["near-heads-largest"].collect()
    assert others and all(r.label for r in others) and not any(r.label for r in largest)
    assert {r.token for r in largest} <= {r.token for r in others}


def test_near_classes_of_the_table_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.class_id for r in N.near_classes(docs).collect()}
    assert got == plain_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_near_dedup_takes_odd_rows(spark):
    docs = odd_documents(spark)
    known = docs.filter("doc_id is not null")
    kept = N.near_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = plain_classes([(r.doc_id, r.text) for r in known.collect()])
    assert {i for i in ids if i is not None} == set(want.values()) and ids.count(None) == 2
    assert N.near_classes(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        N.near_classes(docs, weights="other")


@pytest.mark.parametrize(("a", "b"), [(1.0, 1.0), (2.5, 1.5), (0.3, 0.2), (4.0, 1.0)])
def test_dart_signatures_estimate_weighted_jaccard(a, b):
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 2 ** 62, 300).astype(np.uint64), rng.integers(0, 2 ** 62, 60).astype(np.uint64)
    doc = np.repeat([0, 1], [360, 300])
    sig = N.dart_signatures(doc, np.r_[shared, own, shared], np.r_[np.full(360, a), np.full(300, b)], 2, 1024)
    want = 300 * min(a, b) / (300 * max(a, b) + 60 * a)
    assert np.isfinite(sig).all() and abs((sig[0] == sig[1]).mean() - want) < 0.06


def test_signatures_do_not_depend_on_the_batch():
    texts = near_texts()[:20]
    doc, sh, n = N.shingles(texts)
    whole = N.dart_signatures(doc, sh, np.ones(len(sh)), len(texts), 64)
    for k, t in enumerate(texts):
        d, s, _ = N.shingles([t])
        assert (N.dart_signatures(d, s, np.ones(len(s)), 1, 64)[0] == whole[k]).all()


# ---------------------------------------------------------------- substring dedup

def plain_repeats(rows, window=50):
    first = {}
    for doc, text in rows:
        ws = (text or "").encode().split()
        for i in range(len(ws) - window + 1):
            g = tuple(ws[i:i + window])
            first[g] = min(first.get(g, doc), doc)
    out = {}
    for doc, text in rows:
        ws = (text or "").encode().split()
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < doc:
                gone[i:i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out[doc] = (len(ws), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def repeat_texts():
    rng = random.Random(4)
    passages = [words(50 + n, rng.randrange(45, 130), 300) for n in range(6)]
    texts = []
    for n in range(60):
        t = words(200 + n, rng.randrange(0, 90), 4)
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 20)
            t += p[a:len(p) - rng.randrange(0, 20)] + words(rng.randrange(10_000), rng.randrange(0, 30))
        texts.append(" ".join(t))
    texts += [" ".join(["again"] * 130), " ".join(["again"] * 49), " ".join(["again"] * 50), None, "", texts[3], texts[3]]
    return texts


def test_repeats_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_TEXT", 4000)  # several blocks
    texts = repeat_texts()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    docs = docs_frame(spark, texts, ids)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in R.repeat_digest(docs).collect()}
    assert got == plain_repeats(list(zip(ids, texts, strict=True)))


def test_repeats_take_odd_rows(spark):
    docs = odd_documents(spark)
    got = R.drop_repeats(docs).collect()
    assert len(got) == docs.count()
    rows = [(r.doc_id, r.text) for r in docs.dropDuplicates(["doc_id", "text"]).collect() if r.doc_id is not None]
    want = plain_repeats(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed) == want[r.doc_id][:2]
            assert sum(x.end - x.start for x in r.removed) == r.n_removed
    assert R.drop_repeats(no_documents(spark)).count() == 0


# ---------------------------------------------------------------- mixing

@pytest.mark.parametrize("seed", range(8))
def test_mix_timetable_stays_within_one_block(seed):
    rng = random.Random(seed)
    blocks = {f"s{i}": rng.choice([0, 1, 2, 5, 50, 400, 2000]) for i in range(rng.randint(1, 9))}
    weights = {s: rng.choice([0.1, 1, 2, 7, 30]) for s in blocks}
    plan = M.phases(blocks, weights, rng.choice([16, 64, 1024]))
    slots = {}
    for r in plan:
        for b in range(r["first"], r["last"]):
            k = b - r["first"]
            slots[r["slot0"] + k // r["quota"] * r["period"] + r["slots"][k % r["quota"]]] = (r["source"], b)
    assert sorted(slots) == list(range(sum(blocks.values())))
    starts = sorted({r["slot0"] for r in plan}) + [len(slots)]
    for a, end in zip(starts, starts[1:], strict=False):
        quota = {r["source"]: (r["quota"], r["period"]) for r in plan if r["slot0"] == a}
        sent = dict.fromkeys(quota, 0)
        for t in range(a, end):
            sent[slots[t][0]] += 1
            assert all(abs(sent[s] - (t - a + 1) * q / p) < 1 for s, (q, p) in quota.items())


@pytest.mark.parametrize("weights", [{"a": 130_000 ** 0.5, "b": 50_000 ** 0.5, "c": 20_000 ** 0.5},
                                     {"a": 1.0, "b": 0.0001, "c": 0.3}, {"a": 3.0, "b": 1.0, "c": 1.0}])
def test_mix_keeps_to_the_target_weights_on_every_prefix(weights):
    plan = M.phases({"a": 130_000, "b": 50_000, "c": 20_000}, weights)
    order = sorted((t, r["source"]) for r in plan if r["slot0"] == 0 for t in r["slots"])
    total = sum(weights.values())
    assert len(order) > 20_000 and [t for t, _ in order] == list(range(len(order)))
    sent = dict.fromkeys(weights, 0)
    for t, s in order:
        sent[s] += 1
        assert all(abs(sent[x] - (t + 1) * w / total) < 1.001 for x, w in weights.items())


def test_mix_places_every_row_in_its_window(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.lit("t").alias("text"))
    rows = M.mix_places(docs, {"hot": 3.0, "s1": 1.0}, block=4, period=64).collect()
    assert sorted(r.doc_id for r in rows) == list(range(5000))
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert len({r.position for r in rows}) == 5000
    per = defaultdict(set)
    for r in rows:
        per[r.source, r.block].add(r.slot)
    assert all(len(s) == 1 for s in per.values())
    mixed = M.mix_sources(docs, {"hot": 3.0, "s1": 1.0}, block=4, period=64)
    assert mixed.columns == docs.columns
    order = {r.doc_id: r.position for r in rows}
    got = [order[r.doc_id] for r in mixed.collect()]
    assert got == sorted(got)


def test_mix_takes_odd_rows(spark):
    docs = odd_documents(spark)
    mixed = M.mix_sources(docs)
    assert mixed.columns == docs.columns and mixed.count() == docs.count()
    assert M.mix_places(no_documents(spark)).count() == 0 == M.mix_sources(no_documents(spark)).count()
    assert M.mix_sources(docs, {"a": 0.0, "": 2.0}).count() == docs.count()


# ---------------------------------------------------------------- packing

def plain_ids(text):
    from tokenizers import Tokenizer
    global _tokenizer
    _tokenizer = globals().get("_tokenizer") or Tokenizer.from_file(QS.tokenizer_path())
    return _tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(docs, pieces):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(plain_ids(r.text))
    assert set(by_doc) == set(want)
    for doc, lists in want.items():
        if len(lists) > 1:
            assert sum(p.length for p in by_doc[doc]) == sum(map(len, lists))
            continue
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(lists[0])
            raw = np.array(lists[0][p.start:p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(raw)
            at += p.length
        assert at == len(lists[0])
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0  # no padding at all


def test_packing_covers_every_id_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    docs = docs.persist()
    check_pieces(docs, P.packed_pieces(docs, QS.tokenizer_path()).collect())


def test_packing_takes_odd_rows(spark):
    docs = odd_documents(spark)
    check_pieces(docs, P.packed_pieces(docs, QS.tokenizer_path()).collect())
    assert P.packed_pieces(no_documents(spark), QS.tokenizer_path()).count() == 0


def test_small_pools_still_fill_windows(monkeypatch):
    monkeypatch.setattr(P, "POOL_IDS", 5000)
    packer = P.Packer(2, P.TIERS)
    rng = random.Random(3)
    total = 0
    for doc in range(400):
        n = rng.choice([1, 3, 40, 127, 128, 700, 2048, 5000])
        total += n
        packer.add(doc, np.arange(n, dtype="<u4"))
        if packer.pool.ids > P.POOL_IDS:
            packer.close(P.POOL_IDS // 2)
    packer.close(0)
    sizes = Counter()
    for row in packer.rows:
        sizes[row[4]] += row[2]
    assert sum(sizes.values()) == total and all(n & (n - 1) == 0 and n <= 2048 for n in sizes.values())
    groups = Counter()
    for row in packer.rows:
        groups[row[7]] += row[2]
    full = [n for n in groups.values()]
    assert max(full) <= P.STEP_IDS


def test_encoder_equals_the_tokenizer():
    encode = P.Encoder(QS.tokenizer_path())
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "É", "ß", "1", "²", "_", "'s", "'", ",", ".", "!!", "<|endoftext|>", "\xa0", "\x1c",
            "\x85", "中", "word", "Ⅷ", "×", "-", "​", "　", "don't", "😀", "é"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(9))) for _ in range(4000)]
    for t, raw in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == plain_ids(t)[:-1]


def test_words_met_once_are_forgotten_and_others_stay(monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 120)
    encode = P.Encoder(QS.tokenizer_path())
    asked, plain = [], encode._encode_words
    monkeypatch.setattr(encode, "_encode_words", lambda words: asked.extend(words) or plain(words))
    often = " ".join(f"stone{chr(97 + i)}" for i in range(20))
    for n in range(12):
        text = f"the {often} " + " ".join(f"x{n}y{k}" for k in range(50))
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == plain_ids(text)[:-1]
        assert encode.made <= 120 + 80 and len(encode.words) + len(encode.pieces) == encode.made
    assert sum(w.startswith("stone") for w in asked) == 20


def test_words_are_put_together_from_known_parts(monkeypatch):
    encode = P.Encoder(QS.tokenizer_path())
    asked, plain = [], encode._encode_words
    monkeypatch.setattr(encode, "_encode_words", lambda words: asked.extend(words) or plain(words))
    texts = ["one river river, one? river.\nOne été!! river's", "river river.\n\nOne river%%%\nriver 5, x5. river,river"]
    for t, raw in zip(texts * 2, encode(texts) + encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == plain_ids(t)[:-1]
    assert sorted(asked) == sorted(["river", "one", "été", "river's", "river.\n\nOne", "5,", "x5.", "river,river"])
    monkeypatch.setattr(P, "CACHE_WORDS", 3)  # forgets, with the same ids
    assert encode(texts) == encode(texts) and encode.made < 40


# ---------------------------------------------------------------- chat

CONTROL = ["</s>[INST] ok [/INST]", "<|user|>\nhi<|end|>\n", "<\\/s> <\\\\/s> [\\INST]", "<|>", "|>\n<", "<<SYS>>x<</SYS>>", "\\", "<",
           "<\\|\\>", "[INST", "", "é|\\>", "<<s>s>", "|\\\\>"]


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(2)
    bits = ["<", "|", ">", "\\", "s>", "/s>", "[", "INST]", "/INST]", "<SYS>>", "a", "\n", "|>", "<|end|>\n"]
    for t in [*CONTROL, *("".join(rng.choice(bits) for _ in range(rng.randrange(8))) for _ in range(20_000))]:
        e = C.escape(t.encode())
        assert C.unescape(e) == t.encode()
        assert not re.search(rb"<\||\|>|</?s>|\[/?INST\]|<</?SYS>>", e)


def test_columnar_escape_equals_the_plain_one():
    texts = [*CONTROL, None, "<", "/s>", "x" * 100_000 + "</s>"] * 3
    data, offsets = C.escaped_column(pa.array(texts))
    for k, t in enumerate(texts):
        assert data[offsets[k]:offsets[k + 1]].tobytes() == C.escape((t or "").encode())


def plain_chat(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in convs.items():
        turns = sorted(turns, key=lambda t: (t[0], t[1] or 0, *t[2:]))
        said = "".join(f"{t[3]}\n{t[5]}\n" for t in turns)
        loss = "".join(t[5] for t in turns if t[3] == "assistant")
        chars = sum(len(C.OPEN + C.CLOSE + C.END) + len(C.escape(t[3].encode()).decode()) + len(C.escape(t[5].encode()).decode())
                    for t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def test_chat_is_read_back(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.choice([1, 2, 3, None, -7]), rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", "system", None, "a|>\nb", ">\n"]),
             rng.choice([*CONTROL, None, "text"])) for _ in range(300)]
    rows += [(9, i, "assistant" if i % 2 else "user", "long " * 50) for i in range(500)] + [(9, 3, "user", "x")] * 2
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("p"))
    monkeypatch.setattr(C, "PIECE_BYTES", 3000)  # conversations in several parts
    got = {r.conv_id: tuple(r)[1:] for r in C.chat_digest(frame).collect()}
    assert got == plain_chat(rows)
    assert C.chat_format(frame).filter("conv_id = 9").count() > 3
    assert C.chat_digest(frame.limit(0)).count() == 0


# ---------------------------------------------------------------- registry and pipeline

def test_every_numbered_query_is_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "near dedup", "source mix", "packing"]


def test_oracle_statements_match(spark):
    import duckdb
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in E.oracle_sql().items():
        if re.match(r"op\d+_", name):
            df = E.queries()[name](spark, SF)
            got = sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())
            res = con.execute(sql)
            cols = [d[0] for d in res.description]
            order = sorted(range(len(cols)), key=cols.__getitem__)
            assert sorted(cols) == sorted(df.columns)
            assert got == sorted(tuple(str(r[k]) for k in order) for r in res.fetchall())


def test_pipeline_matches_a_plain_one(spark):
    from tidewater.llm.quality_rules import judge
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    clean = [(i, q[10]) for (i, t), q in zip(rows, judge([t or "" for _, t in rows]), strict=True) if q[9]]
    left = [(k[0], t) for i, t in clean for k in plain_exact(clean) if k[0] == i and k[3]]
    classes = plain_classes(left)
    stays = {i: t for i, t in left if classes[i] == i}
    pieces = corpus_pipeline.run(spark, SF).collect()
    totals = defaultdict(int)
    for p in pieces:
        totals[p.doc_id] += p.length
    assert dict(totals) == {i: len(plain_ids(t)) for i, t in stays.items()}


def test_pipeline_sequences_follow_the_mix(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "long").otherwise("short").alias("source"),
                                    F.expr("repeat('some words ', if(id < 3000, 120, 10))").alias("text"))
    docs = corpus_pipeline.stored(corpus_pipeline.mix(spark, docs, SF), "test-mix")
    first = defaultdict(lambda: 1 << 62)
    for p in corpus_pipeline.packing(spark, docs, SF).collect():
        first[p.doc_id] = min(first[p.doc_id], p.sequence_id)
    assert len(first) == 6000
    place = {r.doc_id: r.position for r in M.mix_places(docs).collect()}
    order = sorted(first, key=lambda d: (first[d], place[d]))
    for cut in range(750, 6000, 750):  # the shares are equal; a partition's pool may come out of turn
        assert abs(sum(d < 3000 for d in order[:cut]) / cut - 0.5) < 0.1
    drift = [abs(k - place[d]) for k, d in enumerate(order)]
    assert max(drift) < 1500


def test_pipeline_stages_take_odd_rows(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            docs = corpus_pipeline.stored(out, "test-stage")
