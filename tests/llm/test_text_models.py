"""Prefix trie, language-model scores and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from landflow.llm import maxent, queries, spelling, turntrie

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, d string, key int, `a.b` int"
DOCS = "doc_id long, text string, word string, n int, rid int"


# ---- prefix trie

def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            d = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[r[0]].append(((r[1] is not None, r[1] or 0), role, d, text))
    seq = {c: [(x[1], x[3]) for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in seq.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = seq.get(c - int(math.fmod(c, 100)), [])[:h] + t[h:]
    return out


def trie_by_hand(convs):
    members = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    saved, leaves = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += k not in kids
    ends = lambda k, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k)).encode()).hexdigest()
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], ends(k, m))
                   for k, m in members.items())


def trie(df, **how):
    got = turntrie.prefix_trie(turntrie.rebuilt(turntrie.sequences(df)), **how)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r) for r in got.collect())


def odd_turns():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"x{t}", "d", 1, 2) for c in range(100, 160) for t in range(4)]  # equal but for their heads
    rows += [(c, t, "user", f"{c % 7}.{t if t < 9 else c}", "d", 1, 2) for c in range(300, 360) for t in range(c % 13)]
    rows += [(700, t, "user", "é日" * (t % 3), "d", 1, 2) for t in range(300)] + [(701, t, "user", "é日" * (t % 3), "d", 1, 2) for t in range(200)]
    rows += [(900, None, None, None, "d", 1, 2), (900, 3, None, "", "d", 1, 2), (901, None, "user", None, None, None, None), (901, 1, "user", "z", "d", 1, 2),
             (901, 1, "user", "z", "d", 1, 2), (901, 1, "admin", "z", "d", 1, 2), (None, 1, "user", "lost", "d", 1, 2), (-5, 0, "user", "minus", "d", 1, 2),
             (1502, 0, "user", "headless", "d", 1, 2)]
    return rows


@pytest.mark.parametrize("how", [{}, {"batch": 3, "fan": 2, "range_bytes": 400}])
def test_trie(spark, how):
    rows = odd_turns()
    assert trie(spark.createDataFrame(rows, TURNS), **how) == trie_by_hand(rebuilt_by_hand(rows))


def test_trie_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert trie(df) == trie_by_hand(rebuilt_by_hand(rows))


def test_trie_of_nothing(spark):
    assert not trie(spark.createDataFrame([], TURNS))


def test_contract_closes_only_what_cannot_grow():
    key = lambda *turns: b"".join(bytes([t]) * turntrie.TURN for t in turns)
    items = [turntrie.Item(len(k), key(*k), [1] * len(k), 1, i) for i, k in enumerate([(1, 2, 3), (1, 2, 4), (1, 5, 1), (1, 5, 2), (1, 6, 6)])]
    nodes = turntrie.Nodes()
    strip = turntrie.contract(items, nodes)
    assert [x.depth for x in strip] == [3, 2, 1, 3]  # down to (1), then up
    assert sorted(r[1] for r in nodes.rows) == [2, 3, 3, 3]
    assert strip[2].children == 1 and strip[2].n == 2 and strip[2].leaves == 2


# ---- language model

def tokens(text):
    return [w.lower() for w in (text or "").encode().split()] + [maxent.END]


def trained(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 != 2


def check_base(rows, got):
    c = Counter(w for i, t in rows if trained(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter((i, not trained(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 3)) for i, t in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("known", [maxent.KNOWN, 40])
def test_base_scores(spark, docs, known):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check_base(rows, maxent.scored(docs, rounds=1, known=known).collect())


def test_odd_rows(spark):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, " \n\t"), (5, "A b C"), (5, "A b C"), (None, "é 日本 b"), (7, "w " * 3000), (12, "new words " * 9)]
    df = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], DOCS)
    check_base(rows, maxent.scored(df).collect())
    assert maxent.scored(df.limit(0)).count() == 0
    held = [i for i in range(100) if not trained(i)][:2]
    alone = spark.createDataFrame([(i, "never trained", "w", 1, 2) for i in held], DOCS)
    assert [r.train_tokens for r in maxent.scored(alone).collect()] == [0, 0]


def plain_log(m, c, words, cut=None):
    """Natural log of a text's probability, one token at a time."""
    total, p1, p2 = 0.0, 0, 0
    import xxhash
    for w in words:
        h = xxhash.xxh3_64_intdigest(w)
        t = maxent.Tokens(np.zeros(1, int), [np.array([p1], np.uint64), np.array([p2], np.uint64)], np.array([h], np.uint64), np.zeros(1, int), maxent.endings([w]))
        cls, slot, count, _ = (x[0] for x in m.read(t))
        f = maxent.features(t)
        z = m.class_bias.astype(float) + sum(m.weights[r[0]].astype(float) for r in maxent.rows(f))
        total += z[cls] - np.log(np.exp(z).sum())
        if slot >= 0:
            z = m.slot_bias[cls].astype(float) + sum(m.weights[r[0]].astype(float) for r in maxent.rows(f, np.array([cls])))
            total += z[slot] - np.log(np.exp(z).sum())
        else:
            total += np.log((c[w] + 1) / m.tail_mass[cls - maxent.HEADS])
        p1, p2 = h, p1
    return total


def test_scores_by_plain_sums(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    c = Counter(w for i, t in rows if trained(i) for w in tokens(t))
    texts = docs.where(~maxent.held_out(docs["doc_id"])).select("text")
    counts = maxent.materialize(maxent.word_counts(texts), "counts")
    m = maxent.fit(texts, counts, known=300)
    assert m.weights.any()
    got = {r.doc_id: r for r in maxent.score(docs, m, counts).collect()}
    few = [r for r in rows if len(tokens(r[1])) < 400][:40]
    assert len(few) == 40
    for i, t in few:
        assert got[i].score == pytest.approx(plain_log(m, c, tokens(t)) / math.log(10), rel=1e-4, abs=1e-3)
    # better than the unigram model on documents that it has not seen
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_is_a_distribution(spark, docs):
    texts = docs.where(~maxent.held_out(docs["doc_id"])).select("text")
    counts = maxent.materialize(maxent.word_counts(texts), "counts")
    m = maxent.fit(texts, counts, rounds=1)
    words = sorted({w for r in texts.collect() for w in tokens(r.text)})
    t = maxent.Tokens(np.zeros(len(words), int), [np.full(len(words), 5, np.uint64), np.full(len(words), 9, np.uint64)],
                      np.fromiter(map(maxent.xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), np.arange(len(words)), maxent.endings(words))
    p, _, known = maxent.log_probability(m, t)
    unseen = maxent.log_share(maxent.logits(m.weights, m.class_bias, maxent.rows(maxent.features(t)[:, :1])).repeat(maxent.TAILS, 0),
                              np.arange(maxent.TAILS) + maxent.HEADS) - np.log(m.tail_mass)
    assert known.all() and np.exp(p).sum() + np.exp(unseen).sum() == pytest.approx(1, abs=1e-4)


def test_logits_are_sums_of_rows():
    rng = np.random.default_rng(4)
    weights, where = rng.normal(size=(1 << maxent.ROW_BITS, maxent.WIDTH)).astype(np.float32), rng.integers(0, 1 << maxent.ROW_BITS, (3, 200)).astype(np.uint16)
    before = weights.copy()
    for bias in (np.full(maxent.WIDTH, -np.inf, np.float32), rng.normal(size=(200, maxent.WIDTH)).astype(np.float32)):
        assert np.array_equal(maxent.logits(weights, bias, where), bias + weights[where[0]] + weights[where[1]] + weights[where[2]])
    assert np.array_equal(weights, before)


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"word{i}" for i in range(500))
    whole = next(maxent.chunks([text]))
    monkeypatch.setattr(maxent, "PIECE", 100)
    monkeypatch.setattr(maxent, "CHUNK", 30)
    parts = list(maxent.chunks([text]))
    assert len(parts) > 5
    for k in (0, 1):
        assert np.array_equal(np.concatenate([p.before[k] for p in parts]), whole.before[k])
    assert np.array_equal(np.concatenate([p.unique[p.number] for p in parts]), whole.unique[whole.number])


# ---- spelling

def variants_by_hand(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    cut = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            cut[w[:i] + "\0" + w[i + 1:]].add(w)
            cut[w[:i] + w[i + 1:]].add(w)
        cut[w].add(w)
    near = defaultdict(set)
    for group in cut.values():
        for a in group:
            near[a] |= {b for b in group if spelling.one_edit(a, b)}
    form = {}
    for w, k in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * k:
            form[w] = best
    out = Counter()
    for w, k in n.items():
        root = w
        while root in form:
            root = form[root]
        out[(w, form.get(w), root, k, len(near[w]), n.get(form.get(w)))] += 1
    return out


def spelled(df, **how):
    got = spelling.variants(df, **how)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize("limit", [None, 40])
def test_spelling(spark, docs, limit):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = variants_by_hand(rows)
    assert any(k[1] for k in want) and spelled(docs, limit=limit) == want


@pytest.mark.parametrize("limit", [None, 5])
def test_spelling_odd(spark, limit):
    rng = np.random.default_rng(5)
    same = ["".join(rng.permutation(list("letters"))) for _ in range(80)]  # one path in the trie, many words
    chain = ["analyse", "analyze", "analyzed", "analyzedd"]
    rows = [(1, " ".join(same)), (2, " ".join(same)), (3, None), (4, ""), (None, "Éclairés éclairés ECLAIRES×÷ " * 3), (5, "short words only"),
            (6, " ".join(chain[0:1] * 2 + chain[1:2] * 20 + chain[2:3] * 200 + chain[3:] * 2000)), (6, "x" * 70 + " " + "x" * 71), (6, "x" * 70 + " " + "x" * 71),
            (7, "aaaaaaaaaaaaaaaaaaaaaaaaa aaaaaaaaaaaaaaaaaaaaaaaab " * 2), (8, "übermäßig ubermäßig übermäßigg übermässig " * 2)]
    df = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], DOCS)
    assert spelled(df, limit=limit) == variants_by_hand(rows)
    assert not spelled(df.limit(0))


def test_trie_reaches_every_near_path():
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("abcdeé"), rng.integers(7, 10))) for _ in range(2500)})
    path = spelling.paths(words)
    order = np.argsort(path, kind="stable")
    known = [words[k] for k in order]
    t = spelling.Trie(path[order])
    q, w = t.reached(path[:200])
    got = set(zip(q.tolist(), w.tolist()))
    want = {(i, j) for i in range(200) for j, b in enumerate(known) if spelling.one_edit(words[i], b)}
    assert want and want <= got
    i, j = np.array(sorted(got)).T
    ok = spelling.verified(spelling.Words(words[:200]), i, spelling.Words(known), j)
    assert set(zip(i[ok].tolist(), j[ok].tolist())) == want


def test_registered():
    assert {"op11_turn_trie", "op12_maxent", "op13_spelling_trie"} <= set(queries.QUERIES)
    assert {"op11_turn_trie", "op13_spelling_trie"} <= set(queries.ORACLE)
