"""Operators against brute force, on supplied tables and on odd rows."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landflow.llm import ann, mixing, neardup, packing, quality, queries, sharding, tokenbin, tokens, toxicity, urlfilter, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, score double, node string, h int"
ODD = [
    (1, "a b c d e f g h", "en", "s1"), (2, "a b c d e f g h", "en", "s1"), (3, None, "en", None), (4, "", None, "s1"),
    (5, " \n\t ", "de", "s2"), (6, "A B C D E F G H", "de", "s2"), (7, "one two", "de", "s2"), (7, "one two", "de", "s2"),
    (None, "é ß 日本 x", None, None), (9, "w " * 20000, "en", "s1"), (10, "x* #y\nx* #y\n\nx* #y", "en", "s1"),
    (11, " ".join(f"w{i}" for i in range(30000)), "en", "s1"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, a, s, 1, 2, "x", 0.5, "n", 3) for i, t, a, s in ODD], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def split(text):
    return (text or "").encode().split()


def shingle_set(text):
    w = [x.lower() for x in split(text)]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def check_components(rows, got):
    sets = [(r.doc_id, shingle_set(r.text)) for r in rows]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and min(len(a), len(b)) * 4 >= 3 * max(len(a), len(b)):
            n = len(a & b)
            if 100 * n >= 75 * (len(a) + len(b) - n):
                up[root(i)] = root(j)
    low = defaultdict(list)
    for i, (k, _) in enumerate(sets):
        low[root(i)].append(k)
    want = Counter()
    for i, (k, s) in enumerate(sets):
        c = min((x for x in low[root(i)] if x is not None), default=None)
        want[(k, len(s), c)] += 1
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_near_duplicates(docs, odd, empty):
    check_components(docs.collect(), neardup.near_duplicates(docs).collect())
    check_components(odd.collect(), neardup.near_duplicates(odd).collect())
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_crowded(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(int(rng.integers(0, 6))):
            own[int(rng.integers(0, 120))] = f"v{rng.integers(1e6)}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_components(df.collect(), neardup.near_duplicates(df).collect())


def template_families(n, same, other):
    """Two documents a family: 100 template words, ``same`` of the family, ``other`` of each document."""
    shared = [f"t{i}" for i in range(100)]
    return [(2 * f + k, " ".join([*shared, *[f"f{f}w{i}" for i in range(same)], *[f"f{f}c{k}x{i}" for i in range(other)]]))
            for f in range(n) for k in (0, 1)]


def test_near_duplicates_pairs_of_one_template(spark):
    """Pairs that meet only in crowded regions are compared."""
    for same, other in ((16, 11), (14, 17)):
        df = spark.createDataFrame(template_families(300, same, other), "doc_id long, text string")
        check_components(df.collect(), neardup.near_duplicates(df).collect())


def test_near_duplicates_settled_in_rounds(spark, monkeypatch):
    """Crowded regions are compared in all their orders, in rounds."""
    monkeypatch.setattr(neardup, "DEPTH", 1)
    rng = np.random.default_rng(5)
    shared, rows = [f"s{i}" for i in range(60)], []
    for base in range(12):
        own = [f"b{base}w{i}" for i in range(40)]
        for copy in range(3):
            words = shared + own
            for at in rng.integers(0, len(words), copy):
                words = [*words[:at], f"c{base}x{copy}", *words[at + 1:]]
            rows.append((3 * base + copy, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    settled = []
    deepen = neardup._deepen
    monkeypatch.setattr(neardup, "_deepen", lambda crowd, *rest: settled.append(crowd.count()) or deepen(crowd, *rest))
    check_components(rows := df.collect(), neardup.near_duplicates(df).collect())
    assert settled and settled[0] == len(rows)


def copies_of_one(n, words, edits, seed):
    """A text of ``words`` words, and ``n`` copies with that many words of their own at random places."""
    rng, text = np.random.default_rng(seed), [f"w{i}" for i in range(words)]
    rows = [" ".join(text)]
    for copy in range(n):
        own = list(text)
        for at in rng.choice(words // 5, edits, replace=False):
            own[5 * at + 2] = f"c{copy}x{at}"
        rows.append(" ".join(own))
    return rows


def test_near_duplicates_of_one_original_in_a_large_group(spark):
    """Copies that are links of their original only: each meets it, however many there are."""
    texts = copies_of_one(2500, 200, 5, 13)
    first = shingle_set(texts[0])
    assert all(100 * len(first & s) >= 75 * len(first | s) for s in map(shingle_set, texts))
    order = np.random.default_rng(2).permutation(len(texts))
    df = spark.createDataFrame([(int(i), texts[k]) for i, k in enumerate(order)], "doc_id long, text string")
    assert {r.component_id for r in neardup.near_duplicates(df).collect()} == {0}


def test_centres():
    """The centre of a component in a region is the row closest to its rows' majority."""
    sets = [neardup.shingles(t) for t in copies_of_one(40, 200, 3, 1)]
    sigs = np.stack([neardup.signature(s) for s in sets]).view(np.uint32).astype(np.uint8) & 15
    packed = np.ascontiguousarray(sigs[:, ::2] << 4 | sigs[:, 1::2]).view(np.uint64)
    for x, y in ((0, 1), (1, 2), (3, 40)):
        assert neardup._equal(packed[x:x + 1], packed[y:y + 1])[0] == (sigs[x] == sigs[y]).sum()
    half = np.stack([np.bitwise_or.reduce(neardup.bitmap(s)[0].reshape(2, -1)) for s in sets]).view(np.uint64)
    region, label, node = np.repeat([1, 2], [39, 2]), np.full(41, 7), np.arange(41)
    centre, size = neardup._centres(region, label, node, packed, half)
    assert centre.tolist() == [0] * 39 + [39, 40] and size.tolist() == [39] * 39 + [1, 1]


def test_bitmaps_bound_common_shingles():
    rng = np.random.default_rng(11)
    for size in (1, 40, 400, 4000):
        for share in (0.0, 0.5, 0.9, 1.0):
            a = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
            b = np.unique(np.concatenate([a[:int(share * len(a))], rng.integers(0, 1 << 64, size // 3, np.uint64)]))
            if not len(b):
                continue
            (x, p), (y, q) = neardup.bitmap(a), neardup.bitmap(b)
            shared = sum(int(v).bit_count() for v in (x & y).view(np.uint64))
            assert shared + min(p, q) >= len(np.intersect1d(a, b))


def test_pairs_under_the_threshold_meet_no_whole_sets(spark, monkeypatch):
    """A crowd of texts that share a passage, none of them links: whole sets are
    joined for few of its pairs."""
    made = {}
    whole = neardup.materialize

    def counted(df, name="stage"):
        out = whole(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(neardup, "materialize", counted)
    rows = [(i, " ".join([f"s{k}" for k in range(84)] + [f"t{i}x{k}" for k in range(25)])) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_components(rows := df.collect(), neardup.near_duplicates(df).collect())
    assert made["open"] == 150 and made["stars"] > 150
    assert made.get("pairs", 0) < 150 and made["near"] < 150


def test_more_links_join_components(spark, monkeypatch):
    """Links found later go through components as one node each, not through all links."""
    made = []
    whole = neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, name="stage": made.append((name, df.count())) or whole(df, name))
    old = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (7, 7), (11, 7)], "node long, label long")
    more = spark.createDataFrame([(2, 6), (3, 5), (8, 9), (1, 2), (9, 10), (0, 11)], "a long, b long")
    got = {tuple(r) for r in neardup.merged(old, more).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (5, 1), (6, 1), (7, 0), (11, 0), (0, 0), (8, 8), (9, 8), (10, 8)}
    assert ("edges", 8) in made


def test_drop_copies_of_null_and_repeated_ids(spark):
    """Rows of one id with other texts stay, equal rows stay once."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a, "s1"), (None, a + " end", "s1"), (None, b, "s1"), (None, c, "s2"), (None, c, "s2"), (2, d, "s1"), (2, a, "s1"),
            (2, d, "s1"), (3, d + " end", "s1"), (4, None, "s1"), (4, None, "s1"), (5, " ", "s1"), (6, "one two", "s2"), (6, "one two", "s1")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = corpus_pipeline.drop_copies(spark, df, "")
    assert got.schema == df.schema
    assert Counter(map(tuple, got.collect())) == Counter(
        [(1, a, "s1"), (None, b, "s1"), (None, c, "s2"), (2, d, "s1"), (4, None, "s1"), (4, None, "s1"), (5, " ", "s1"), (6, "one two", "s1")])


def brute_quality(text):
    words, lines = split(text), (text or "").split("\n")
    win = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(win)
    hit = {j for i, w in enumerate(win) if n[w] > 1 for j in range(i, i + 5)}
    full = [x for x in lines if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(hit))


def test_quality(docs, odd, empty):
    for table in (docs, odd):
        want = Counter((r.doc_id, *brute_quality(r.text)) for r in table.collect())
        got = quality.judge(table).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
        for r in got:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert quality.judge(empty).count() == 0
    assert quality.passed(odd).columns == odd.columns


def test_quality_rejects_planted(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("ab" * int(rng.integers(1, 5)) + str(rng.integers(1e6)) for _ in range(int(rng.integers(80, 300)))), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(f"${j}#" * 40 for j in range(100)), "en", "s") for i in range(5)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if not r.kept} == set(range(1000, 1005))


def test_encoder_equals_library():
    import random
    r = random.Random(5)
    parts = ["foo", "Bar", "don't", "'s", "..", "!?", "1234", "é", "\n", " ", "  ", "x,", "<|endoftext|>", "\t", "İ", "日本", "...\n", "\x00", " "]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        e = tokens.ChunkEncoder(tokens.tokenizer_path(name), most=50 * tokens.ENTRY_BYTES)
        for _ in range(1500):
            s = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
            assert e.ids(s) == e.whole(s), s


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 32])
def test_bits(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype("<u4")
    assert (tokenbin.unpack_bits(tokenbin.pack_bits(ids, bits), 1000, bits) == ids).all()


def test_larger_ids_are_refused():
    with pytest.raises(ValueError, match="70000"):
        tokenbin.pack_bits(np.array([1, 70_000], "<u4"), 16)
    assert tokens.vocabulary_size(tokens.tokenizer_path(tokenbin.VOCABULARY)) <= 1 << 16


def test_encoder_cache_is_bounded_in_bytes():
    e = tokens.ChunkEncoder(tokens.tokenizer_path("byte_bpe_50k.json"), most=5000)
    text = " ".join(f"word{i}" for i in range(400))
    assert e.ids(text) == e.whole(text) and e.left >= 0 and len(e.cache) < 25


def test_pipeline_keeps_columns_of_any_name(spark, docs):
    """Columns named like the stages' own come out of every stage as they went in."""
    extra = [F.lit(0.25).alias("score"), F.lit(9).alias("predicted"), F.lit("h").alias("held_out"), F.lit(1).alias("a.b"), F.lit(2).alias("__row"),
             F.lit(3).alias("__s"), F.create_map(F.lit("k"), F.col("doc_id")).alias("tags"), F.lit("n").alias("node"), F.lit(5).alias("own3")]
    rows = docs.select("*", *extra).limit(60)
    rows = neardup.materialize(rows.unionByName(rows.limit(5)), "rows")  # stages read written tables
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == rows.columns and out.dtypes == rows.dtypes, name
        got = out.collect()
        assert got and all((r["score"], r["predicted"], r["held_out"], r["a.b"], r["__row"], r["__s"], r["tags"], r["own3"]) ==
                           (0.25, 9, "h", 1, 2, 3, {"k": r.doc_id}, 5) for r in got), name


def test_token_file_random_access(tmp_path):
    rng = np.random.default_rng(0)
    docs = [(i, rng.integers(0, 5000, int(rng.integers(1, 900))).astype("<u4").tobytes()) for i in range(50)]
    path = tmp_path / "a.tids"
    path.write_bytes(tokenbin.file_bytes(docs, 13, block=256))
    with path.open("rb") as stream:
        f = tokenbin.TokenFile(stream)
        for key, start, n, _ in f.docs.T:
            assert f.ids(int(start), int(n)).tobytes() == docs[key][1]


def test_token_round_trip(docs, odd, empty):
    e = tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json"))
    for table in (docs, odd):
        rows = sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        want, at = [], 0
        for r in rows:
            ids = (e.whole(r.text) if r.text else b"") + np.array([2], "<u4").tobytes()
            want.append((r.doc_id, at, len(ids) // 4, zlib.crc32(ids)))
            at += len(ids) // 4
        got = [tuple(r) for r in tokenbin.round_trip(table).collect()]
        assert sorted(got, key=lambda r: r[1]) == want
    assert tokenbin.round_trip(empty).count() == 0


def test_packing(docs, odd, empty):
    e = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    for table in (docs, odd):
        texts = defaultdict(list)
        for r in table.collect():
            texts[r.doc_id].append((e.whole(r.text) if r.text else b"") + np.array([1], "<u4").tobytes())
        got = packing.pack_documents(table).collect()
        pieces, seqs = defaultdict(list), defaultdict(list)
        for r in got:
            assert any(t[4 * r.start:4 * (r.start + r.length)] == r.ids and len(t) == 4 * r.doc_tokens for t in texts[r.doc_id])
            pieces[r.doc_id].append((r.start, r.length))
            seqs[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
        for k, t in texts.items():
            assert sum(n for _, n in pieces[k]) == sum(len(x) // 4 for x in t)
        for s in seqs.values():
            at = 0
            for offset, n, _ in sorted(s):
                assert offset == at
                at += n
            assert at <= 2048
        total = sum(n for p in pieces.values() for _, n in p)
        assert len(seqs) <= total / 2048 + 8
        rows = packing.sequences(packing.pack_documents(table), pad=7).collect()
        assert len(rows) == len({r.sequence_id for r in rows}) == len(seqs)
        for r in rows:
            whole = b"".join(b for _, _, b in sorted(seqs[r.sequence_id]))
            assert len(whole) == 4 * r.n_tokens
            assert r.ids == whole + np.full(2048 - r.n_tokens, 7, "<u4").tobytes()
    assert packing.pack_documents(empty).count() == packing.sequences(packing.pack_documents(empty)).count() == 0


def test_packing_digest(spark, docs):
    """The query's digests are those of the library's own ids."""
    e = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    texts = {r.doc_id: (e.whole(r.text) if r.text else b"") + b"\1\0\0\0" for r in docs.collect()}
    got = queries.op9_cost_packing(spark, SF).collect()
    assert len(texts) == docs.count() and {r.doc_id for r in got} == set(texts)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(texts[r.doc_id][4 * r.start:4 * (r.start + r.length)])
    assert set(got[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_packing_yields_many_pieces_in_batches(spark, monkeypatch):
    """More pieces than a record batch holds, in several blocks."""
    df = spark.range(3000).selectExpr("id AS doc_id", "'word ' || id AS text").coalesce(1)
    got = packing.pack_documents(df, block_tokens=5000).collect()
    assert sorted(r.doc_id for r in got if r.start == 0) == list(range(3000))
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)


def test_mixing(spark, docs, odd, empty):
    for table in (docs, odd):
        got = mixing.mix(table).collect()
        sizes = defaultdict(int)
        for r in table.collect():
            sizes[r.source] += len(split(r.text))
        order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
        w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        target, free, rest = {}, set(order), sum(sizes.values())
        while free:
            level = rest / sum(w[s] for s in free)
            over = [s for s in free if level * w[s] > 3 * sizes[s]]
            if not over:
                target |= {s: level * w[s] for s in free}
                break
            for s in over:
                target[s] = 3.0 * sizes[s]
                rest -= 3 * sizes[s]
                free.remove(s)
        assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len(split(r.text))) for r in table.collect())
        assert all(r.taken <= 3 * r.size for r in got)
        assert sorted({round(r.target, 6) for r in got}) == sorted({round(t, 6) for t in target.values()})
        assert sum(r.taken for r in mixing.mix(table).collect()) == sum(r.taken for r in got)
        copies = mixing.mixed(table)
        assert copies.columns == table.columns
        assert sum(len(split(r.text)) for r in copies.collect()) == sum(r.taken for r in got)
    by = defaultdict(int)
    for r, s in zip(sorted(mixing.mix(docs).collect()), sorted((r.doc_id, r.source) for r in docs.collect())):
        by[s[1], r.target] += r.taken
    largest = max(len(split(r.text)) for r in docs.collect())
    assert all(abs(t - target) <= largest / 2 + 1 for (_, target), t in by.items())
    assert mixing.mix(empty).count() == 0


def test_sharding(docs, odd, empty):
    for table in (docs, odd):
        got = sharding.shard(table).collect()
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
            (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in table.collect())
        by = defaultdict(list)
        for r in got:
            by[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
        counts = [len(by.get(k, [])) for k in range(8)]
        assert max(counts) - min(counts) <= 1
    assert sharding.shard(empty).count() == 0


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_shard_files_are_pruned(spark, name, tmp_path, request):
    """All rows come back whole; asked ranges open few shards and lose no row."""
    table = request.getfixturevalue(name).withColumn("_shard", F.lit("own")).withColumn("a.b", F.lit(1))
    path = str(tmp_path / name)
    sharding.write_shards(table, path, shards=16)
    rows = Counter(map(tuple, table.collect()))
    got = sharding.read_shards(spark, path)
    assert got.columns == table.columns and Counter(map(tuple, got.collect())) == rows
    asked = [{"lang": ("de", "de")}, {"source": (None, "s1")}, {"doc_id": (5, 9)}, {"size": (1, 40)}, {"size": (5000, None)},
             {"lang": ("en", "en"), "doc_id": (None, 60)}, {"lang": ("zz", None)}]
    opened = []
    for ranges in asked:
        want = Counter()
        for r, n in rows.items():
            value = dict(zip(table.columns, r)) | {"size": len((r[table.columns.index("text")] or "").encode()) + 1}
            if all(value[c] is not None and (low is None or value[c] >= low) and (high is None or value[c] <= high)
                   for c, (low, high) in ranges.items()):
                want[r] += n
        assert Counter(map(tuple, sharding.read_shards(spark, path, **ranges).collect())) == want
        opened.append(len(sharding.matching(spark, path, ranges)))
    assert opened[-1] == 0
    if name == "docs":
        assert sum(opened) < len(asked) * 16 * 0.6 and max(opened) < 16
    with pytest.raises(ValueError):
        sharding.read_shards(spark, path, text=(None, "a"))


def test_shards_quantise_sources_of_one_head(spark):
    """Sources that share their first characters still order the rows."""
    df = spark.range(1000).selectExpr("id AS doc_id", "'x' AS text", "'en' AS lang", "concat('https://corpus/', id % 4) AS source")
    cuts = sharding._text_cuts(df, "source", [0.25, 0.5, 0.75])
    assert cuts == ["https://corpus/0", "https://corpus/1", "https://corpus/2"]


def test_hilbert_curve_visits_neighbours():
    points = np.stack(np.meshgrid(*[np.arange(4)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = sharding.hilbert_index(points, bits=2)
    assert sorted(index) == list(range(64))
    path = points[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


PAGES = [(1, "http://A.example.org/es/x?q", "<p>é"), (2, "https://example.org/en/1#a", "<p>é"), (3, None, None), (4, "no scheme", ""),
         (5, "http://x.com/fr/", "z"), (6, "http://X.com/de/?a", "z"), (7, "http://m.net/a\nb ü", "z"), (None, "http://org", "only"),
         (8, "http://org/", "<p>" * 50000), (9, "http://a.net", "z")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, host string, verdict string")


def brute_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def test_url_filter(spark, pages):
    for table in (pages, spark.read.parquet(f"{SF}/pages.parquet")):
        rows, at = table.collect(), defaultdict(set)
        for r in rows:
            at[r.html or ""].add(brute_url(r.url)[0])
        mixed_hosts = {h for html, hosts in at.items() for h in hosts if len(hosts) < 2}
        want = Counter()
        for r in rows:
            host, path = brute_url(r.url)
            fit = [(len(h), len(p), h + p, v) for h, p, v in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
            rule, verdict = max(fit)[2:] if fit else (None, "block" if host and host not in mixed_hosts else "allow")
            want[(r.page_id, host, path, rule, verdict)] += 1
        assert Counter(tuple(r) for r in urlfilter.judge(table).collect()) == want
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(3000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = urlfilter.Cascade(universe)
    assert len(cascade.levels) > 1
    told = cascade.attach(universe, "w").where(cascade.contains(F.col("key"), "w") != F.col("listed"))
    assert told.count() == 0


def test_warc(spark, pages):
    for table in (pages, spark.read.parquet(f"{SF}/pages.parquet")):
        rows, first = table.collect(), {}
        for r in rows:
            first[r.html or ""] = max(first.get(r.html or "", -1), -1 if r.page_id is None else r.page_id)
        want = Counter()
        for r in rows:
            body = (r.html or "").encode()
            own = first[r.html or ""]
            response = own == (-1 if r.page_id is None else r.page_id)
            want[(r.page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if response else "revisit", None if response else own)] += 1
        assert Counter(tuple(r) for r in warc.round_trip(table).collect()) == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_filters_are_pushed(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/w"
    warc.write_archives(pages, folder)
    before = spark.conf.get(warc.PUSHDOWN, None)
    rows = warc.read_archives(spark, folder, payloads=False).where("record_type = 'revisit'")
    assert rows.count() == 5  # in a session as it comes
    with warc.pushdown(spark):
        got = warc.read_archives(spark, folder, payloads=False).where("record_type = 'revisit'")
        assert got.where("payload is not null").count() == 0 and got.count() == 5
    assert spark.conf.get(warc.PUSHDOWN, None) == before
    r = warc._PushingReader({"path": folder})
    from pyspark.sql.datasource import EqualTo
    assert list(r.pushFilters([EqualTo(("record_type",), "revisit"), EqualTo(("http_length",), 1)])) == [EqualTo(("http_length",), 1)]
    assert r.equal == [("warc-type", "revisit")]


def test_warc_reads_committed_archives_only(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/w"
    made = warc.write_archives(pages, folder)
    n = pages.count()
    assert made.agg(F.sum("records")).first()[0] == n
    lost = tmp_path / "w" / "part-000000-9999-000000.warc"  # of a task that was given up
    lost.write_bytes(warc.record(1, None, b"x", warc.digest_of(b"x"), None, False))
    assert warc.read_archives(spark, folder).count() == n
    bare = tmp_path / "bare"
    bare.mkdir()
    (bare / "a.warc").write_bytes(lost.read_bytes())
    assert [r.payload for r in warc.read_archives(spark, f"file://{bare}").collect()] == [b"x"]


def test_mixing_splits_equal_rows(spark):
    rows = [(1, " ".join("w" * 11), "a")] * 500 + [(k, "x y", "b") for k in range(2500)] + [(9, "z " * 7, None)] * 300
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    by = defaultdict(lambda: [0, 0.0])
    for r in mixing.mix(table).collect():
        of = {11: "a", 2: "b", 7: None}[r.size]
        by[of][0] += r.taken
        by[of][1] = r.target
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size
    for of, size in (("a", 11), ("b", 2), (None, 7)):
        assert abs(by[of][0] - by[of][1]) <= size / 2 + 1e-6, (of, by[of])
    words = Counter()
    for r in mixing.mixed(table).collect():
        words[r.source] += len(r.text.split())
    assert {k: v[0] for k, v in by.items()} == dict(words)
    import duckdb

    con = duckdb.connect()
    documents = table.toPandas()  # noqa: F841 - read by name
    want = Counter(con.execute(mixing.ORACLE).fetchall())
    assert Counter(tuple(r) for r in mixing.mix(table).collect()) == want


def test_toxicity_sample_bounds_rows(spark):
    rows = [(k % 40, f"text {k % 3 if k % 40 else k}") for k in range(3000)]
    marks = spark.createDataFrame([(k, 1) for k in range(40)], "__id long, toxic int")
    marked = spark.createDataFrame(rows, "doc_id long, text string").join(marks, F.col("doc_id") == F.col("__id"))
    whole = toxicity._sample(marked, 10_000).collect()
    assert len(whole) == len(set(rows))
    got = toxicity._sample(marked, 50).collect()
    assert len(got) == 50 and sorted(got) == sorted(toxicity._sample(marked.repartition(5), 50).collect())


def test_search(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    bad = [(10_000, None), (10_001, []), (10_050, [0.0] * 64), (10_002, [float("nan")] * 64), (10_003, [None] * 64), (10_100, [1.0, 2.0])]
    dup = vectors.where("vec_id < 60").select(F.col("vec_id") + 20_000, "embedding").toDF("vec_id", "embedding")
    table = vectors.select("vec_id", "embedding").unionByName(dup).unionByName(
        spark.createDataFrame(bad, "vec_id long, embedding array<float>"))
    rows = {r.vec_id: np.array(r.embedding, np.float64) for r in table.where("vec_id < 10000 or vec_id >= 20000").collect()}
    ids, mat = np.array(list(rows)), np.stack(list(rows.values()))
    hit = total = 0
    got = defaultdict(list)
    for r in ann.search(table, table.where("vec_id % 50 = 0"), block=64, query_block=4).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in [i for i in rows if i % 50 == 0]:
        s = ann.exact(rows[q], mat)
        want = [(int(ids[k]), s[k]) for k in np.lexsort((ids, -s)) if ids[k] != q][:5]
        mine = [(v, c) for _, v, c in sorted(got[q])]
        assert all(abs(c - s[list(ids).index(v)]) < 1e-12 for v, c in mine) and len(mine) == 5
        hit += len({v for v, _ in mine} & {v for v, _ in want})
        total += 5
    assert hit / total >= 0.95
    assert ann.search(table.limit(0), table.limit(0)).count() == 0


def test_toxicity_held_out(spark, odd, empty):
    sf = "/root/testdata/sf0.1"  # the smaller tables hold out six toxic rows
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    pos, neg = [r.score for r in got if r.toxic], [r.score for r in got if not r.toxic]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    right = np.mean([r.predicted == r.toxic for r in got])
    print("auc", auc, "accuracy", right)
    assert auc > 0.9 and right > 0.9
    out = toxicity.score(odd, model)
    assert out.count() == len(ODD) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.scored(empty, labels).count() == 0
    assert toxicity.scored(odd, labels.limit(0)).where("predicted = 0").count() == len(ODD)


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = np.where(rng.random(60_000) < 0.3, 1, -1)
    right = np.array([0.9, 0.8, 0.75, 0.85, 0.7, 0.65])
    votes = (np.where(rng.random((60_000, 6)) < right, y[:, None], -y[:, None]) > 0).astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # a copied voter
    a, given, hit = toxicity.label_model(votes.mean(0), np.cov(votes.T), 0.3)
    assert np.abs(a[1:6] - (2 * right[1:] - 1)).max() < 0.15
    assert given[0, 6] > 0.2 and (hit > 0).all()
    post = np.log(0.3 / 0.7) + votes @ hit
    assert post[y > 0].mean() > post[y < 0].mean() + 1


def test_pipeline(spark, docs, tmp_path, monkeypatch):
    """Each stage of a run, on what the one before it left, against brute force;
    the classifier's and the covariance's verdicts are taken from their operators."""
    extra = spark.createDataFrame([(i, t, a, s, len(t or "")) for i, t, a, s in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    words = [f"w{i}" for i in range(40)]
    copies = [(None, " ".join(words)), (None, " ".join(words[::-1])), (77_001, " ".join([*words, "x"])), (77_002, " ".join(words[::-1])), (77_002, " ".join(words[::2]))]
    more = spark.createDataFrame([(i, t, "en", "s1", len(t)) for i, t in copies], extra.schema)
    docs.select(extra.columns).unionByName(extra).unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    seen = []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [
        (n, lambda s, d, p, f=f: seen.append(d) or f(s, d, p)) for n, f in corpus_pipeline.STAGES])
    last = corpus_pipeline.run(spark, str(tmp_path))
    rows = [Counter(map(tuple, d.collect())) for d in seen]
    at = seen[0].columns.index("text")

    # toxicity and quality: by row, every row of those that the verdict names
    model = toxicity.fit(seen[0], spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert rows[1] == Counter(tuple(r)[:5] for r in toxicity.score(seen[0], model).where("predicted = 0").select(*extra.columns).collect())
    failed = {r for r in rows[1] if (q := brute_quality(r[at]))[0] < 10 or 100 * q[4] > 20 * q[0]}
    assert not failed & set(rows[2]) and all(rows[1][r] == n for r, n in rows[2].items())
    assert rows[2].total() == quality.judge(seen[1]).where("kept").count()

    # near-duplicates: of each component the row of the smallest id
    own = [r for r in rows[2].elements()]
    sets, up = [shingle_set(r[at]) for r in own], list(range(len(own)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(own)), 2):
        n = len(sets[i] & sets[j])
        if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            up[root(i)] = root(j)
    ids = defaultdict(list)
    for i, r in enumerate(own):
        ids[root(i)].append(r[0])
    low = Counter(min(x, key=lambda k: (k is None, k or 0)) for x in ids.values())
    assert max(map(len, ids.values())) > 1 and not rows[3] - rows[2]
    assert Counter(r[0] for r in rows[3].elements()) == low
    assert len({root(own.index(r)) for r in rows[3]}) == rows[3].total() == len(ids)

    # mixing: each row as often as its words are taken
    taken = sum(r.taken for r in mixing.mix(seen[3]).collect())
    assert set(rows[4]) <= set(rows[3]) and sum(len(split(r[at])) * n for r, n in rows[4].items()) == taken

    # packing: all tokens of all rows, in sequences without gaps
    e = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    want, got, seqs = Counter(), Counter(), defaultdict(list)
    for r, n in rows[4].items():
        want[r[0]] += n * (len(e.whole(r[at])) // 4 + 1)
    for r in last.collect():
        got[r.doc_id] += r.length
        seqs[r.sequence_id].append((r.offset, r.length))
    assert got == want
    assert all(sum(n for _, n in x) == max(o + n for o, n in x) <= 2048 for x in seqs.values())


def test_registered(spark):
    assert sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))[-1].startswith("op13_")
    assert len(queries.QUERIES) == 13


def test_texts_share_the_encoding_of_their_new_chunks(monkeypatch):
    """Ids of many texts, odd ones between them, equal the library's; a chunk that
    several texts of a group hold is encoded once, kept or not."""
    texts = [None, "", "one two three", "two  three", "x\ny two", " lead two", "two end\n", "é two three", "a ́b two", "one\ttwo",
             "tail two", *[f"t{k} two w{k}, w{k % 7}." for k in range(500)]]
    for most in (0, 1 << 20):
        e = tokens.ChunkEncoder(tokens.tokenizer_path("word_bpe_49k.json"), most=most)
        asked, learn = Counter(), e._learn
        monkeypatch.setattr(e, "_learn", lambda new: asked.update(new) or learn(new))
        assert e.many(texts) == [e.whole(t) if t else b"" for t in texts]
        assert asked["two"] == 1 and not e.cache.new


def test_odd_white_space_is_told():
    """The shape that may be cut into chunks, character by character."""
    before = ("[ \n][ \n]|[\\x00\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0  -     　]"
              "|[ \n][̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-゙゚︯]|\\A[ \n]|[ \n]\\Z")
    import re
    for c in map(chr, [*range(0x3100), *range(0xFE00, 0xFF00)]):
        for text in (f"a{c}b", f"a {c}b", f"a\n{c}b", f"{c}b", f"a{c}", c):
            assert tokens.odd(text) == bool(re.search(before, text)), ascii(text)


def test_packing_in_the_pipeline_leaves_memory(monkeypatch):
    """Workers keep their tokenizer's cache into the next run: six of them at most 384 MB."""
    seen = []
    monkeypatch.setattr(packing, "pack_documents", lambda docs, cache_bytes: seen.append(cache_bytes))
    corpus_pipeline.pack_sequences(None, None, "")
    assert seen and seen[0] * 6 <= 384 << 20


def test_pipeline_passes_texts_in_small_batches(spark, tmp_path, monkeypatch):
    """What goes to a Python worker at once is bounded in bytes, however long the texts."""
    def sizes(docs, *_, **__):
        told = lambda batches: (b.from_pylist([{"doc_id": b.nbytes, "text": "", "predicted": 0}]) for b in batches)
        return docs.mapInArrow(told, "doc_id long, text string, predicted long")

    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(toxicity, "fit", lambda *_: None)
    for module, name in ((toxicity, "score"), (neardup, "without_copies"), (packing, "pack_documents")):
        monkeypatch.setattr(module, name, sizes)
    for name in ("toxicity", "near-duplicates", "packing"):
        own = spark.newSession()  # with settings of its own
        long = own.range(0, 200, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 10000) AS text")
        found = [r.doc_id for r in dict(corpus_pipeline.STAGES)[name](own, long, str(tmp_path)).collect()]
        assert sum(found) > 20_000_000 and max(found) < 4_000_000, name
