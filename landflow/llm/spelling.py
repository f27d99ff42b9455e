"""Spelling variants by a trie of letter-group counts.

A word's letters fall into 32 groups (code point modulo 32, frequent letters
first); its 32 counts, two bits each, are its path in a trie with one level per
group. One inserted letter adds one to one count, one deleted letter takes one
away, a replaced letter does both or neither: a search goes down the trie depth
first and may spend a surplus of one and a deficit of one. Words at the leaves
that it reaches are verified letter by letter. (A count over 3 is stored as 3,
which never widens a difference, so no near word is lost.)

On Spark the trie is cut below its heavy nodes, those with more than ``LIMIT``
words: every word lies in one subtree, and searches the few subtrees that its
budget reaches in the small top trie. A task holds the words of one subtree and
streams the searches through it in blocks. A full path with more than ``LIMIT``
words is dealt over blocks by hash, and searches visit each. The top trie has at
most 32 * 4 nodes for each ``LIMIT`` words, and ``LIMIT`` grows once the words
are more than 50,000 times it.

Cases: a null text has no words; with a null doc_id nothing is deleted; repeated
rows count each; ties go to the smallest word; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.session import materialize

GROUPS, BITS, MOST = 32, 2, 3
LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
#: Letters from frequent to rare in European text; any order gives the same pairs.
FREQUENT = "enaistrodlhucmgbfpvwkzyjqx"
#: Words a subtree may hold, distinct words a counting task gathers, searches a block.
LIMIT, GATHERED, BLOCK = 20_000, 300_000, 4096
#: Nodes of at most this many words are searched as leaves.
LEAF = 12
#: Words longer than this are verified one by one.
WIDE = 40
_ORDER = [ord(c) % GROUPS for c in FREQUENT]
_LEVEL = np.zeros(256, np.int64)  # of a code point
_LEVEL[:] = np.argsort([*_ORDER, *(g for g in range(GROUPS) if g not in _ORDER)])[np.arange(256) % GROUPS]
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        got = pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return got

    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            found = Counter(_RUN.findall((text.as_py() or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
            if doc is None:
                held.update(found)
                continue
            head = zlib.crc32(f"{doc}:".encode())
            for run, n in found.items():
                h = zlib.crc32(run.encode(), head)
                if h % 31 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < LEAST_LETTERS:
                        continue
                held[run] += n
            if len(held) >= GATHERED:
                yield out()
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of the words of at least two occurrences."""
    each = docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(_counted, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after another, and the words' lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), sizes


def paths(words: list[str]) -> np.ndarray:
    """The counts of each word as one unsigned number, first group highest."""
    flat, sizes = letters(words)
    owner = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(owner * GROUPS + _LEVEL[flat], minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    out = np.zeros(len(words), np.uint64)
    for g in range(GROUPS):
        out = (out << np.uint64(BITS)) | np.minimum(counts[:, g], MOST).astype(np.uint64)
    return out


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = paths(batch["word"].to_pylist())
        yield pa.record_batch([batch["word"], batch["n"], pa.array(p.view(np.int64))], ["word", "n", "path"])


def _shift(level: int) -> int:
    return BITS * (GROUPS - level)


class Trie:
    """Levels of a counts trie: the distinct path heads of each level."""

    def __init__(self, path: np.ndarray) -> None:
        self.path = path  # sorted
        self.heads, self.starts = [], []
        for level in range(GROUPS + 1):
            heads, first = np.unique(path >> np.uint64(_shift(level)) if level else np.zeros(len(path), np.uint64), return_index=True)
            self.heads.append(heads)
            self.starts.append(np.append(first, len(path)))

    def reached(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of all words within a surplus and a deficit of one."""
        q, node = np.arange(len(query)), np.zeros(len(query), np.uint64)
        up, down = np.ones(len(query), bool), np.ones(len(query), bool)
        got_q, got_w = [], []
        for level in range(1, GROUPS + 1):
            own = (query[q] >> np.uint64(_shift(level))) & np.uint64(MOST)
            heads, starts = self.heads[level], self.starts[level]
            parts = []
            for step, may in ((0, None), (1, up & (own < MOST)), (-1, down & (own > 0))):
                k = np.arange(len(q)) if may is None else np.flatnonzero(may)
                child = (node[k] << np.uint64(BITS)) | (own[k].astype(np.int64) + step).astype(np.uint64)
                at = np.minimum(np.searchsorted(heads, child), len(heads) - 1)
                hit = heads[at] == child
                k, at = k[hit], at[hit]
                parts.append((q[k], heads[at], up[k] & (step != 1), down[k] & (step != -1), starts[at], starts[at + 1]))
            q, node, up, down, lo, hi = (np.concatenate(x) for x in zip(*parts))
            leaf = (hi - lo <= LEAF) | (level == GROUPS)
            size = (hi - lo)[leaf]
            offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            got_q.append(np.repeat(q[leaf], size))
            got_w.append(np.repeat(lo[leaf], size) + offset)
            q, node, up, down = q[~leaf], node[~leaf], up[~leaf], down[~leaf]
            if not len(q):
                break
        return np.concatenate(got_q), np.concatenate(got_w)


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Paths that differ in at most two counts."""
    x = a ^ b
    return np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)) <= 2


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point tells them apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


class Words:
    """Words as rows of letters, padded with zeros."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        flat, self.sizes = letters(words)
        self.grid = np.zeros((len(words), WIDE + 2), np.uint8)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        row = np.repeat(np.arange(len(words)), self.sizes)
        near = column < WIDE + 1
        self.grid[row[near], column[near]] = flat[near]


def verified(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether words ``i`` of ``a`` and ``j`` of ``b`` are one edit apart."""
    na, nb = a.sizes[i], b.sizes[j]
    out = np.zeros(len(i), bool)
    wide = (na > WIDE) | (nb > WIDE)
    for k in np.flatnonzero(wide & (abs(na - nb) <= 1)):
        out[k] = one_edit(a.words[i[k]], b.words[j[k]])
    same = np.flatnonzero((na == nb) & ~wide)
    out[same] = (a.grid[i[same]] != b.grid[j[same]]).sum(1) == 1
    for short, s, long, t, k in ((a, i, b, j, np.flatnonzero((nb == na + 1) & ~wide)), (b, j, a, i, np.flatnonzero((na == nb + 1) & ~wide))):
        x, y = short.grid[s[k]][:, :-1], long.grid[t[k]]
        before = np.logical_and.accumulate(x == y[:, :-1], axis=1)
        out[k] = (before | (x == y[:, 1:])).all(1)
    return out


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by subtree, its own words first: the near words of each search."""
    tree, own, wait = None, ([], []), ([], [])
    index = None

    def build() -> None:
        nonlocal index, own
        path = paths(own[0])
        order = np.argsort(path, kind="stable")
        words = [own[0][k] for k in order]
        n = np.array(own[1], np.int64)[order]
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(np.array(words, dtype=object), kind="stable")] = np.arange(len(words))
        index, own = (Trie(path[order]), Words(words), n, rank), ([], [])

    def search(words: list[str]) -> pa.RecordBatch:
        trie, known, n, rank = index
        path = paths(words)
        q, w = trie.reached(path)
        keep = _within(path[q], trie.path[w])
        q, w = q[keep], w[keep]
        keep = verified(Words(words), q, known, w)
        q, w = q[keep], w[keep]
        order = np.lexsort((rank[w], -n[w], q))
        q, w = q[order], w[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, int)
        return pa.record_batch([
            pa.array([words[k] for k in q[first]], pa.string()), pa.array(np.diff(np.append(first, len(q))), pa.int64()),
            pa.array(n[w[first]], pa.int64()), pa.array([known.words[k] for k in w[first]], pa.string())], ["word", "n_near", "best_n", "best"])

    for batch in batches:
        for key, mine, word, n in zip(*(batch[c].to_pylist() for c in ("tree", "mine", "word", "n"))):
            if key != tree:
                if wait[0]:
                    yield search(wait[0])
                tree, own, wait, index = key, ([], []), ([], []), None
            if mine:
                own[0].append(word)
                own[1].append(n)
                continue
            if index is None:
                build()
            wait[0].append(word)
            if len(wait[0]) >= BLOCK:
                yield search(wait[0])
                wait = ([], [])
    if wait[0]:
        yield search(wait[0])


def top_trie(placed: DataFrame, limit: int) -> dict[int, dict[int, int]]:
    """Words under each node, by level and path head, of the nodes whose parent
    holds more than ``limit``."""
    total = placed.count()
    out: dict[int, dict[int, int]] = {0: {0: total}}
    heads = {0: [0]} if total > limit else {}
    level = 0
    while heads and level < GROUPS:
        span = range(level + 1, min(level + 6, GROUPS) + 1)
        under = placed
        if level:
            heavy = placed.sparkSession.createDataFrame([(h,) for h in heads[level]], "head long")
            under = placed.join(F.broadcast(heavy), F.shiftrightunsigned("path", _shift(level)) == F.col("head"), "left_semi")
        rows = under.select(F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.shiftrightunsigned("path", _shift(x)).alias("head")) for x in span])).alias("p"))
        each = materialize(rows.groupBy("p").agg(F.count("*").alias("c")).select("p.level", "p.head", "c"), "trie-nodes")
        # nodes over the limit are few: at most total / limit a level
        big = {x: {r.head: r.c for r in each.where(f"level = {x} and c > {limit}").collect()} for x in span}
        open_ = set(heads[level])
        for x in span:
            if not open_:
                break
            up = placed.sparkSession.createDataFrame([(h,) for h in open_], "up long")
            near = each.where(F.col("level") == x).join(F.broadcast(up), F.shiftrightunsigned("head", BITS) == F.col("up"), "left_semi")
            out[x] = {r.head: r.c for r in near.collect()}
            open_ = set(big[x])
        level = span[-1]
        heads = {level: sorted(open_)} if open_ else {}
    return out


def _dealt(top: dict[int, dict[int, int]], limit: int):
    """Search rows for every subtree that a word's budget reaches."""
    levels = []
    for level in range(GROUPS + 1):
        heads = np.array(sorted(h % (1 << 64) for h in top.get(level, {})), np.uint64)
        size = np.array([top[level][int(h.astype(np.int64))] for h in heads], np.int64) if len(heads) else np.zeros(0, np.int64)
        levels.append((heads, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = batch["path"].to_numpy().view(np.uint64)
            mixed = (path * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            own_block = np.fromiter((zlib.crc32(w.encode()) for w in batch["word"].to_pylist()), np.int64, len(path))
            q, node = np.arange(len(path)), np.zeros(len(path), np.uint64)
            up, down, same = np.ones(len(path), bool), np.ones(len(path), bool), np.ones(len(path), bool)
            found = []
            for level in range(GROUPS + 1):
                heads, size = levels[level]
                at = np.minimum(np.searchsorted(heads, node), max(len(heads) - 1, 0))
                hit = heads[at] == node if len(heads) else np.zeros(len(q), bool)
                q, node, up, down, same, at = q[hit], node[hit], up[hit], down[hit], same[hit], at[hit]
                light = (size[at] <= limit) if level < GROUPS else np.ones(len(q), bool)
                blocks = np.maximum(1, -(-size[at] // limit)) if level == GROUPS else np.ones(len(q), np.int64)
                key = node << np.uint64(_shift(level)) if level else node
                found.append((q[light], key[light], same[light], blocks[light]))
                q, node, up, down, same = q[~light], node[~light], up[~light], down[~light], same[~light]
                if level == GROUPS or not len(q):
                    break
                own = ((path[q] >> np.uint64(_shift(level + 1))) & np.uint64(MOST)).astype(np.int64)
                parts = []
                for step, may in ((0, np.ones(len(q), bool)), (1, up & (own < MOST)), (-1, down & (own > 0))):
                    parts.append((q[may], (node[may] << np.uint64(BITS)) | (own[may] + step).astype(np.uint64), up[may] & (step != 1),
                                  down[may] & (step != -1), same[may] & (step == 0)))
                q, node, up, down, same = (np.concatenate(x) for x in zip(*parts))
            q, key, same, blocks = (np.concatenate(x) for x in zip(*found))
            many = np.repeat(np.arange(len(q)), blocks)
            block = np.arange(len(many)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            q, key, same = q[many], key[many], same[many]
            home = np.flatnonzero(same & (own_block[q] % blocks[many] == block))
            rows = np.concatenate([home, np.arange(len(q))])
            mine = np.arange(len(rows)) < len(home)
            words, n = batch["word"], batch["n"]
            for lo in range(0, len(rows), 50_000):
                part = rows[lo:lo + 50_000]
                yield pa.record_batch([pa.array([f"{key[r]}.{block[r]}" for r in part], pa.string()), pa.array(mine[lo:lo + 50_000]),
                                       words.take(pa.array(q[part])), n.take(pa.array(q[part]))], ["tree", "mine", "word", "n"])
    return run


def near_words(words: DataFrame, limit: int | None = None) -> DataFrame:
    """word, n_near, best_n, best of the words (word, n) that have near words."""
    placed = materialize(words.select("word", "n").mapInArrow(_placed, "word string, n long, path long"), "paths")
    count = placed.count()
    limit = limit or max(LIMIT, count // 50_000)
    top = top_trie(placed, limit)
    dealt = placed.mapInArrow(_dealt(top, limit), "tree string, mine boolean, word string, n long")
    trees = sum(1 for level, nodes in top.items() for c in nodes.values() if c <= limit or level == GROUPS)
    parts = max(1, trees, words.sparkSession.sparkContext.defaultParallelism)
    near = dealt.repartition(min(parts, 20_000), "tree").sortWithinPartitions("tree", F.desc("mine")).mapInArrow(
        _searched, "word string, n_near long, best_n long, best string")
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def variants(docs: DataFrame, limit: int | None = None, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = materialize(word_counts(docs), "words")
    near = near_words(words, limit)
    has = F.col("best_n") >= ratio * F.col("n")
    formed = materialize(words.join(near, "word", "left").select(
        "word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n")), "forms")
    # counts rise at least tenfold along forms: a few doublings reach the last
    step = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        far = step.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = materialize(step.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        step = new.select("word", "root")
        if new.where("moved").isEmpty():
            break
    return formed.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS r FROM documents),
low AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n FROM runs GROUP BY ALL),
crc AS (SELECT r, n, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id || ':' || r, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM low, tab),
d AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word, n FROM crc),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS c FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.c = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.c = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN other END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word),
walk AS (SELECT word, word AS here, 0 AS k FROM f UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN f ON f.word = walk.here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM f JOIN (SELECT word, arg_max(here, k) AS root FROM walk GROUP BY word) r ON r.word = f.word
"""
