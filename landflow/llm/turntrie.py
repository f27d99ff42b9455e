"""Prefix trie of conversations, from sorted neighbours.

A conversation is the sequence of its turns' digests (16 bytes a turn, of role
and text). Conversations are range-sorted by sequence; neighbours are joined at
the depth of their longest common prefix, deepest edges first, in a union-find
over runs of neighbours. A merge makes (or widens) the branching node at that
depth and closes the components below it: their nodes, and the unary nodes down
to the merge, are final. What the first and the last sequence of a run still
share with neighbours outside stays open; a run is so contracted to the few open
nodes on its two borders. Contracted runs are merged with the same routine, batch
after batch within a partition, then partitions in groups of ``FAN`` until one is
left, which closes the root.

A task holds one batch of ``BATCH`` sequences and its nodes. The unit of memory
is one conversation's digests; texts never leave the first scan. Equal sequences
may be any share of the rows: they are sorted by conversation id too, so they
spread over ranges, and meet as counts. The SHA-256 of a node's ending ids is
sequential by nature: ranges give blocks of joined ids, and one streaming pass
hashes the blocks of a sequence that reaches over ranges.

Cases: null role or text is empty; turns are ordered by turn (null first), then
role, then digest; rows without conv_id are left out; a conversation without
turns ends at the root; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.session import bounded_broadcast, materialize

#: Bytes of a turn's digest; sequences a batch; partitions merged at once; bytes of a range.
TURN, BATCH, FAN, RANGE_BYTES = 16, 20_000, 64, 16 << 20
#: Ids joined in one block of a sequence that reaches over a partition's border.
BLOCK = 100_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, own_ref binary, parent_ref binary, ends_ref binary")
#: A row is a node (kind 0), an open item of a strip (1) or a block of ids (2).
ROW = f"kind int, part long, place int, {NODE}, key binary, lens array<int>, ids binary"
COLUMNS = [c.split()[0] for c in ROW.split(", ")]


@dataclass(slots=True)
class Item:
    """A node that is not closed yet, with what is closed below it."""

    depth: int
    key: bytes  # digests of the turns down to it
    lens: list  # code points of these turns' texts
    n: int  # members
    first: int  # smallest member
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None  # hash of the ids that end here
    ends_ref: bytes | None = None  # or the sequence whose blocks give it
    asked: bool = False  # closed children wait elsewhere for its conv_id
    waiting: list = field(default_factory=list)  # places of closed children


def _ref(key: bytes) -> bytes:
    return hashlib.md5(key).digest()


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their head."""
    n = min(len(a), len(b)) // TURN
    if a[:n * TURN] == b[:n * TURN]:
        return n
    lo = 0
    while n - lo > 1:
        mid = (lo + n) // 2
        if a[lo * TURN:mid * TURN] == b[lo * TURN:mid * TURN]:
            lo = mid
        else:
            n = mid
    return lo


class Nodes:
    """Closed nodes as columns; parents are filled in where they close here."""

    def __init__(self) -> None:
        self.rows: list[list] = []

    def lift(self, x: Item, depth: int) -> Item:
        """Close the nodes of ``x`` below ``depth``; the open node at ``depth``
        that has them as its only child."""
        leaves, saved, children = x.leaves or 1, x.saved, x.children
        ref = _ref(x.key) if x.asked else None
        ends, ends_ref = x.ends or (None if x.ends_ref else NO_ENDS), x.ends_ref
        waiting = x.waiting
        for d in range(x.depth, depth, -1):
            saved += (x.n - 1) * x.lens[d - 1]
            for place in waiting:
                self.rows[place][2] = x.first
            self.rows.append([x.first, d, None, x.n, children, leaves, saved, ends, ref, None, ends_ref])
            waiting = [len(self.rows) - 1]
            children, ref, ends, ends_ref = 1, None, NO_ENDS, None
        return Item(depth, x.key[:depth * TURN], x.lens[:depth], x.n, x.first, 1, leaves, saved, waiting=waiting)

    def root(self, x: Item) -> None:
        for place in x.waiting:
            self.rows[place][2] = x.first
        self.rows.append([x.first, 0, None, x.n, x.children, x.leaves or 1, x.saved,
                          x.ends or (None if x.ends_ref else NO_ENDS), _ref(b"") if x.asked else None, None, x.ends_ref])

    def leave(self, items: list[Item]) -> None:
        """Items that stay open name themselves to their closed children."""
        for x in items:
            if x.waiting:
                ref = _ref(x.key)
                for place in x.waiting:
                    self.rows[place][9] = ref
                x.waiting, x.asked = [], True


def _joined(a: Item, b: Item) -> Item:
    """Two parts of one open node."""
    big, small = (a, b) if len(a.waiting) >= len(b.waiting) else (b, a)
    big.waiting.extend(small.waiting)
    return Item(a.depth, a.key, a.lens, a.n + b.n, min(a.first, b.first), a.children + b.children, a.leaves + b.leaves,
                a.saved + b.saved, a.ends or b.ends, a.ends_ref or b.ends_ref, a.asked or b.asked, big.waiting)


def contract(items: list[Item], nodes: Nodes) -> list[Item]:
    """Union-find over the edges between neighbours, deepest first. The nodes that
    can't reach beyond the run are closed into ``nodes``; the open ones are
    returned: depths fall to the run's shallowest node, then rise."""
    m = len(items)
    if m < 2:
        return items
    edges = np.array([common(items[i].key, items[i + 1].key) for i in range(m - 1)])
    up = list(range(m))
    last = list(range(m))  # of the run that starts at a root
    top: list[Item | None] = list(items)  # open node of a component, not frozen
    left: list[Item] = []  # frozen nodes on the path of the first sequence, deepest first
    right: list[Item] = []

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for e in np.argsort(-edges, kind="stable").tolist():
        depth = int(edges[e])
        a, b = find(e), find(e + 1)  # roots are the first places of runs
        parts = []
        for c in (a, b):
            x = top[c]
            if x is not None and x.depth > depth:
                if c == 0:
                    left.append(x)
                    x = None
                elif last[c] == m - 1:
                    right.append(x)
                    x = None
                else:
                    x = nodes.lift(x, depth)
            if x is not None:
                parts.append(x)
        up[b], last[a] = a, last[b]
        top[a] = parts[0] if len(parts) == 1 else _joined(*parts) if parts else None
    middle = [top[0]] if top[0] is not None else []
    return left + middle + right[::-1]


def _item_rows(items: list[Item], part: int) -> list[list]:
    return [[1, part, i, x.first, x.depth, None, x.n, x.children, x.leaves, x.saved, x.ends,
             b"" if x.asked else None, None, x.ends_ref, x.key, x.lens, None] for i, x in enumerate(items)]


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "depth": pa.int32(), "kind": pa.int32(), "place": pa.int32(), "ends_sha256": pa.string(),
             "own_ref": pa.binary(), "parent_ref": pa.binary(), "ends_ref": pa.binary(), "key": pa.binary(),
             "lens": pa.list_(pa.int32()), "ids": pa.binary()}
    cols = list(zip(*rows)) or [[]] * len(COLUMNS)
    return pa.record_batch([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(COLUMNS, cols)], COLUMNS)


def _node_rows(nodes: Nodes, part: int) -> list[list]:
    return [[0, part, None, *r, None, None, None] for r in nodes.rows]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list, list[int]]]:
    """(key, lens, conv_ids) of sorted rows, in pieces of at most BLOCK ids."""
    key, lens, ids = None, [], []
    for batch in batches:
        for k, n, c in zip(batch["key"].to_pylist(), batch["lens"].to_pylist(), batch["conv_id"].to_pylist()):
            if ids and (k != key or len(ids) >= BLOCK):
                yield key, lens, ids
                ids = []
            key, lens = k, n
            ids.append(c)
    if ids:
        yield key, lens, ids


def _ranges(size: int):
    """Nodes, open items and id blocks of one sorted range of (key, conv_id)."""
    return lambda batches: _range(batches, size)


def _range(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    strip: list[Item] = []
    fresh: list[Item] = []

    def close() -> list[list]:
        nonlocal strip, fresh
        nodes = Nodes()
        strip, fresh = contract(strip + fresh, nodes), []
        nodes.leave(strip)
        return _node_rows(nodes, part)

    head, key, lens, held = True, None, [], []  # blocks of the current sequence

    def settle(tail: bool) -> list[list]:
        """The current sequence as an item; its blocks where it may go on outside."""
        if key is None:
            return []
        x = Item(len(lens), key, lens, sum(c for c, _, _ in held), min(f for _, f, _ in held))
        out = []
        if head or tail or len(held) > 1:
            x.ends_ref = _ref(key)
            out = [[2, part, None, f, *[None] * 9, x.ends_ref, None, None, text] for _, f, text in held]
        else:
            x.ends = hashlib.sha256(held[0][2]).hexdigest()
        fresh.append(x)
        return out

    for k, n, ids in _runs(batches):
        if k != key:
            out = settle(False)
            head, held = head and key is None, []
            if len(fresh) >= size:
                out += close()
            if out:
                yield _batch(out)
            key, lens = k, n
        held.append((len(ids), ids[0], ",".join(map(str, ids)).encode()))
    yield _batch(settle(True) + close() + _item_rows(strip, part))


def _merged(last: bool, size: int):
    """Strips of a group of neighbouring partitions, in order, become one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip: list[Item] = []
        fresh: list[Item] = []
        group = None

        def close(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal strip, fresh
            nodes = Nodes()
            strip, fresh = contract(strip + fresh, nodes), []
            if final and last and strip:
                # nothing lies beyond: close upwards, deepest first
                while len(strip) > 1:
                    i = max(range(len(strip)), key=lambda j: strip[j].depth)
                    beside = [j for j in (i - 1, i + 1) if 0 <= j < len(strip)]
                    j = max(beside, key=lambda j: common(strip[i].key, strip[j].key))
                    depth = common(strip[i].key, strip[j].key)
                    x, y = strip[i], strip[j]
                    x = nodes.lift(x, depth) if x.depth > depth else x
                    y = nodes.lift(y, depth) if y.depth > depth else y
                    strip[min(i, j):max(i, j) + 1] = [_joined(x, y)]
                nodes.root(nodes.lift(strip[0], 0) if strip[0].depth else strip[0])
                strip = []
            nodes.leave(strip)
            rows = _node_rows(nodes, group)
            if final:
                rows += _item_rows(strip, group)
                strip = []
            yield _batch(rows)

        for batch in batches:
            for r in batch.to_pylist():
                if r["grp"] != group:
                    if group is not None:
                        yield from close(True)
                    group = r["grp"]
                elif len(fresh) >= size:
                    yield from close(False)
                fresh.append(Item(r["depth"], r["key"], r["lens"], r["n_convs"], r["conv_id"], r["n_children"], r["n_leaves"],
                                  r["saved_tokens"], r["ends_sha256"], r["ends_ref"], r["own_ref"] is not None))
        if group is not None:
            yield from close(True)
    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined blocks of each sequence, sorted by first id."""
    ref, state = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for r, ids in zip(batch["ends_ref"].to_pylist(), batch["ids"]):
            if r != ref:
                if ref is not None:
                    done.append((ref, state.hexdigest()))
                ref, state = r, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py())
    if ref is not None:
        done.append((ref, state.hexdigest()))
    yield pa.record_batch([pa.array([r for r, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], ["ref", "hash"])


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, turns: the (digest, code points) of its turns, in order."""
    role, text = F.coalesce(turns["role"].cast("string"), F.lit("")), F.coalesce(turns["text"].cast("string"), F.lit(""))
    # the role's length keeps role and text apart
    digest = F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "utf-8"))
    rows = turns.select(turns["conv_id"].cast("long").alias("conv_id"), F.struct(
        turns["turn"].alias("turn"), role.alias("role"), digest.alias("d"), F.length(text).alias("n")).alias("t")).where("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"))).alias("turns"))


def rebuilt(seqs: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Each conversation with its first ``h`` turns taken from the first
    conversation of its hundred; ``h`` is the crc32 of its id modulo ``most``."""
    seqs = materialize(seqs.withColumn("h", (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % most).cast("int")), "turns")
    base = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("b"), F.slice("turns", 1, most - 1).alias("head"))
    own = seqs.withColumn("b", F.col("conv_id") - F.col("conv_id") % group)
    empty = F.slice("turns", 1, 0)
    return own.join(base, "b", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", empty), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def prefix_trie(seqs: DataFrame, batch: int = BATCH, fan: int = FAN, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per trie node of the sequences (conv_id, turns)."""
    spark = seqs.sparkSession
    rows = materialize(seqs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: x["d"]), "")).alias("key"),
                                   F.transform("turns", lambda x: x["n"]).alias("lens")), "sequences")
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("key") + 40), F.lit(0))).first()
    parts = max(-(-size // range_bytes), min(spark.sparkContext.defaultParallelism, 1 + count // 1000))
    level = materialize(rows.repartitionByRange(int(parts), "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_ranges(batch), ROW), "ranges")
    nodes = level.where("kind = 0")
    blocks = level.where("kind = 2")
    strips = level.where("kind = 1")
    high = strips.agg(F.max("part")).first()[0]
    while high is not None:
        last = high < fan
        merged = strips.withColumn("grp", F.floor(F.col("part") / fan).cast("long")).repartition(int(high // fan) + 1, "grp")
        level = materialize(merged.sortWithinPartitions("grp", "part", "place").mapInArrow(_merged(last, batch), ROW), "strips")
        nodes = nodes.unionByName(level.where("kind = 0"))
        strips = level.where("kind = 1")
        high = None if last else high // fan
    ends = bounded_broadcast(blocks.repartition("ends_ref").sortWithinPartitions("ends_ref", "conv_id").select(
        "ends_ref", "ids").mapInArrow(_hashed, "ref binary, hash string"))
    # open nodes that closed late: a few per range, each known by its prefix
    late = bounded_broadcast(nodes.where("own_ref is not null").select(F.col("own_ref").alias("pref"), F.col("conv_id").alias("pid")))
    out = nodes.join(ends, F.col("ends_ref") == F.col("ref"), "left").join(late, F.col("parent_ref") == F.col("pref"), "left")
    return out.select("conv_id", F.col("depth").cast("long"), F.coalesce("parent_conv_id", "pid").alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", "hash").alias("ends_sha256"))


def _crc(text: str) -> str:
    """DuckDB: the crc32 of an ASCII text, bit by bit."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii(substr({text}, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) "
            "WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)")


ORACLE = f"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS c, row_number() OVER w AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, ''))),
v AS (SELECT DISTINCT c, c - c % 100 AS b, {_crc("CAST(c AS VARCHAR)")} % 6 AS h FROM t),
r AS (SELECT v.c, t.pos, t.role, t.text FROM v JOIN t ON t.c = v.b AND t.pos <= v.h
  UNION ALL SELECT v.c, t.pos + 1000000, t.role, t.text FROM v JOIN t ON t.c = v.c AND t.pos > v.h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, md5(length(role) || ':' || role || text) AS m, length(text) AS n FROM r),
p AS (SELECT c, d, n, md5(string_agg(m, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM s
  UNION ALL SELECT c, 0, 0, 'root' FROM v),
e AS (SELECT c, max(d) AS len FROM p GROUP BY c),
g AS (SELECT d, k, min(p.c) AS conv_id, count(*) AS n, any_value(p.n) AS tok, string_agg(CASE WHEN len = d THEN CAST(p.c AS VARCHAR) END, ',' ORDER BY p.c) AS ids
  FROM p JOIN e ON e.c = p.c GROUP BY d, k),
up AS (SELECT DISTINCT x.d, x.k, y.k AS parent FROM p x JOIN p y ON x.c = y.c AND y.d = x.d - 1),
kids AS (SELECT d - 1 AS d, parent AS k, count(*) AS n FROM up GROUP BY ALL),
x AS (SELECT DISTINCT lo.d, lo.k, hi.d AS hd, hi.k AS hk FROM p lo JOIN p hi ON lo.c = hi.c AND hi.d <= lo.d),
sub AS (SELECT x.hd, x.hk, sum((g.n - 1) * g.tok) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM x JOIN g ON g.d = x.d AND g.k = x.k LEFT JOIN kids ON kids.d = x.d AND kids.k = x.k GROUP BY ALL)
SELECT g.conv_id, CAST(g.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(g.n AS BIGINT) AS n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
  CAST(sub.leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(g.ids, '')) AS ends_sha256
FROM g LEFT JOIN up ON up.d = g.d AND up.k = g.k LEFT JOIN g q ON q.d = g.d - 1 AND q.k = up.parent
LEFT JOIN kids ON kids.d = g.d AND kids.k = g.k JOIN sub ON sub.hd = g.d AND sub.hk = g.k
"""
