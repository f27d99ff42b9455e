"""Near-duplicates by an LSH forest over MinHash signatures.

A document is the set of its distinct 5-word shingles (64-bit hashes). Equal
sets are one node. A tree orders a node's 128 signature values from a start of
its own; nodes that share a prefix of three values form a region:

1. every node of a region is a candidate of the region's smallest node; the
   candidates whose sets pass ``100 * common >= 75 * union`` are links;
2. a region whose nodes are then all one component needs nothing more. The nodes
   of all others are sorted by their whole signature order, in ``ORDERS`` orders.
   Neighbours of one component form a run; a run's candidates are the next
   ``BESIDE`` runs of its region, which share the longest prefixes with it: the
   depth follows the crowd. A run stands there by its end, and by the centre of its
   component's nodes in the region, the one closest to their majority: copies of one
   text are often closer to it than to each other. Links merge components, so runs
   grow and come to meet others; rounds go on until a round finds no link.

Links are confirmed on whole sets; estimates from signatures only drop
candidates more than five standard deviations under the threshold, and a bound on
the common shingles, from one bitmap a set, only those that can't be links. Sixteen
trees at depth three miss a pair at the threshold with probability 0.0002,
and less often above it. In a crowded region a pair of its own, close to nothing
else above the threshold, must come to lie beside each other in one of the
orders: README has the measured recall. Work stays linear in the crowd.

Cases: a null or blank text has no shingles and is linked with nothing; equal
texts and repeated rows are one component; a null doc_id is ignored as a
component's id unless all are null; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.llm.columns import plain
from landflow.session import bounded_broadcast, materialize

WORDS, VALUES, TREES = 5, 128, 16
#: Prefix length of regions, and of the orders in which crowded ones are sorted.
DEPTH, LONGEST = 3, 12
#: Orders of the nodes of open regions, and following runs that a run is compared with.
ORDERS, BESIDE = 64, 8
#: Rows of one component in a batch whose centre goes on through their region.
CROWD = 64
#: Equal signature values under which a candidate is dropped: 0.55 of them.
LEAST_EQUAL = 70
#: Bits of a set's bitmap: a power of two.
BITS = 1024
_RNG = np.random.default_rng(97)
_MUL = _RNG.integers(1, 1 << 62, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 62, VALUES, dtype=np.uint64)
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes; only A-Z are lower-cased, and words end
    at the six ASCII white space characters."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - WORDS + 1)
    total = np.full(n, min(len(h), WORDS), np.uint64)
    for k in range(min(WORDS, len(h))):
        total = _mixed(total + h[k:k + n] * _STEP[k])
    return np.unique(total)


def signature(s: np.ndarray) -> np.ndarray:
    out = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(s), 2048):  # bounded memory for very long texts
        out = np.minimum(out, (_MUL[:, None] * s[None, lo:lo + 2048] + _ADD[:, None]).min(1))
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bitmap(s: np.ndarray) -> tuple[np.ndarray, int]:
    """The bits that the shingles set, and how many shingles share a bit with one before.

    A common shingle sets a common bit, so two sets have at most as many in common
    as common bits, and the spare shingles of either."""
    at = np.zeros(BITS, bool)
    at[s >> np.uint64(65 - BITS.bit_length())] = True
    return np.packbits(at).view(np.int64), len(s) - int(at.sum())


def _node(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            sizes, nodes, sigs, maps, spares = [], [], [], [], []
            for text in part["text"]:
                s = shingles(text.as_py())
                sizes.append(len(s))
                nodes.append(_node(s) if len(s) else None)
                sigs.append(signature(s) if len(s) else None)
                bits, spare = bitmap(s) if len(s) else (None, None)
                maps.append(bits)
                spares.append(spare)
            yield pa.record_batch([part["doc_id"], part["h"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                                   pa.array(sigs, pa.list_(pa.int32())), pa.array(maps, pa.list_(pa.int64())), pa.array(spares, pa.int64())],
                                  ["doc_id", "h", "n_shingles", "node", "sig", "bits", "spare"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            found = [s for s in map(shingles, batch["text"].slice(lo, 500).to_pylist()) if len(s)]
            yield pa.record_batch([pa.array([_node(s) for s in found], pa.int64()),
                                   pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["node", "s"])


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))


def _whole(ends: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, s: whole sets of the nodes of ``ends``, from the documents with their ids."""
    ids = bounded_broadcast(nodes.join(ends, "node", "left_semi").select("rep").distinct())
    rows = docs.select(_id().alias("rep"), "text").join(ids, "rep", "left_semi").select("text")
    return materialize(rows.mapInArrow(_sets, "node long, s array<long>"), "sets")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links."""
    needed = bounded_broadcast(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    part = nodes.join(needed, "node", "left_semi")
    told = lambda c, s: part.select(F.col("node").alias(c), F.struct("sig", "bits", "spare", "n").alias(s))
    same = F.size(F.filter(F.zip_with("x.sig", "y.sig", lambda x, y: x == y), lambda z: z))
    shared = F.aggregate(F.zip_with("x.bits", "y.bits", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda t, x: t + x)
    most = shared + F.least("x.spare", "y.spare")
    may = 100 * most >= 75 * (F.col("x.n") + F.col("y.n") - most)
    near = materialize(pairs.join(told("a", "x"), "a").join(told("b", "y"), "b").where((same >= LEAST_EQUAL) & may)
                       .select("a", "b"), "near")
    sets = _whole(near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, docs)
    one = lambda c, s: sets.select(F.col("node").alias(c), F.col("s").alias(s))
    common = F.size(F.array_intersect("x", "y"))
    met = near.join(one("b", "y"), "b").join(one("a", "x"), "a")
    return materialize(met.where(100 * common >= 75 * (F.size("x") + F.size("y") - common)).select("a", "b").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """node, label of every linked node: the smallest node that it reaches.

    Each round takes the smallest label among a node and its neighbours, then
    that label's own label; a round's result is a written table.
    """
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    state = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        near = both.join(state.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        low = state.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = state.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = materialize(low.join(jump, "low").select("node", "old", F.least("low", "far").alias("label")), "labels")
        state = new.select("node", "label")
        if new.where("label != old").isEmpty():
            return state


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: only the components that they join are
    gone through again, each as one node."""
    of = lambda c, name: labels.select(F.col("node").alias(c), F.col("label").alias(name))
    ends = links.join(of("a", "la"), "a", "left").join(of("b", "lb"), "b", "left").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    joins = materialize(ends.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "joins")
    new = components(joins).select(F.col("node").alias("label"), F.col("label").alias("low"))
    alone = new.select(F.col("label").alias("node")).join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    every = labels.unionByName(alone).join(new, "label", "left")
    return materialize(every.select("node", F.coalesce("low", "label").alias("label")), "labels")


def _keys(depth: int):
    """One (tree, prefix) key per tree."""
    twice = F.concat("sig", "sig")
    step = VALUES // TREES
    return F.array(*[F.xxhash64(F.lit(t), F.slice(twice, t * step + 1, depth)) for t in range(TREES)])


def _rows(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.select("node", F.explode(_keys(depth)).alias("key"))


def _stars(rows: DataFrame, regions: DataFrame) -> DataFrame:
    return rows.join(regions.select("key", "pivot"), "key").where("node != pivot").select(
        F.col("pivot").alias("a"), F.col("node").alias("b"))


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, node, label, low: each node's place in every order. A key is the order's
    number and the signature from the order's start, as bytes that sort alike;
    ``low`` has the lowest four bits of each signature value, the bitmap folded to
    half, the set's size and its spare shingles."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            sig = np.array(part["sig"].to_pylist(), np.int32).reshape(-1, VALUES).view(np.uint32)
            bits = sig.astype(np.uint8) & 15
            half = np.array(part["bits"].to_pylist(), np.int64).reshape(-1, 2, BITS // 128)
            half = half[:, 0] | half[:, 1]
            n = np.array(part["n"].to_pylist(), np.int64)
            sizes = np.stack([n, n - np.bitwise_count(half.view(np.uint64)).sum(1, dtype=np.int64)], 1)
            low = np.concatenate([bits[:, ::2] << 4 | bits[:, 1::2], half.view(np.uint8), sizes.view(np.uint8)], 1)
            low = pa.array([x.tobytes() for x in low], pa.binary())
            twice = np.concatenate([sig, sig], 1).astype(">u4")
            for t in range(ORDERS):
                at = t * VALUES // ORDERS
                heads = np.ascontiguousarray(twice[:, at:at + LONGEST])
                yield pa.record_batch([pa.array([bytes([t]) + h.tobytes() for h in heads], pa.binary()), part["node"], part["label"], low],
                                      ["key", "node", "label", "low"])


def _neighbours(depth: int):
    return lambda batches: _candidates(batches, 1 + 4 * depth)


def _equal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the four-bit values of each row, packed in words, are equal."""
    differ = x ^ y
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    return VALUES - np.bitwise_count(differ & np.uint64(0x1111111111111111)).sum(1, dtype=np.int64)


def _centres(region: np.ndarray, label: np.ndarray, node: np.ndarray, packed: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's centre, and how many rows have it: of the rows of its region and label the
    one that agrees most with their majority, bit by bit: in signature values, then in the
    bitmap (close copies have equal signatures). Where there are one or two, each is its own."""
    centre, size = np.arange(len(node)), np.ones(len(node), np.int64)
    order = np.lexsort((label, region))
    first = np.flatnonzero(np.r_[True, (np.diff(region[order]) != 0) | (np.diff(label[order]) != 0)])
    sizes = np.diff(np.r_[first, len(order)])
    rows = order[np.repeat(sizes > 2, sizes)]
    if not len(rows):
        return centre, size
    sizes = sizes[sizes > 2]
    first, group = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)

    def most(words: np.ndarray) -> np.ndarray:
        ones = np.add.reduceat(np.unpackbits(words.view(np.uint8), axis=1), first, axis=0, dtype=np.int32)
        return np.packbits(2 * ones > sizes[:, None], axis=1).view(np.uint64)[group]

    equal = _equal(packed[rows], most(packed[rows]))
    apart = np.bitwise_count(half[rows] ^ most(half[rows])).sum(1, dtype=np.int64)
    best = np.lexsort((node[rows], apart, -equal, group))[first]
    centre[rows], size[rows] = rows[best][group], sizes[group]
    return centre, size


def _candidates(batches: Iterator[pa.RecordBatch], head_bytes: int) -> Iterator[pa.RecordBatch]:
    """Candidates among sorted keys: the end of a run of one component with the
    starts of the runs after it, within a region (the heads of keys), and in place of
    either the centre of its component there. Pairs whose lowest bits agree in too few
    values are not (equal values agree in them), nor are those whose bitmaps leave too
    few common shingles."""
    region, runs, rows, centres = None, [], [], []  # runs: [label, place of its last row], latest last; centres: places
    for batch in batches:
        # rows: node, low bits, label and number of the region; those that runs and centres still point at, then the batch's
        rows = [(*rows[at][:3], 0) for at in [*(at for _, at in runs), *centres]]
        runs, number, begun = [[label, k] for k, (label, _) in enumerate(runs)], 0, 0
        left, right = [], []
        for key, node, label, low in zip(*(batch[c].to_pylist() for c in ("key", "node", "label", "low"))):
            here = len(rows)
            if (head := key[:head_bytes]) != region:
                region, runs, number, begun = head, [], number + 1, here
            rows.append((node, low, label, number))
            if runs and runs[-1][0] == label:
                runs[-1][1] = here
                continue
            for other, at in runs:
                if other != label:
                    left.append(at)
                    right.append(here)
            runs = [*runs[1 - BESIDE:], [label, here]]
        told = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, VALUES // 2 + BITS // 16 + 16)
        packed, half, sizes = (np.ascontiguousarray(x) for x in np.split(told, [VALUES // 2, VALUES // 2 + BITS // 16], axis=1))
        packed, half, (n, spare) = packed.view(np.uint64), half.view(np.uint64), sizes.view(np.int64).reshape(-1, 2).T
        node, label, number = (np.array([r[k] for r in rows], np.int64) for k in (0, 2, 3))
        centre, of = _centres(number, label, node, packed, half)
        # the last region goes on in the next batch, with the centres of its crowds
        centres = np.unique(centre[begun:][of[begun:] >= CROWD]).tolist()
        i, j = np.array(left, np.int64), np.array(right, np.int64)
        both = np.unique(np.concatenate([x * len(node) + y for x in (i, centre[i]) for y in (j, centre[j])]))
        i, j = both // len(node), both % len(node)
        keep = []
        for lo in range(0, len(i), 20_000):
            x, y = i[lo:lo + 20_000], j[lo:lo + 20_000]
            most = np.bitwise_count(half[x] & half[y]).sum(1, dtype=np.int64) + np.minimum(spare[x], spare[y])
            keep.append((100 * most >= 75 * (n[x] + n[y] - most)) & (_equal(packed[x], packed[y]) >= LEAST_EQUAL))
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        pairs = np.sort(np.stack([node[i[keep]], node[j[keep]]], 1), axis=1)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


def _deepen(crowd: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The labels after rounds over the sorted orders of the nodes of ``crowd``."""
    mine = materialize(nodes.join(crowd.select("node").distinct(), "node", "left_semi").select("node", "sig", "bits", "n"), "crowd")
    parts = max(mine.sparkSession.sparkContext.defaultParallelism, -(-mine.count() * ORDERS // 500_000))
    tested = None
    while True:
        keys = _named(mine, labels).mapInArrow(_ordered, "key binary, node long, label long, low binary")
        pairs = keys.repartitionByRange(int(parts), "key", "node").sortWithinPartitions("key", "node").mapInArrow(
            _neighbours(DEPTH), "a long, b long").distinct()
        pairs = materialize(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = _verified(pairs, nodes, docs)
        if found.isEmpty():
            return labels
        tested = materialize(pairs if tested is None else tested.unionByName(pairs), "tested")
        labels = merged(labels, found)


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, h (of the text), n_shingles, node, label of each row."""
    signed = materialize(docs.select(docs["doc_id"].cast("long"), F.xxhash64("text").alias("h"), "text").mapInArrow(
        _signed, "doc_id long, h long, n_shingles long, node long, sig array<int>, bits array<long>, spare long"), "signed")
    nodes = materialize(signed.where("node is not null").groupBy("node").agg(
        F.min(_id()).alias("rep"), F.first(F.struct("sig", "bits", "spare", F.col("n_shingles").alias("n"))).alias("own")).select(
        "node", "rep", "own.*"), "nodes")
    rows = materialize(_rows(nodes, DEPTH), "forest")
    regions = rows.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    labels = components(_verified(materialize(_stars(rows, regions).distinct(), "stars"), nodes, docs))

    # regions of several components; two nodes are settled by their one pair
    front = materialize(_named(rows.join(regions.where("n > 2").select("key"), "key", "left_semi"), labels), "front")
    open_ = front.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    crowd = materialize(front.join(open_, "key", "left_semi").select("node").distinct(), "open")
    if not crowd.isEmpty():
        labels = _deepen(crowd, labels, nodes, docs)
    return signed.select("doc_id", "h", "n_shingles", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    placed = _placed(docs)
    first = placed.where("node is not null").groupBy("label").agg(F.min("doc_id").alias("first"))
    return placed.join(first, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component: that of the smallest doc_id (null
    last), then of the smallest hash of its text, then the smallest row. Rows
    without shingles all stay."""
    id_ = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    texts = materialize(_placed(docs).where("node is not null").groupBy("label", id_.alias("id")).agg(F.count("*").alias("c")), "texts")
    best = texts.groupBy("label").agg(F.min("id").alias("best"))
    told = materialize(texts.join(best, "label").select("id.doc_id", "id.h", (F.col("id") == F.col("best")).alias("best"), "c"), "told")
    safe = plain(docs)
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"))
    row = lambda t: t.select(F.struct("doc_id", "h").alias("row_key"))
    on = own.eqNullSafe(F.col("row_key"))
    single = safe.join(row(told.where("not best or c > 1")), on, "left_anti")
    repeated = safe.join(row(told.where("best and c > 1")), on, "left_semi").withColumn("row_all", F.struct(*safe.columns))
    # as text: maps have no order of their own
    once = repeated.groupBy(own.alias("row_key")).agg(F.min_by("row_all", F.to_json("row_all")).alias("r")).select("r.*")
    return single.unionByName(once).toDF(*docs.columns)
