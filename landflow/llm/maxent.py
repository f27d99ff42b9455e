"""Language-model scores by a hashed maximum-entropy model.

A token's probability is P(class | context) * P(word | class, context). Both are
softmax models over the same hashed features of the words before: the last word,
the last two (n-grams) and the one before the last (a skip).
A feature's hash names a row of one small weight table; within a class, class and
feature are hashed together.

The ``HEADS * SLOTS`` most frequent words are dealt over the head classes; all
others go to one of ``TAILS`` classes by their last letters, where a word's share
is its add-one count, and one slot is left for words never seen. Class and word
biases are log counts, so without weights the model is the unigram model.

Training is distributed: in each of ``ROUNDS`` rounds (which share the training
documents out by hash) tasks start from the current table, take adaptive
gradient steps over their documents and return the changed rows; a row's change
is averaged by its visits. Scoring runs batches of sparse rows through numpy.

Word counts are a distributed table. Tasks carry at most ``KNOWN`` of the most
frequent words; the counts of all others are joined on the words' 64-bit hashes,
which also tell words apart (two of 10^8 words share one with a chance of 0.0003).
The weight table is the only thing of fixed size; it passes through the driver,
as do at most ``KNOWN`` counts.

Cases: a null or empty text is its end token; a null doc_id is a training row;
repeated rows count and are scored each; without training rows every token is
unknown and scores come from uniform classes; very long texts are read in pieces;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.session import materialize

#: Head and tail classes, words of a head class; rows of the weight table (a power of two).
HEADS, TAILS, SLOTS, ROW_BITS = 36, 12, 48, 14
WIDTH = HEADS + TAILS
#: Rounds of training, step length, tokens of a gradient step.
ROUNDS, STEP, STEP_TOKENS = 3, 0.15, 8192
#: Largest weight.
MOST = 10.0
#: Words whose counts tasks carry; tokens of a chunk, bytes of a piece of text.
KNOWN, CHUNK, PIECE = 500_000, 65_536, 1 << 20
#: The end token: no word, as it is white space.
END = b"\n"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_ODD = np.uint64(0x85EBCA77C2B2AE63)


def held_out(doc_id):
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 7 == 2, F.lit(False))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def pieces(text: str | None) -> Iterator[tuple[list[bytes], int]]:
    """(words, how many of them only lead in) of a text, its end token last."""
    low = (text or "").encode("utf-8", "surrogatepass").lower()
    at, lead = 0, []
    while len(low) - at > PIECE:
        cut = _SPACE.search(low, at + PIECE)
        if not cut:
            break
        words = lead + low[at:cut.start()].split()
        yield words, len(lead)
        at, lead = cut.start(), words[-2:]
    yield [*lead, *low[at:].split(), END], len(lead)


@dataclass
class Tokens:
    """Tokens of a chunk: owner, the two hashes before, and distinct words."""

    owner: np.ndarray
    before: list[np.ndarray]
    unique: np.ndarray
    number: np.ndarray  # of a token among the distinct words
    ending: np.ndarray  # tail class of each distinct word


def endings(words: list[bytes]) -> np.ndarray:
    """Tail class of each word, by its last two bytes."""
    flat = np.frombuffer(b" ".join(words), np.uint8).astype(np.uint64)
    last = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 2
    return ((flat[last] * np.uint64(257) + flat[np.maximum(last - 1, 0)]) * _ODD >> np.uint64(40)).astype(np.int64) % TAILS


def chunks(texts: list[str | None]) -> Iterator[Tokens]:
    words: list[bytes] = []
    owners, sizes, leads = [], [], []

    def out() -> Tokens:
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        size = np.array(sizes)
        place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
        keep = place >= np.repeat(leads, size)
        before = []
        for k in (1, 2):
            p = np.zeros(len(h), np.uint64)
            p[k:] = h[:-k]
            p[place < k] = 0
            before.append(p[keep])
        unique, first, number = np.unique(h, return_index=True, return_inverse=True)
        got = Tokens(np.repeat(owners, size)[keep], before, unique, number[keep], endings(words)[first])
        for x in (words, owners, sizes, leads):
            x.clear()
        return got

    for i, text in enumerate(texts):
        for part, lead in pieces(text):
            words.extend(part)
            owners.append(i)
            sizes.append(len(part))
            leads.append(lead)
            if len(words) >= CHUNK:
                yield out()
    if words:
        yield out()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        nonlocal held, size
        h, e, c = (np.concatenate(x) for x in zip(*held))
        unique, first, number = np.unique(h, return_index=True, return_inverse=True)
        total = np.bincount(number, weights=c).astype(np.int64)
        held, size = [], 0
        return pa.record_batch([pa.array(unique.view(np.int64)), pa.array(e[first]), pa.array(total)], ["h", "ending", "c"])

    for batch in batches:
        for t in chunks(batch["text"].to_pylist()):
            c = np.bincount(t.number, minlength=len(t.unique))
            held.append((t.unique[c > 0], t.ending[c > 0], c[c > 0]))
            size += len(held[-1][0])
            if size >= 1_000_000:
                yield out()
    if held:
        yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    """h, ending, c: occurrences of every word and of the end token."""
    return texts.mapInArrow(_counts, "h long, ending long, c long").groupBy("h").agg(
        F.min("ending").alias("ending"), F.sum("c").alias("c"))


@dataclass
class Model:
    """What tasks carry: known counts, head words, biases and the weight table."""

    total: int
    distinct: int
    least: int  # words counted at least so often are known
    hashes: np.ndarray  # of the known words, sorted
    counts: np.ndarray
    head: np.ndarray  # number of a head word, or -1
    class_bias: np.ndarray
    slot_bias: np.ndarray  # by head class; -inf where a class has no word
    tail_mass: np.ndarray  # add-one counts of each tail class
    weights: np.ndarray

    def read(self, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(class, slot or -1, known count or 0, known) of each token."""
        at = np.minimum(np.searchsorted(self.hashes, t.unique), max(0, len(self.hashes) - 1))
        hit = self.hashes[at] == t.unique if len(self.hashes) else np.zeros(len(t.unique), bool)
        head = np.where(hit, self.head[at], -1) if len(self.hashes) else np.full(len(t.unique), -1)
        count = np.where(hit, self.counts[at], 0) if len(self.hashes) else np.zeros(len(t.unique), np.int64)
        cls = np.where(head >= 0, head % HEADS, HEADS + t.ending)
        slot = np.where(head >= 0, head // HEADS, -1)
        return cls[t.number], slot[t.number], count[t.number], hit[t.number]


def features(t: Tokens) -> np.ndarray:
    """Hashes of each token's context features, one row per feature."""
    p1, p2 = t.before
    return np.stack([_mixed(p1 * _SEEDS[0] + np.uint64(1)), _mixed((p1 ^ _mixed(p2 * _SEEDS[1])) * _SEEDS[1] + np.uint64(2)),
                     _mixed(p2 * _SEEDS[2] + np.uint64(3))])


def rows(context: np.ndarray, cls: np.ndarray | None = None) -> np.ndarray:
    """Weight rows of features, alone or within a class."""
    if cls is not None:
        context = _mixed(context + (cls.astype(np.uint64) + np.uint64(1)) * _ODD)
    return ((context * _ODD) >> np.uint64(64 - ROW_BITS)).astype(np.uint16)  # sorts fast


def logits(weights: np.ndarray, bias: np.ndarray, where: np.ndarray) -> np.ndarray:
    # all rows are in range: "clip" only spares the check, and one buffer takes them
    z = np.take(weights, where[0], axis=0, mode="clip")
    z += bias
    more = np.empty_like(z)
    for r in where[1:]:
        z += np.take(weights, r, axis=0, mode="clip", out=more)
    return z


def log_share(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    # biases are log shares and weights bounded: nothing overflows
    own = z[np.arange(len(z)), target]
    return own - np.log(np.exp(z, out=z).sum(1))


def log_probability(m: Model, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(natural log of each token's probability, known count, known); a tail word
    still lacks the log of its add-one count where it isn't known."""
    cls, slot, count, known = m.read(t)
    f = features(t)
    out = np.empty(len(cls))
    for lo in range(0, len(cls), STEP_TOKENS):
        part = slice(lo, lo + STEP_TOKENS)
        c, s = cls[part], slot[part]
        got = log_share(logits(m.weights, m.class_bias, rows(f[:, part])), c).astype(np.float64)
        inner = np.flatnonzero(s >= 0)
        got[inner] += log_share(logits(m.weights, m.slot_bias[c[inner]], rows(f[:, part][:, inner], c[inner])), s[inner])
        tail = np.flatnonzero(s < 0)
        got[tail] += np.log(count[part][tail] + 1.0) - np.log(m.tail_mass[c[tail] - HEADS])
        out[part] = got
    return out, count, known


def _step(weights: np.ndarray, power: np.ndarray, visits: np.ndarray, bias: np.ndarray, where: np.ndarray, target: np.ndarray) -> None:
    """One adaptive gradient step on a batch, summed by row of the table."""
    z = logits(weights, bias, where)
    np.exp(z, out=z)
    z *= (1 / z.sum(1))[:, None]
    z[np.arange(len(z)), target] -= 1
    flat = where.ravel()
    order = np.argsort(flat, kind="stable")
    first = np.flatnonzero(np.diff(flat[order], prepend=-1))
    found = flat[order[first]]
    seen = np.diff(first, append=len(flat))
    order %= len(target)
    g = z[order[first]]
    # rows met again: first all second times, then all third, and the rest row by row
    left, k = np.flatnonzero(seen > 1), 1
    while len(left) and k < 8:
        g[left] += z[order[first[left] + k]]
        k += 1
        left = left[seen[left] > k]
    for i in left.tolist():
        g[i] += z[order[first[i] + k:first[i] + seen[i]]].sum(0)
    power[found] += np.einsum("ij,ij->i", g, g) / WIDTH
    visits[found] += seen
    g *= (STEP / np.sqrt(power[found] + 1e-6))[:, None]
    weights[found] = np.clip(weights[found] - g, -MOST, MOST)


def train_on(m: Model, weights: np.ndarray, power: np.ndarray, visits: np.ndarray, t: Tokens) -> None:
    cls, slot, _, _ = m.read(t)
    f = features(t)
    for lo in range(0, len(cls), STEP_TOKENS):
        part = slice(lo, lo + STEP_TOKENS)
        c, s = cls[part], slot[part]
        _step(weights, power, visits, m.class_bias, rows(f[:, part]), c)
        inner = np.flatnonzero(s >= 0)
        if len(inner):
            _step(weights, power, visits, m.slot_bias[c[inner]], rows(f[:, part][:, inner], c[inner]), s[inner])


#: Rows of the weight table that travel together.
_TOGETHER = 512


def _trained(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, power = m.weights.copy(), np.zeros(len(m.weights), np.float32)
        visits = np.zeros(len(m.weights), np.int64)
        for batch in batches:
            for t in chunks(batch["text"].to_pylist()):
                train_on(m, weights, power, visits, t)
        change = weights - m.weights
        for block in range(-(-len(weights) // _TOGETHER)):
            part = np.flatnonzero(visits[block * _TOGETHER:(block + 1) * _TOGETHER]) + block * _TOGETHER
            if len(part):
                yield pa.record_batch([pa.array([block]), pa.array([part.astype("<i4").tobytes()], pa.binary()),
                                       pa.array([visits[part].astype("<i8").tobytes()], pa.binary()),
                                       pa.array([change[part].astype("<f2").tobytes()], pa.binary())], ["block", "row", "visits", "change"])
    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes of each block's rows, averaged by visits, one task's rows at a time."""
    total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, r, v, c in zip(*(batch[x].to_pylist() for x in ("block", "row", "visits", "change"))):
            s, n = total.setdefault(block, (np.zeros((_TOGETHER, WIDTH)), np.zeros(_TOGETHER)))
            at = np.frombuffer(r, "<i4") - block * _TOGETHER
            seen = np.frombuffer(v, "<i8")
            s[at] += np.frombuffer(c, "<f2").reshape(-1, WIDTH).astype(np.float64) * seen[:, None]
            n[at] += seen
    for block, (s, n) in total.items():
        mean = s / np.maximum(n, 1)[:, None]
        yield pa.record_batch([pa.array([block]), pa.array([mean.astype("<f4").tobytes()], pa.binary())], ["block", "change"])


def _known_from(counts: DataFrame, known: int) -> int:
    """Least count such that at most ``known`` words have it or more."""
    # counts in some thousands of bins, however many there are
    low = F.when(F.col("c") < 1024, F.col("c")).otherwise(F.floor(F.log2("c") * 64) + (1024 - 640)).cast("long")
    bins = counts.groupBy(low.alias("bin")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    least, held = 0, 0
    for b in sorted(bins, key=lambda b: -b.bin):
        held += b.n
        if held > known:
            break
        least = b.least
    return least or 1 + max((b.least for b in bins), default=0) * 2


def prepared(counts: DataFrame, known: int = KNOWN) -> Model:
    """The model without weights, from the training documents' counts."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = _known_from(counts, known)
    top = counts.where(F.col("c") >= least).toPandas()
    h, c = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    ending = top["ending"].to_numpy(np.int64)
    order = np.argsort(h)
    h, c, ending = h[order], c[order], ending[order]
    best = np.lexsort((h, -c))[:HEADS * SLOTS]
    head = np.full(len(h), -1)
    head[best] = np.arange(len(best))
    slot_bias = np.full((HEADS, SLOTS), -np.inf, np.float32)
    n = np.arange(len(best))
    slot_bias[n % HEADS, n // HEADS] = np.log((c[best] + 1.0) / (np.bincount(n % HEADS, c[best] + 1.0, HEADS)[n % HEADS]))
    mass = np.zeros(WIDTH)
    for r in counts.groupBy("ending").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        mass[HEADS + r.ending] = r.c + r.n
    np.subtract.at(mass, HEADS + ending[best], c[best] + 1.0)
    mass[HEADS:] += 1
    np.add.at(mass, n % HEADS, c[best] + 1.0)
    bias = np.full(WIDTH, -np.inf, np.float32)
    bias[mass > 0] = np.log(mass[mass > 0] / mass.sum())
    return Model(total, distinct, least, h, c, head, bias, slot_bias, mass[HEADS:], np.zeros((1 << ROW_BITS, WIDTH), np.float32))


def fit(texts: DataFrame, counts: DataFrame, rounds: int = ROUNDS, known: int = KNOWN) -> Model:
    """The model of the training documents (a column ``text``)."""
    m = prepared(counts, known)
    for k in range(rounds):
        share = texts.where(F.pmod(F.xxhash64("text", F.lit("round")), F.lit(rounds)) == k)
        change = share.mapInArrow(_trained(m), "block long, row binary, visits binary, change binary")
        blocks = len(m.weights) // _TOGETHER
        got = change.repartition(blocks, "block").mapInArrow(_averaged, "block long, change binary").collect()
        weights = m.weights.copy()
        for r in got:  # one small table, whatever the input
            weights[r.block * _TOGETHER:(r.block + 1) * _TOGETHER] += np.frombuffer(r.change, "<f4").reshape(-1, WIDTH)
        m.weights = weights
    return m


def _scored(m: Model):
    names = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "known_log", "score", "rest"]
    log10 = np.log(10.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n = part.num_rows
                tokens, known, base, score = (np.zeros(n) for _ in range(4))
                rest: list[list[np.ndarray]] = [[] for _ in range(n)]
                for t in chunks(part["text"].to_pylist()):
                    p, count, hit = log_probability(m, t)
                    tokens += np.bincount(t.owner, minlength=n)
                    known += np.bincount(t.owner, hit, minlength=n)
                    base += np.bincount(t.owner, np.log10(count + 1.0), minlength=n)
                    score += np.bincount(t.owner, p / log10, minlength=n)
                    other = np.flatnonzero(~hit)
                    owner, h = t.owner[other], t.unique.view(np.int64)[t.number[other]]
                    cut = np.flatnonzero(np.diff(owner)) + 1
                    for o, x in zip(owner[np.append(0, cut)] if len(owner) else [], np.split(h, cut)):
                        rest[o].append(x)
                ids = np.arange(rid, rid + n)
                rid += n
                yield pa.record_batch([pa.array(ids), part["doc_id"], part["held_out"], pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)),
                                       pa.array(base), pa.array(score), pa.array([np.concatenate(r) if r else None for r in rest], pa.list_(pa.int64()))], names)
    return run


def score(docs: DataFrame, m: Model, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    mine = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"].cast("string").alias("text"))
    placed = materialize(mine.mapInArrow(_scored(m), "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, "
                                                     "score double, rest array<long>"), "lm-scores")
    # rarer words: their counts are joined; a word never seen adds log 1
    rest = placed.where("rest is not null").select("rid", F.explode("rest").alias("h")).groupBy("rid", "h").agg(F.count("*").alias("k"))
    rare = counts.where(F.col("c") < m.least).select("h", "c")
    more = rest.join(rare, "h").groupBy("rid").agg(F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more"), F.sum("k").alias("found"))
    joined = placed.drop("rest").join(more, "rid", "left").withColumn("more", F.coalesce("more", F.lit(0.0)))
    floor = float(np.log10(m.total + m.distinct + 1))
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
                         F.lit(m.total).cast("long").alias("train_tokens"),
                         (F.col("known_log") + F.col("more") - F.col("n_tokens") * floor).alias("base_score"),
                         (F.col("score") + F.col("more")).alias("score"))


def scored(docs: DataFrame, rounds: int = ROUNDS, known: int = KNOWN) -> DataFrame:
    """Scores of all documents by the model of those that aren't held out."""
    texts = docs.where(~held_out(docs["doc_id"])).select(docs["text"].cast("string").alias("text"))
    counts = materialize(word_counts(texts), "word-counts")
    return score(docs, fit(texts, counts, rounds, known), counts)
