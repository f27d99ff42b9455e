"""Toxicity by weak supervision.

1. Words and word beginnings that mark toxic training documents are dealt
   over many lexicon voters; fixed patterns vote too.
2. A generative label model takes the votes (found or not) of all documents:
   a voter finds with one rate in toxic and another in clean documents, so
   voters that are independent given the class have covariance
   d_i * d_j * share * (1 - share), with d the difference of the rates (their
   accuracy). The differences are the rank-one part of the vote covariance,
   fitted on the pairs of voters that agree with it; what remains are the
   correlations given the class, and a voter's evidence is divided by the voters
   it is correlated with. Only sums and products of votes are gathered.
3. A linear classifier over the presence of words and beginnings is trained
   on the model's posterior labels and scores every document.

Labels, from rows whose crc32(doc_id) mod 5 is not 0, choose the lexicons and
set the class share; the sample for both fits is at most SAMPLE labelled rows,
by hash of the id, then, where ids repeat, of id and text; equal rows count once. Scores see texts only.

Cases: null and empty texts get the score of a text without features; repeated
rows are scored each; without training labels every score is 0; an empty table
gives no rows; columns named score, predicted or held_out are replaced, others
are kept.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landflow.session import materialize

#: Most labelled rows for the fits, most features, lexicons, and least documents of a feature.
SAMPLE, FEATURES, LEXICONS, LEAST_DOCS = 10_000, 1500, 10, 4
#: Share of a lexicon feature's documents that are toxic, and its deviation from
#: chance in standard deviations (some 100,000 features are looked at).
PURE, SURE = 0.8, 7.5
#: Word beginnings of these lengths are features beside whole words.
BEGINNINGS = (4, 5, 6)
_WORD = re.compile(r"\w+")

# Fixed patterns: insults, threats, masked and spelled-out words, shouting.
PATTERNS = [
    r"\b(?:idiot|moron|stupid|dumb|imbecile|fool|loser|clown)s?\b",
    r"\b(?:scum|trash|garbage|vermin|filth)\b",
    r"\b(?:pathetic|worthless|disgusting|useless|ugly)\b",
    r"\byou(?:'re| are)\b.{0,20}\b(?:idiot|moron|stupid|scum|trash|worthless|pathetic)\b",
    r"\b(?:shut up|go to hell|get lost|drop dead)\b",
    r"\b(?:kill|hurt|hate)\s+(?:you|them|him|her|yourself)\b",
    r"\b\w+\*{2,}\w*\b",
]


def feature_set(text: str | None) -> set[str]:
    """Distinct words and, ending in ``~``, beginnings of longer words."""
    words = set(_WORD.findall((text or "").lower()))
    out = set(words)
    for n in BEGINNINGS:
        out.update([w[:n] + "~" for w in words if len(w) > n])
    return out


@dataclass
class Model:
    """What scoring needs: feature numbers, lexicons, weights."""

    vocabulary: dict[str, int]
    lexicon: np.ndarray  # lexicon of each feature, or -1
    weights: np.ndarray
    bias: float
    hit: np.ndarray  # evidence of each voter's hit
    prior: float
    accuracies: np.ndarray
    correlations: np.ndarray

    def present(self, text: str | None) -> list[int]:
        words = set(_WORD.findall((text or "").lower()))
        get, found = self.vocabulary.get, set()
        found.update(map(get, words))
        for n in BEGINNINGS:
            found.update(map(get, [w[:n] + "~" for w in words if len(w) > n]))
        found.discard(None)
        return sorted(found)

    def votes(self, text: str | None, present: list[int]) -> np.ndarray:
        out = np.zeros(LEXICONS + len(PATTERNS))
        hit = self.lexicon[present] if present else np.zeros(0, int)
        out[hit[hit >= 0]] = 1
        low = (text or "").lower()
        for k, p in enumerate(_COMPILED):
            out[LEXICONS + k] = 1 if p.search(low) else 0
        return out

    def posterior(self, text: str | None, present: list[int]) -> float:
        """Log odds of the label model; a voter that finds nothing abstains."""
        return float(self.prior + self.votes(text, present) @ self.hit)

    def score(self, text: str | None) -> float:
        z = self.bias + self.weights[self.present(text)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


_COMPILED = [re.compile(p) for p in PATTERNS]


def held_out(doc_id):
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def _association(sample: DataFrame) -> tuple[list[tuple[str, int, int, float]], int, int]:
    """(feature, documents, toxic documents, deviation from chance) of the most telling features."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            n, pos = Counter(), Counter()
            for text, y in zip(f["text"], f["toxic"]):
                got = feature_set(text)
                n.update(got)
                if y:
                    pos.update(got)
            yield pd.DataFrame({"f": list(n), "n": list(n.values()), "pos": [pos[k] for k in n]})

    size, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic or toxic == size:
        return [], size, toxic
    counts = sample.mapInPandas(run, "f string, n long, pos long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    share = toxic / size
    z = (F.col("pos") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)) * (1 - F.col("n") / (size + 1)) + 1e-9)
    top = counts.where(F.col("n") >= LEAST_DOCS).withColumn("z", z).orderBy(F.desc(F.abs("z")), "f").limit(FEATURES)
    return [(r.f, r.n, r.pos, r.z) for r in top.collect()], size, toxic


def label_model(mean: np.ndarray, cov: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rate differences, correlations given the class, evidence of a hit) by
    voter, from the moments of votes of 0 and 1."""
    m, var_y = len(mean), share * (1 - share)
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    corr = cov / np.outer(scale, scale)
    away = ~np.eye(m, dtype=bool)
    use = away
    a = np.sqrt(np.clip(np.abs(corr[use].reshape(m, -1)).mean(1), 1e-3, 0.95))
    for _ in range(50):
        for i in range(m):
            w = use[i]
            a[i] = np.clip((corr[i, w] @ a[w]) / max(1e-9, (a[w] ** 2).sum()), 0.0, 0.98)
        # pairs far from the rank-one fit are correlated given the class
        off = np.abs(corr - np.outer(a, a))
        use = (off <= max(0.1, np.quantile(off[away], 0.8))) & away
    differ = a * scale / np.sqrt(var_y)
    high = np.clip(mean + differ * (1 - share), 1e-3, 1 - 1e-3)
    low = np.clip(mean - differ * share, 1e-4, 1 - 1e-3)
    within = np.sqrt(np.maximum(share * high * (1 - high) + (1 - share) * low * (1 - low), 1e-9))
    given = np.clip((corr - np.outer(a, a)) * np.outer(scale / within, scale / within), -1, 1)
    np.fill_diagonal(given, 1)
    alike = np.where(given > 0.1, given, 0).sum(1)
    return differ, given, np.log(high / low) / alike


def _fit_linear(rows: list[np.ndarray], target: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, ridge 1e-3, by accelerated descent."""
    x = np.zeros((len(rows), n), np.float32)
    for k, r in enumerate(rows):
        x[k, r] = 1
    w, b = np.zeros(n, np.float32), 0.0
    v, vb = w.copy(), b
    rate = 4 / max(1.0, float((x.sum(1) + 1).max()))
    for step in range(400):
        p = 1 / (1 + np.exp(-np.clip(x @ v + vb, -30, 30)))
        g = (p - target).astype(np.float32)
        new, nb = v - rate * (x.T @ g / len(rows) * 20 + 1e-3 * v), vb - rate * float(g.mean()) * 20
        k = step / (step + 3)
        v, vb = new + k * (new - w), nb + k * (nb - b)
        w, b = new, nb
    return w, b


def _sample(marked: DataFrame, sample: int) -> DataFrame:
    """text, toxic: at most ``sample`` distinct rows (an id may have many), those of
    the smallest hashes."""
    place = F.xxhash64("__id", "text").alias("place")
    once = marked.groupBy("__id", place).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    once = materialize(once.select("place", "text", "toxic"), "toxic-rows")
    if once.count() <= sample:
        return once.select("text", "toxic")
    last = once.select("place").orderBy("place").limit(sample).agg(F.max("place")).first()[0]
    return materialize(once.where(F.col("place") <= last).select("text", "toxic"), "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    marks = labels.where("toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"))
    known = marks.count()
    if known > sample:
        marks = marks.where(F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1_000_000)) < int(1e6 * sample / known))
    texts = _sample(docs.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("__id")), sample)
    top, size, toxic = _association(texts)
    share = min(max((toxic + 1) / (size + 2), 0.01), 0.99)
    vocabulary = {f: k for k, (f, *_) in enumerate(top)}
    # features that nearly only toxic documents hold: those of one stem go to one
    # lexicon, the stems are dealt in order of frequency
    strong = defaultdict(list)
    for k, (f, n, pos, z) in enumerate(top):
        if pos >= PURE * n and z >= SURE:
            strong[f[:BEGINNINGS[0]]].append(k)
    lexicon = np.full(len(top), -1)
    for place, stem in enumerate(sorted(strong, key=lambda s: (-max(top[k][2] for k in strong[s]), s))):
        lexicon[strong[stem]] = place % LEXICONS
    m = LEXICONS + len(PATTERNS)
    model = Model(vocabulary, lexicon, np.zeros(len(top)), -30.0, np.zeros(m),
                  float(np.log(share / (1 - share))), np.zeros(m), np.eye(m))
    if not top:
        return model

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((m + 1, m + 1)), 0
        for f in frames:
            for text in f["text"]:
                v = np.append(model.votes(text, model.present(text)), 1.0)
                total += np.outer(v, v)
                n += 1
        if n:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    # (voters + 1)^2 sums, whatever the input
    sums = docs.select("text").mapInPandas(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((m + 1, m + 1))
    for r in sums:
        total[r.i, r.j] = r.v
    n = max(1.0, total[m, m])
    mean = total[m, :m] / n
    cov = total[:m, :m] / n - np.outer(mean, mean)
    live = np.diag(cov) > 1e-6
    if live.sum() >= 3:
        a, given, hit = label_model(mean[live], cov[np.ix_(live, live)], share)
        model.accuracies[live], model.hit[live] = a, hit
        model.correlations[np.ix_(live, live)] = given

    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            here = [model.present(t) for t in f["text"]]
            z = [model.posterior(t, p) for t, p in zip(f["text"], here)]
            yield pd.DataFrame({"p": here, "z": z})

    # the documented sample: at most SAMPLE rows of at most FEATURES numbers
    got = texts.mapInPandas(seen, "p array<int>, z double").collect()
    posterior = np.array([1 / (1 + np.exp(-np.clip(r.z, -30, 30))) for r in got])
    model.weights, model.bias = _fit_linear([np.array(r.p, int) for r in got], posterior, len(top))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    base = docs.drop("score", "predicted", "held_out")
    schema = T.StructType(base.schema.fields + [T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = pa.array([model.score(t.as_py()) for t in batch["text"]], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "score"])

    return base.mapInArrow(run, schema).withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
