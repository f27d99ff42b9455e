"""Quality rules: base limits, then robust multivariate outliers.

Five transformed statistics make a document's vector. For each language and
source, the minimum covariance determinant (MCD) estimate gives a centre and a
covariance that the outliers don't pull: from two starts, concentration steps
take the mean and covariance of the three quarters of the documents that lie
nearest under the last ones, and the start that ends with the smaller
determinant counts. A document far off by Mahalanobis distance is rejected.

Both estimates are drawn to the corpus's median and spread by PRIOR documents'
weight, at every group size, so a small group is judged much like the corpus.

Everything is DataFrame expressions. Distances come from the Cholesky factor
by forward substitution. Groups' estimates are joined by key, as a broadcast where their
counted size allows, so a hot group isn't dealt to one task; else AQE splits it.
A hot group is only ever summed, by partial aggregates.

Cases: a null or blank text has no words and fails the base limits; null
languages and sources are groups of their own; repeated rows count each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.llm.columns import plain
from landflow.session import bounded_broadcast, materialize

#: Least words, and the most percent of words in repeated 5-word windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Share of a group that concentration keeps, its consistency factor for five
#: normal dimensions, steps, and the weight of the corpus in documents.
SHARE, CONSISTENCY, STEPS, PRIOR = 0.75, 1.41, 5, 50
#: Least standard deviations, so that a rare trait isn't rejected for rarity.
FLOORS = (0.3, 0.15, 0.5, 0.1, 0.05)
#: Squared distance beyond which a document is rejected (chi-square of five
#: degrees exceeds it about once in 10 million).
CUTOFF = 42.0
P = len(FLOORS)
_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it occurs."""
    return F.transform(F.array(value), use)[0]


def _windows(words: Column) -> Column:
    """Hashes of the 5-word windows of an array of five words or more."""
    return F.transform(F.slice(words, 1, F.size(words) - 4),
                       lambda w, k: F.xxhash64(w, *[F.get(words, k + j) for j in range(1, 5)]))


def _repeated(s: Column) -> Column:
    """Sorted positions of the windows that occur again, of sorted (h, i)."""
    twice = F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def _covered(windows: Column) -> Column:
    """Words in repeated windows: each such window adds those of its five words
    that the one before it lacks."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    fresh = lambda at: F.transform(at, lambda i, k: F.coalesce(F.least(i - F.get(at, k - 1), F.lit(5)), F.lit(5)))
    return _let(pairs, lambda s: _let(_repeated(s), lambda at: F.aggregate(fresh(at), F.lit(0), lambda n, x: n + x)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, h (of the row), and the counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", "lang", "source", F.xxhash64("text", "lang", "source").alias("h"), text.alias("text"),
                      F.array_remove(F.split(text, _SPACE), "").alias("words"))
    out = out.withColumn("windows", F.when(F.size("words") >= 6, _windows(F.col("words"))))
    dup = F.col("windows").isNotNull() & (F.size(F.array_distinct("windows")) < F.size("windows"))
    lines = F.col("lines")
    out = out.select(
        "doc_id", "lang", "source", "h", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.split("text", "\n").alias("lines"), F.when(dup, _covered(F.col("windows"))).otherwise(0).cast("long").alias("n_repeat_words"))
    # lines are looked into only where two are equal
    full = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    again = F.when(F.size(F.array_distinct(lines)) < F.size(lines), F.size(full) - F.size(F.array_distinct(full))).otherwise(0)
    return out.withColumn("n_dup_lines", again.cast("long")).drop("lines")


def _vector() -> list[Column]:
    n, c = F.col("n_words"), F.col("word_chars")
    return [F.log1p(n), F.log((c + 1) / (n + 1)), F.log1p(1000 * F.col("n_symbols") / (c + 1)),
            F.log1p(F.col("n_dup_lines")) / 4, F.col("n_repeat_words") / (n + 1)]


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _factored(state: DataFrame) -> DataFrame:
    """Adds the Cholesky factor (l_i_j) and half the log determinant of c_i_j."""
    for i in range(P):
        for j in range(i + 1):
            v = F.col(f"c_{i}_{j}")
            for k in range(j):
                v = v - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            v = F.sqrt(F.greatest(v, F.lit(1e-9))) if i == j else v / F.col(f"l_{j}_{j}")
            state = state.withColumn(f"l_{i}_{j}", v)
    det = sum((F.log(f"l_{i}_{i}") for i in range(P)), F.lit(0.0))
    return materialize(state.select("g", "start", *[f"m_{i}" for i in range(P)], *[f"l_{i}_{j}" for i, j in PAIRS], det.alias("det")), "mcd")


def _distance(rows: DataFrame) -> DataFrame:
    for i in range(P):
        v = F.col(f"x_{i}") - F.col(f"m_{i}")
        for k in range(i):
            v = v - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        rows = rows.withColumn(f"z_{i}", v / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d", sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(P)), F.lit(0.0)))


def _moments(rows: DataFrame, prior, factor: float) -> DataFrame:
    """Centre and covariance by g and start, drawn to the corpus's."""
    sums = rows.groupBy("g", "start").agg(F.count("*").alias("n"), *[F.avg(f"x_{i}").alias(f"a_{i}") for i in range(P)],
                                          *[F.avg(F.col(f"x_{i}") * F.col(f"x_{j}")).alias(f"q_{i}_{j}") for i, j in PAIRS])
    got = prior(sums)
    w = F.col("n") / (F.col("n") + PRIOR)
    out = [(w * F.col(f"a_{i}") + (1 - w) * F.col(f"pm_{i}")).alias(f"m_{i}") for i in range(P)]
    for i, j in PAIRS:
        c = w * factor * (F.col(f"q_{i}_{j}") - F.col(f"a_{i}") * F.col(f"a_{j}"))
        if i == j:
            c = F.greatest(c + (1 - w) * F.col(f"ps_{i}") ** 2, F.lit(0.0)) + FLOORS[i] ** 2
        out.append(c.alias(f"c_{i}_{j}"))
    return got.select("g", "start", *out)


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, n_words, the counts, base_failed, kept, and distance, h."""
    stats = materialize(statistics(docs), "quality-stats")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = stats.withColumn("base_failed", failed).withColumn("g", F.to_json(F.struct("lang", "source")))
    rows = rows.withColumns({f"x_{i}": v.cast("double") for i, v in enumerate(_vector())})
    fit = rows.where(~F.col("base_failed")).select("g", *[f"x_{i}" for i in range(P)])
    # one row of the corpus's medians and spreads, as literals from here on
    med = fit.agg(*[F.percentile_approx(f"x_{i}", [0.25, 0.5, 0.75], 10_000).alias(f"q{i}") for i in range(P)]).first()
    quart = [med[f"q{i}"] or [0.0, 0.0, 0.0] for i in range(P)]
    pm = {f"pm_{i}": F.lit(float(quart[i][1])) for i in range(P)}
    ps = {f"ps_{i}": F.lit((quart[i][2] - quart[i][0]) / 1.349) for i in range(P)}
    prior = lambda df: df.withColumns(pm | ps)

    def drawn(part: DataFrame, factor: float) -> DataFrame:
        return _factored(_moments(part, prior, factor))

    groups = fit.groupBy("g").agg(*[F.percentile_approx(f"x_{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)], F.count("*").alias("n"))
    w = F.col("n") / (F.col("n") + PRIOR)
    g0 = prior(groups).select("g", F.lit(0).alias("start"), *[(w * F.col(f"q{i}")[1] + (1 - w) * F.col(f"pm_{i}")).alias(f"m_{i}") for i in range(P)],
                              *[(w * ((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 + (1 - w) * F.col(f"ps_{i}") ** 2 + FLOORS[i] ** 2
                                 if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in PAIRS])
    state = _factored(g0).unionByName(drawn(fit.withColumn("start", F.lit(1)), 1.0))
    for _ in range(STEPS):
        far = materialize(_distance(fit.join(bounded_broadcast(state), "g")).select("g", "start", "d", *[f"x_{i}" for i in range(P)]), "mcd-rows")
        near = bounded_broadcast(far.groupBy("g", "start").agg(F.percentile_approx("d", F.lit(SHARE), 1000).alias("t")))
        state = drawn(far.join(near, ["g", "start"]).where("d <= t"), CONSISTENCY)
    best = state.groupBy("g").agg(F.min_by("start", F.struct("det", "start")).alias("start"))
    chosen = bounded_broadcast(state.join(best, ["g", "start"]))
    told = _distance(rows.join(chosen, "g", "left"))
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & F.coalesce(F.col("d") <= cutoff, F.lit(True))).alias("kept"),
                       F.col("d").alias("distance"), "h")


def passed(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    safe = plain(docs)
    bad = judge(safe, cutoff).where(~F.col("kept")).select(F.struct("doc_id", "h").alias("row_key")).distinct()
    own = F.struct(F.col("doc_id"), F.xxhash64("text", "lang", "source").alias("h"))
    return safe.join(bad, own.eqNullSafe(F.col("row_key")), "left_anti").toDF(*docs.columns)
