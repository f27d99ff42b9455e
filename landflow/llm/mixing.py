"""Mixing sources to target weights by hash-threshold histograms.

Word counts are summed by source and hash bucket; the bucket where a source's
budget runs out is found from running sums, and only that bucket is split
again by the next hash bits. Rows are then kept by comparing their hash with
their source's threshold: nothing is sorted.

Cases: a null text has size 0 and is never taken; a null source is a source of
its own; equal rows (one doc_id and text) have equal hashes: where a budget ends
among them, as many as come nearest are taken, by histograms of a row salt; an empty
table gives an empty result; other columns are ignored by ``mix`` and kept, repeated
with their row, by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landflow.llm.columns import plain
from landflow.session import materialize

#: Relative weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated at most this often.
MOST = 3
#: Hash bits per histogram level, and levels (48 bits of an md5 in all).
BITS, LEVELS = 12, 4
#: Java's \\x0B is written out: a class is a set of code points in both engines.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(doc_id, text):
    return F.conv(F.substring(F.md5(F.concat_ws(":", doc_id.cast("string"), F.md5(text))), 1, 12), 16, 10).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: one row per source.

    A source stops at ``most`` times its size; the excess goes to the others by
    weight. With the sources in order of cap per weight, those below the water
    level are capped; the level is the rest over the remaining weight.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", most * F.col("source_size"))
    by = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(every))
              .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                          / F.sum("w").over(after)))
    # the level at the first source that it does not fill holds for all after
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level")))
    per = per.withColumn("final", level.over(every)["level"])
    return per.select("source", "source_size",
                      F.least(F.col("cap").cast("double"),
                              F.coalesce(F.col("final") * F.col("w"), F.col("cap").cast("double"))).alias("target"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       _hash(F.col("doc_id"), F.col("text")).alias("h"))


def _cuts(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` (s, rest, other columns) with ``below`` and ``tie``: of the rows
    (s, h, size) with ``h < below``, and ``tie`` of those with ``h = below``, the
    sizes come nearest to ``rest``.

    One histogram a level; only the bucket where ``rest`` runs out is split again.
    """
    names = state.columns
    state = state.withColumns({"below": F.lit(0).cast("long"), "left": F.col("rest").cast("double"),
                               "tie": F.lit(0).cast("long"), "done": F.lit(False)})
    for k in range(1, LEVELS + 1):
        step = 1 << (BITS * (LEVELS - k))
        at = state.select(F.col("s").alias("of"), "below", "left").where(~F.col("done"))
        inside = rows.join(at, F.col("s").eqNullSafe(F.col("of"))).where(
            (F.col("h") >= F.col("below")) & (F.col("h") < F.col("below") + F.lit(step << BITS)))
        hist = inside.groupBy("of", F.floor(F.col("h") / step).alias("b")).agg(
            F.sum("size").alias("n"), F.count("*").alias("rows"), F.first("left").alias("left"))
        hist = hist.withColumn("run", F.sum("n").over(Window.partitionBy("of").orderBy("b")))
        used = F.col("run") - F.col("n")
        # in a bucket of the last level all rows are equal: take what comes nearest
        some = F.floor(F.try_divide((F.col("left") - used) * F.col("rows"), F.col("n")) + 0.5)
        cut = hist.where(F.col("run") > F.col("left")).groupBy(F.col("of").alias("cs")).agg(
            F.min(F.struct("b", used.alias("used"), F.greatest(some, F.lit(0)).cast("long").alias("some"), "rows")).alias("cut"))
        whole = F.lit(k == LEVELS) & (F.col("cut.some") >= F.col("cut.rows"))
        state = materialize(state.join(cut, F.col("s").eqNullSafe(F.col("cs")), "left").select(
            *names, (F.col("left") - F.coalesce(F.col("cut.used"), F.lit(0))).alias("left"),
            F.when(F.col("done"), F.col("below"))
             .when(F.col("cut").isNull(), F.col("below") + F.lit(step << BITS))
             .otherwise((F.col("cut.b") + whole.cast("int")) * step).alias("below"),
            F.when(F.lit(k == LEVELS) & ~whole & ~F.col("done"), F.col("cut.some")).otherwise(0).cast("long").alias("tie"),
            (F.col("done") | F.col("cut").isNull()).alias("done")), "mix-level")
    return state.select(*names, "below", F.coalesce("tie", F.lit(0)).alias("tie"))


def thresholds(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """s (the source), source_size, target, epochs, rest, below, tie: each row is
    taken ``epochs`` times, once more where its hash is under ``below``, and so are
    ``tie`` of the rows whose hash is ``below``."""
    state = targets(sized, weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0)
    state = materialize(state.withColumn("epochs", epochs.cast("long")).select(
        F.col("source").alias("s"), "source_size", "target", "epochs",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest")), "mix-targets")
    return _cuts(sized.select(F.col("source").alias("s"), "h", "size"), state)


def _taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (with __of, a source, and __h) with their source's cuts (__ before
    each name) and __copies, how often each is taken. Rows among which a budget ends
    are written once with a salt each, and the salts are cut like hashes."""
    cut = cuts.select(*[F.col(c).alias(f"__{c}") for c in cuts.columns])
    met = rows.join(cut, F.col("__of").eqNullSafe(F.col("__s"))).drop("__s")
    copies = F.col("__epochs") + (F.col("__h") < F.col("__below")).cast("long")
    ties = cuts.where("tie > 0")
    if ties.isEmpty():
        return met.withColumn("__copies", copies)
    tied = (F.col("__h") == F.col("__below")) & (F.col("__tie") > 0)
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << (BITS * LEVELS)))
    among = materialize(met.where(tied).withColumn("__salt", salt), "mix-ties")
    first = _cuts(among.select(F.col("__of").alias("s"), F.col("__salt").alias("h"), F.lit(1).alias("size")),
                  materialize(ties.select("s", F.col("tie").alias("rest")), "mix-ties"))
    first = first.select(F.col("s").alias("__s"), F.col("below").alias("__first"))
    settled = among.join(first, F.col("__of").eqNullSafe(F.col("__s"))).withColumn(
        "__copies", F.col("__epochs") + (F.col("__salt") < F.col("__first")).cast("long"))
    return met.where(~tied).withColumn("__copies", copies).unionByName(settled.drop("__s", "__first", "__salt"))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    sized = materialize(_sized(docs), "mix-sizes")
    rows = sized.select("doc_id", "size", F.col("source").alias("__of"), F.col("h").alias("__h"))
    return _taken(rows, thresholds(sized, weights, most)).select(
        "doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("size") * F.col("__copies")).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    sized = materialize(_sized(docs), "mix-sizes")
    safe = plain(docs)  # its names are its own, none begins with __
    rows = safe.where(n_words(F.col("text")) > 0).withColumns({"__of": F.col("source"), "__h": _hash(F.col("doc_id"), F.col("text"))})
    taken = _taken(rows, thresholds(sized, weights, most))
    return taken.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int")))).select(*safe.columns).toDF(*docs.columns)


ORACLE = r"""
WITH e AS (SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size,
  CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), md5(text))), 1, 12) AS BIGINT) AS h FROM documents),
d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, h) AS place FROM e),
p AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, 3 * CAST(SUM(size) AS BIGINT) AS cap,
  CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM d GROUP BY source),
q AS (SELECT *, (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / SUM(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM p),
f AS (SELECT arg_min(level, cap / w) AS final FROM q WHERE level * w <= cap),
t AS (SELECT source, source_size, LEAST(cap::DOUBLE, COALESCE(final * w, cap::DOUBLE)) AS target,
  CASE WHEN source_size > 0 THEN CAST(FLOOR(LEAST(cap::DOUBLE, COALESCE(final * w, cap::DOUBLE)) / source_size + 1e-12) AS BIGINT) ELSE 0 END AS epochs FROM q, f),
g AS (SELECT source, h, SUM(size) AS n, COUNT(*) AS c, SUM(SUM(size)) OVER (PARTITION BY source ORDER BY h) AS run FROM d GROUP BY source, h),
b AS (SELECT g.source, MIN(h) AS below, ARG_MIN(FLOOR((target - epochs * source_size - (run - n)) * c / n + 0.5), h) AS tie
  FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source WHERE run > target - epochs * source_size GROUP BY g.source)
SELECT d.doc_id, d.size, t.source_size, t.target,
  CAST(d.size * (t.epochs + CASE WHEN b.below IS NULL OR d.h < b.below OR (d.h = b.below AND d.place <= b.tie) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""
