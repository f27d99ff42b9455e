"""Runs of a landing: which run a job reads, and what of it is whole.

A landing may hold several runs (``run_id``, a partition column). A job reads one
run for all its families, the latest one unless it is told otherwise: a request
that this run no longer made has vanished at the source, and a request that
failed in it is not replaced by an older answer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landflow.session import bounded_broadcast
from landflow.sources.pages import Dialect, IncompleteChain, chain_keys, chain_status, run_order


class MissingRun(IncompleteChain):
    """Raised where the chosen run landed nothing of a family that a job needs."""


def run_ids(pages: DataFrame) -> DataFrame:
    """The runs of a landing (reads the partition column only)."""
    return pages.select("run_id").distinct()


def latest_run(*families: DataFrame) -> str | None:
    """The latest run of any of the families; None where no pages name a run.
    A run that died before it landed every family is still the latest."""
    named = [run_ids(p).select(F.col("run_id").cast("string").alias("run_id")) for p in families if "run_id" in p.columns]
    if not named:
        return None
    row = reduce(DataFrame.unionByName, named).agg(F.max(F.struct(run_order("run_id").alias("o"), "run_id")).alias("last")).first()
    return row["last"]["run_id"] if row["last"] is not None else None


def of_run(pages: DataFrame, run: str | None) -> DataFrame:
    """The pages of one run, without the run column (a partition filter)."""
    if "run_id" not in pages.columns:
        return pages
    return pages.where(F.col("run_id").cast("string") == F.lit(run)).drop("run_id")


def snapshot(families: dict[str, DataFrame], run: str | None = None, needed: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The families' pages of one run: ``run``, or the latest that any family has.
    A family of ``needed`` without a page in it ends the job (``MissingRun``):
    the run stopped before it came to that family."""
    run = run if run is not None else latest_run(*families.values())
    out = {name: of_run(pages, run) for name, pages in families.items()}
    lost = [name for name in needed if out[name].select("request_key").isEmpty()]
    if lost:
        raise MissingRun(f"run {run} landed nothing of {lost}, nothing loaded")
    return out


def run_manifest(families: dict[str, DataFrame], dialects: dict[str, Dialect]) -> DataFrame:
    """One row per family and run: ``(family, run_id, requests, complete, failed,
    open, latest)``; ``latest`` marks the run that a job would read."""
    parts = []
    for name, pages in families.items():
        status = chain_status(pages, dialects[name])
        run = F.col("run_id").cast("string") if "run_id" in pages.columns else F.lit(None).cast("string")
        parts.append(status.groupBy(run.alias("run_id")).agg(
            F.count(F.lit(1)).alias("requests"), F.count_if("complete").alias("complete"), F.count_if("failed").alias("failed"),
            F.count_if(~F.col("complete") & ~F.col("failed")).alias("open")).select(F.lit(name).alias("family"), "*"))
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("latest", F.coalesce(F.col("run_id") == F.lit(latest_run(*families.values())), F.col("run_id").isNull()))


# fan-out ------------------------------------------------------------------
def request_keys(parents: DataFrame, key: Column) -> DataFrame:
    """The requests that a fan-out over ``parents`` makes: one row per distinct
    key; parents without one ask for nothing."""
    return parents.select(key.alias("request_key")).where("request_key is not null").distinct()


def missing_requests(expected: DataFrame, pages: DataFrame, dialect: Dialect | str,
                     chains: DataFrame | None = None) -> DataFrame:
    """``(request_key, reason)`` of the expected requests without a complete chain:
    ``not landed``, ``failed`` or ``incomplete chain``. Chains of other requests
    don't count. ``pages`` are of one run."""
    chains = chains if chains is not None else chain_status(pages, dialect)
    told = expected.select("request_key").join(chains.select("request_key", "failed", "complete"), "request_key", "left")
    reason = F.when(F.col("complete").isNull(), F.lit("not landed")).when(F.col("failed"), F.lit("failed")).otherwise(F.lit("incomplete chain"))
    return told.where(~F.coalesce(F.col("complete"), F.lit(False))).select("request_key", reason.alias("reason"))


def expected_chains(expected: DataFrame, pages: DataFrame, dialect: Dialect | str, on_missing: str = "stop",
                    chains: DataFrame | None = None) -> DataFrame:
    """``(request_key, cut)`` of the complete chains of expected requests, size
    checked. Any expected request without one ends the job (``stop``) or is left
    out (``skip``)."""
    if on_missing not in ("skip", "stop"):
        raise ValueError(f"unknown choice {on_missing!r}")
    chains = chains if chains is not None else chain_status(pages, dialect)
    told = bounded_broadcast(expected.select("request_key").join(chains, "request_key", "left").select("request_key", "failed", "cut", "complete"))
    if on_missing == "stop":
        lost = missing_requests(told, pages, dialect, told).take(3)
        if lost:
            raise IncompleteChain(f"requests without a complete answer, nothing loaded: {[tuple(r) for r in lost]}")
    return told.where("complete").select("request_key", "cut")


# days ---------------------------------------------------------------------
def day_chains(pages: DataFrame, dialect: Dialect | str, day: str = "_day") -> DataFrame:
    """The chains of each day's latest run with the day's verdict:
    ``(request_key[, run_id], day, failed, cut, complete, whole)``. A day is
    ``whole`` when every chain landed for it in that run is complete."""
    chains = chain_status(pages, dialect, by=(day,))
    if "run_id" in chains.columns:
        last = chains.groupBy(day).agg(F.max(F.struct(run_order("run_id").alias("o"), "run_id")).alias("last")).select(day, "last.run_id")
        chains = chains.join(last, [day, "run_id"])
    days = chains.groupBy(day).agg(F.min("complete").alias("whole"))
    return chains.join(days, day).select(*chain_keys(pages), day, "failed", "cut", "complete", "whole")


def incomplete_days(pages: DataFrame, dialect: Dialect | str, day: str = "_day") -> DataFrame:
    """``(day, request_key, reason)``: the chains that keep a day from being
    loaded, for the quarantine."""
    lost = day_chains(pages, dialect, day).where("not complete")
    return lost.select(F.col(day).alias("day"), "request_key",
                       F.when(F.col("failed"), F.lit("failed")).otherwise(F.lit("incomplete chain")).alias("reason"))
