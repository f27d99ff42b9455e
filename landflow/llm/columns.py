"""A user's columns under names that can't clash with an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame

READ = ("doc_id", "text", "lang", "source")


def plain(docs: DataFrame) -> DataFrame:
    """``docs`` with every column that the operators don't read named by its place
    (``own0``, ...); ``toDF(*docs.columns)`` on a result gives the names back."""
    return docs.toDF(*[c if c in READ else f"own{i}" for i, c in enumerate(docs.columns)])
