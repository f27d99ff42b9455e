"""Equi-joins that replace per-parent requests.

The parent side (key table) is usually small. It is derived, so its size is
checked before it is broadcast (``bounded_broadcast``); above the bound AQE
plans a sort-merge join with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.session import bounded_broadcast


# JN1 ----------------------------------------------------------------------
def attach_children(parents: DataFrame, children: DataFrame, on: list[str] | dict[str, str],
                    carry: list[str] | dict[str, str] = ()) -> DataFrame:
    """Copy parent keys and carried parent fields onto each child row.

    ``on`` maps child column to parent column (a list means equal names);
    ``carry`` maps parent column to output name. Children without a parent
    are dropped (inner join), as the per-parent request never returns them.
    """
    on_map = {c: c for c in on} if isinstance(on, list) else dict(on)
    carry_map = {c: c for c in carry} if isinstance(carry, (list, tuple)) else dict(carry)
    side = parents.select(
        *[F.col(p).alias(f"_k_{c}") for c, p in on_map.items()],
        *[F.col(p).alias(o) for p, o in carry_map.items()],
    )
    side = bounded_broadcast(side)
    cond = [children[c] == side[f"_k_{c}"] for c in on_map]
    clash = [o for o in carry_map.values() if o in children.columns]
    kids = children.drop(*clash)
    out = kids.join(side, cond, "inner")
    return out.drop(*[f"_k_{c}" for c in on_map])


# JN2 ----------------------------------------------------------------------
def restrict_to_keys(df: DataFrame, keys: DataFrame, on: str | dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (left semi join): the key list
    never reaches the driver."""
    if isinstance(on, str):
        on = {on: on}
    (left, right), = on.items()
    side = bounded_broadcast(keys.select(F.col(right).alias("_key")).distinct())
    return df.join(side, df[left] == side["_key"], "left_semi")
