"""Merging newly computed rows into the result table without losing what was known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.scalar import blank_to_null
from cellspark.schemas import RESULT, RESULT_PARTITIONS


def merge_rows(
    new: DataFrame,
    old: DataFrame,
    keys: list[str],
    types: dict[str, str],
    earliest: tuple[str, ...] = (),
    latest: tuple[str, ...] = (),
) -> DataFrame:
    """New rows, with old values where the new one is blank (null, NaN, empty list, blank text).

    ``earliest`` and ``latest`` columns keep the smaller and larger value instead, so that a run over part
    of a cell's tests cannot shrink them. Keys must not be null; both sides hold one row per key.
    """
    old = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in types])
    joined = new.join(old, keys, "left")

    def merged(name: str, kind: str):
        fresh, known = (blank_to_null(F.col(c), kind) for c in (name, f"old_{name}"))
        pick = F.least if name in earliest else F.greatest if name in latest else F.coalesce
        return pick(fresh, known).alias(name)

    return joined.select(*[merged(c, t) for c, t in types.items()], *keys)


def existing_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """The stored result rows whose partition ``new`` writes again; the join prunes the other folders."""
    return old.join(new.select(*RESULT_PARTITIONS), RESULT_PARTITIONS, "left_semi")


def merge_results(new: DataFrame, old: DataFrame, widen_session: bool = True) -> DataFrame:
    """Upsert of result rows (see ``tables.result_rows``). ``widen_session=False`` overwrites the session times."""
    types = {f.name: f.dataType.simpleString() for f in RESULT.fields}
    bounds = {"earliest": ("test_session_start",), "latest": ("test_session_end",)} if widen_session else {}
    return merge_rows(new, existing_rows(old, new), RESULT_PARTITIONS, types, **bounds)
