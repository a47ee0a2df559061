"""Dirty input: rows are typed where they can be, refused with their reasons where not, and counted on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.predicates import quoted


@dataclass(frozen=True)
class Checked:
    """``good``: typed rows. ``refused``: rows as they came, with ``reasons``. ``counts``: filled by the first action on ``good``."""

    good: DataFrame
    refused: DataFrame
    counts: Observation


def typed(column: str, kind: str) -> Column:
    """The value as ``kind``, NULL where it is not one; white space around text does not count."""
    return F.expr(f"try_cast(trim(cast({quoted(column)} AS string)) AS {kind})")


def checked(df: DataFrame, types: Mapping[str, str], required: Sequence[str] = (), name: str = "rows") -> Checked:
    """Split rows into those whose columns have the ``types`` and those that are refused.

    A column is wrong when it has a text that is no such value, and missing when it is in ``required``
    and has none; empty text is no value. Other columns stay as they are. A row gives all its
    reasons, as ``wrong column`` or ``missing column`` in the order of the columns. Each side is one pass
    over the input and moves nothing.
    """
    unknown = [c for c in [*types, *required] if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    said = {c: F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns if c in types or c in required}
    tests = []
    for c in df.columns:
        if c in types:
            tests.append(F.when(said[c].isNotNull() & typed(c, types[c]).isNull(), F.lit(f"wrong {c}")))
        if c in required:
            tests.append(F.when(said[c].isNull(), F.lit(f"missing {c}")))
    reasons = F.filter(F.array(*tests), lambda r: r.isNotNull()) if tests else F.array().cast("array<string>")
    judged = df.withColumn("reasons", reasons)
    counts = Observation(f"checked {name}")
    told = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size("reasons") > 0).alias("refused")]
    told += [F.count_if(F.array_contains("reasons", f"{why} {c}")).alias(f"{why} {c}") for why, listed in (("wrong", types), ("missing", required)) for c in listed]
    values = [typed(c, types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    good = judged.observe(counts, *told).where(F.size("reasons") == 0).select(*values)
    return Checked(good, judged.where(F.size("reasons") > 0), counts)
