"""Finding codes in dictionaries and looking at the rows that use them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import ColumnLike, as_column, contains_any, include_exclude
from .rows import top_k
from .scale import skew_join


def find_concepts(
    dictionary: DataFrame,
    label: str,
    include: Sequence[str],
    exclude: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Dictionary entries whose label matches a pattern, one row per distinct entry."""
    found = dictionary.where(include_exclude(label, include, exclude))
    found = found.select(*columns) if columns else found
    return found.distinct() if distinct else found


def concept_counts(
    facts: DataFrame,
    dictionary: DataFrame,
    code: str,
    label: str,
    include: Sequence[str],
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Number of fact rows per matching (code, label).

    Facts are counted per code before they meet the dictionary, so the shuffle
    carries one number per code and task however uneven the codes are.
    """
    used = facts.groupBy(code).agg(F.count("*").alias("_used"))
    wanted = dictionary.where(include_exclude(label, include, exclude)).select(code, label)
    return used.join(wanted, code).groupBy(code, label).agg(F.sum("_used").alias("n"))


def label_codes(facts: DataFrame, dictionary: DataFrame, code: str) -> DataFrame:
    """Fact rows with the dictionary's columns beside them."""
    return skew_join(facts, dictionary, [code])


def admissions_by_description(
    admissions: DataFrame,
    diagnoses: DataFrame,
    dictionary: DataFrame,
    label: str,
    include: Sequence[str],
    code: str,
    keys: Sequence[str],
) -> DataFrame:
    """Admissions with a code whose description matches: one row per matching code.

    The text search runs on the dictionary only.
    """
    wanted = dictionary.where(contains_any(label, include))
    coded = label_codes(diagnoses.select(*keys, code), wanted, code)
    return skew_join(coded, admissions, keys)


def alias_inventory(
    df: DataFrame, columns: Sequence[str], patterns: Sequence[str], dedup: bool = True
) -> DataFrame:
    """Lower-cased names found in any of the columns, with a count.

    ``dedup=True`` merges equal names before counting, so every count is 1;
    ``dedup=False`` counts how often each name occurs. One scan serves all columns.
    """
    names = (
        df.select(F.explode(F.array(*[F.lower(c) for c in columns])).alias("name"))
        .where(contains_any("name", patterns))
    )
    if dedup:
        return names.distinct().withColumn("cnt", F.lit(1).cast("bigint"))
    return names.groupBy("name").agg(F.count("*").alias("cnt"))


def sample_events(
    facts: DataFrame, code: str, value, k: int, order: Sequence[ColumnLike], columns: Sequence[str]
) -> DataFrame:
    """The first k rows of one code, to look at values and units."""
    return top_k(facts.where(as_column(code) == value), k, *order).select(*columns)
