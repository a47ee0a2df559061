"""Quality rules as a ledger: every rule is evaluated once, verdicts are bit operations.

``ledger`` stores measurements and one bit per failed rule. A policy is a set of rule names;
applying one, comparing versions of it, or asking what a rule removes by itself only reads the
bits. Everything runs in built-in expressions, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails``, SQL over the measurements, is true."""

    name: str
    fails: str


#: Bit i belongs to rule i; new rules go to the end, so stored ledgers stay valid.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", "word_chars > 25 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("shouting", "10 * n_upper > 3 * word_chars"),
    Rule("exclamations", "10 * n_exclamations > n_words"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, rule in enumerate(RULES) if rule.name in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
STANDARD = Policy("standard-1", tuple(rule.name for rule in RULES))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclamations")


def _repeat_words(listed: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are hashed, sorted with their positions, and those equal to a neighbour give the
    positions to cover; each covers up to three words, less where the next one starts sooner.
    """
    hashed = F.transform(listed, lambda w: F.xxhash64(w))

    def found(ids: Column, n: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(ids, i), F.get(ids, i + 1), F.get(ids, i + 2)).alias("h"), i.alias("p"))
        )
        return _let(F.sort_array(windows), lambda ordered: _covered(_repeated(ordered)))

    def _repeated(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, i: (F.get(ordered, i + 1)["h"] == x["h"]) | (F.get(ordered, i - 1)["h"] == x["h"]),
        )
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def _covered(positions: Column) -> Column:
        steps = lambda at: F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        total = lambda at: F.aggregate(steps(at), F.lit(0), lambda a, b: a + b)
        return _let(positions, total)

    n = F.size(listed)
    return F.when(n < 3, 0).otherwise(_let(hashed, lambda ids: found(ids, F.size(ids)))).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measure(text: Column) -> Column:
    """Struct of the measurements of one text; null counts as a text without words."""
    safe = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(safe, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    only = lambda kept: F.length(F.regexp_replace(safe, f"[^{kept}]+", "")).cast("long")
    by_words = _let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    by_lines = _let(
        lines,
        lambda kept: F.struct(
            F.size(kept).cast("long").alias("n_lines"), (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines")
        ),
    )
    return F.struct(
        by_words.alias("w"), by_lines.alias("l"), only("#*$%&|<>").alias("n_symbols"), only(r"\p{Lu}").alias("n_upper"), only("!").alias("n_exclamations")
    )


def ledger(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, measurements and ``fail_bits`` per row.

    Null and empty texts have no words and fail ``few_words``; repeated rows and ids are judged
    one by one; an empty table gives no rows.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    measured = docs.select(*kept, measure(F.col(f"`{text_col}`")).alias("__m"))
    flat = measured.select(
        *kept,
        F.struct(
            F.col("__m.w.n_words").alias("n_words"),
            F.col("__m.w.word_chars").alias("word_chars"),
            F.col("__m.n_symbols").alias("n_symbols"),
            F.col("__m.l.n_lines").alias("n_lines"),
            F.col("__m.l.n_dup_lines").alias("n_dup_lines"),
            F.col("__m.w.n_repeat_words").alias("n_repeat_words"),
            F.col("__m.n_upper").alias("n_upper"),
            F.col("__m.n_exclamations").alias("n_exclamations"),
        ).alias("__m"),
    )
    return flat.withColumn("__bits", _fail_bits("__m"))


def _fail_bits(measures: str) -> Column:
    """One bit per failed rule, from a struct of measurements."""
    import re

    name = re.compile(r"\b(" + "|".join(MEASURES) + r")\b")
    bits = [
        F.when(F.expr(name.sub(rf"{measures}.\1", rule.fails)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
        for i, rule in enumerate(RULES)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def open_ledger(rows: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ledger with its measurements as plain columns."""
    return rows.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"__m.{m}").alias(m) for m in MEASURES], F.col("__bits").alias("fail_bits"))


def passes(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def ablations(opened: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: rows that fail it, and rows that only it rejects.

    Rows are first counted per combination of bits, at most two to the power of the number of rules.
    """
    combos = opened.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    listed = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(RULES) if r.name in policy.rules])
    each = combos.select("bits", "n", F.explode(listed).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
        F.sum("n").alias("n_rows"),
    )


def keep_good(docs: DataFrame, policy: Policy = STANDARD, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` the policy accepts, with their columns as they were."""
    rows = ledger(docs, docs.columns, text_col)
    return rows.where(passes(policy, "__bits")).select(*[F.col(f"`{c}`") for c in docs.columns])
