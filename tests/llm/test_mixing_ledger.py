import random

import pytest
from llm_tools import as_rows, documents, duck, odd_rows, sentence, spark_rows
from tidemark.llm import mixing, rule_ledger
from tidemark.llm.oracles import ORACLES
from pyspark.sql import functions as F


def water(sizes, weights, epochs=3):
    """Targets by clamping and sharing the excess again until none is above."""
    total, full = sum(sizes), set()
    while True:
        left = total - sum(epochs * sizes[i] for i in full)
        rest = sum(w for i, w in enumerate(weights) if i not in full)
        share = [epochs * s if i in full else left * weights[i] / rest for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in full and share[i] >= epochs * s}
        if not over:
            return share
        full |= over


@pytest.mark.parametrize("sizes", [[10, 500, 3, 70, 1, 1000, 4], [1, 1, 1], [0, 5, 9], [100], [10**13, 1, 2]])
def test_targets_equal_repeated_clamping(spark, sizes):
    names = [f"s{i:02d}" for i in range(len(sizes))]
    sources = spark.createDataFrame([*zip(names, sizes)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.water_fill(sources).collect()}
    expect = water(sizes, [i % 3 + 1 for i in range(len(sizes))])
    assert [got[n] for n in names] == pytest.approx(expect)


def test_mix_comes_near_its_targets_and_repeats_itself(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randrange(1, 200)), rng.choice("aaaaaabcd")) for i in range(1500)]
    docs = documents(spark, rows)
    first = mixing.mix_report(docs).collect()
    assert sorted(first) == sorted(mixing.mix_report(docs.repartition(7)).collect())
    source = {i: s for i, _, s in rows}
    taken = {}
    for r in first:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken.setdefault((source[r["doc_id"]], r["target"]), []).append(r["taken"])
    assert all(abs(sum(v) - target) <= 200 for (_, target), v in taken.items())


def test_mix_returns_rows_as_often_as_reported(spark):
    docs = documents(spark, odd_rows())
    assert mixing.mix(docs).columns == docs.columns
    copies = mixing.mix_report(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()
    rows = {r["doc_id"]: r["count"] for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert {r["doc_id"]: r["n"] for r in copies if r["n"]} == rows


def pandas_of(docs):
    return docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})


def test_odd_rows_equal_sql(spark):
    docs = documents(spark, odd_rows())
    assert spark_rows(mixing.mix_report(docs)) == duck(ORACLES["op2_mixing"], {"documents": pandas_of(docs)})
    opened = rule_ledger.open_ledger(rule_ledger.ledger(docs))
    judged = opened.withColumn("base_failed", ~rule_ledger.passes(rule_ledger.BASE)).withColumn("kept", rule_ledger.passes(rule_ledger.STANDARD))
    assert spark_rows(judged) == duck(ORACLES["op4_rule_ledger"], {"documents": pandas_of(docs)})


def covered(words):
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)})


def test_repeated_windows_equal_plain_python(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, rng.randrange(0, 120), rng.choice([2, 3, 6, 50])), None) for i in range(200)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in rule_ledger.open_ledger(rule_ledger.ledger(documents(spark, rows))).collect()}
    assert got == {i: covered(t.split()) for i, t, _ in rows}


def test_ablations_count_what_only_one_rule_rejects(spark):
    texts = ["a b", "## " * 60, "w " * 60, " ".join(f"word{i}" for i in range(80)), None]
    opened = rule_ledger.open_ledger(rule_ledger.ledger(documents(spark, [(i, t, None) for i, t in enumerate(texts)])))
    rows = {r["rule"]: (r["n_failed"], r["n_only_this"], r["n_rows"]) for r in rule_ledger.ablations(opened, rule_ledger.STANDARD).collect()}
    bits = [r["fail_bits"] for r in opened.collect()]
    for i, rule in enumerate(rule_ledger.RULES):
        assert rows[rule.name] == (sum(b >> i & 1 for b in bits), sum(b == 1 << i for b in bits), len(bits))
    assert rows["few_words"][1] >= 1


def test_keep_good_keeps_columns_and_clean_rows(spark):
    docs = documents(spark, odd_rows())
    kept = rule_ledger.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, 4, 5, 6, 7}
    assert as_rows(kept.where("doc_id = 4").toPandas()) == as_rows(docs.where("doc_id = 4").toPandas())
