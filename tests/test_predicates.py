from pyspark.sql import functions as F

from conftest import plan_text
from tidemark.functions import predicates as p
from tidemark.functions.hashing import hash_mod, stable_hash
from tidemark.plans import codes


def labels(spark, values):
    return spark.createDataFrame([(v,) for v in values], "label string")


def hits(df, condition):
    return [r[0] for r in df.where(condition).collect()]


def test_patterns_ignore_case_and_know_wildcards(spark):
    df = labels(spark, ["Arterial MAP", "Mean Arterial BP", "mean bpm", "bp mean", None, "ma p"])
    assert hits(df, p.contains_any("label", codes.PRESSURE_LABELS)) == [
        "Arterial MAP", "Mean Arterial BP", "mean bpm",
    ]
    df = labels(spark, ["Ringers Lactate", "Lactated Ringer", "Plasma-Lyte", "Na CL 0.9%", "NaCl"])
    assert hits(df, p.contains_any("label", codes.CRYSTALLOID_LABELS)) == [
        "Ringers Lactate", "Lactated Ringer", "Plasma-Lyte", "Na CL 0.9%",
    ]


def test_include_exclude(spark):
    df = labels(spark, ["Lactate", "Lactate Dehydrogenase (LD)", "glucose", None])
    condition = p.include_exclude("label", codes.LACTATE_LABELS, codes.LACTATE_LABELS_EXCLUDED)
    assert hits(df, condition) == ["Lactate"]
    assert hits(df, p.contains_any("label", [])) == []


def test_several_text_columns(spark):
    df = spark.createDataFrame(
        [("cefepime 2 g", None), (None, "VANCOMYCIN"), ("aspirin", "aspirin"), (None, None)],
        "drug string, generic string",
    )
    by_column = df.where(p.contains_any_of(["drug", "generic"], codes.TIME_ZERO_DRUGS))
    by_text = df.where(p.like_any_sql(["drug", "generic"], codes.TIME_ZERO_DRUGS))
    assert by_column.count() == by_text.count() == 2


def test_sql_text_quotes_values(spark):
    df = labels(spark, ["o'neil", "back\\slash", "plain"])
    assert hits(df, F.expr(p.in_sql("label", ["o'neil", "back\\slash"]))) == ["o'neil", "back\\slash"]
    assert hits(df, F.expr(p.in_sql("label", []))) == []
    assert hits(df, F.expr(p.like_any_sql(["label"], ["O'N"]))) == ["o'neil"]


def test_flags_treat_null_as_no(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 5.0D), (0, NULL), (NULL, 7.0D) AS v(a, x)")
    got = df.select(
        p.flag(F.col("a") == 1), p.or_zero("a"), p.mask("x", "a"), p.mask(F.col("x"), F.col("a")),
        p.clamp("x", 6, 6.5),
    ).collect()
    assert [tuple(r) for r in got] == [(1, 1, 5.0, 5.0, 6.0), (0, 0, None, None, None), (0, 0, None, None, 6.5)]


def test_units_and_priority(spark):
    df = spark.sql("SELECT * FROM VALUES (226512, 80.0D), (226531, 100.0D), (7, 1.0D) AS v(c, x)")
    factors = {codes.WEIGHT_KG: 1, codes.WEIGHT_LB: codes.KG_PER_LB}
    got = df.select(p.normalise_units("c", "x", factors), p.source_priority("c", list(factors))).collect()
    assert [r[0] for r in got] == [80.0, 100.0 * 0.453592, None]
    assert [r[1] for r in got] == [1, 2, 2]


def test_choose_covers_all_values(spark):
    got = [r[0] for r in spark.range(6).select(p.choose("id", ["a", "b", "c"])).collect()]
    assert got == list("abcabc")


def test_code_lists_of_any_type(spark):
    import datetime
    from decimal import Decimal

    df = spark.sql(
        "SELECT * FROM VALUES (1.50BD, DATE '2024-01-02', 'a'), (2.00BD, DATE '2024-01-03', NULL) AS v(n, `a day`, s)"
    )
    for column, code, want in (("n", Decimal("1.5"), 1), ("a day", datetime.date(2024, 1, 3), 1), ("s", None, 0)):
        assert df.where(p.code_in(column, [code])).count() == want
        assert df.where(p.in_sql(column, [code])).count() == want
    assert df.where(p.code_in("s", [None, "a"])).count() == 1 and df.where(p.code_in("s", [])).count() == 0


def test_code_list_is_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("int(id) AS itemid").write.parquet(path)
    text = plan_text(spark.read.parquet(path).where(p.code_in("itemid", [1, 2])))
    assert "In(itemid, [1,2])" in text


def test_hashes_are_stable_and_not_negative(spark):
    df = spark.range(2000).withColumn("d", F.lit("2024-01-01").cast("date"))
    for method in ("md5", "xxhash64"):
        h = stable_hash("id", "d", 7, method=method)
        got = df.select(h.alias("h"), hash_mod(5, "id", 1, method=method).alias("m"))
        rows = got.orderBy("h").collect()
        assert all(r.h >= 0 for r in rows)
        assert {r.m for r in rows} == set(range(5))
    import hashlib

    want = int(hashlib.md5(b"3|2024-01-01|7").hexdigest()[:8], 16)
    assert df.where("id = 3").select(stable_hash("id", "d", 7)).first()[0] == want
