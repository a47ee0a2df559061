"""The measure as a stored view: the same rows as the plans, for any session, over the tables as they are."""

import pytest
from tidemark.operators.components import Span, WindowFlag, happened_before
from tidemark.plans import baseline, final, view
from tidemark.plans.spec import SEPSIS
from tidemark_checks.encounters import clinical_tables
from tidemark_checks.queries import BY_ADMISSION

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS view_test")
    tables = clinical_tables(spark, SMALL)
    for name in SEPSIS.tables():
        tables[name].write.mode("overwrite").saveAsTable(f"view_test.{name}")
    yield "view_test"
    spark.sql("DROP DATABASE view_test CASCADE")


def rows(df):
    return sorted(map(str, df.collect()))


STRICT = BY_ADMISSION.with_(
    derived=(happened_before("culture_first", "culture", "antibiotic"),),
    components=(*BY_ADMISSION.components, WindowFlag("high_lactate", "lactate", Span(24, lo=0, mode="half_open"), test=(">=", 4))),
    missing="null",
    output=(),
)


@pytest.mark.parametrize("spec", [SEPSIS, BY_ADMISSION, STRICT])
def test_views_equal_the_plans(spark, schema, spec):
    tables = {n: spark.table(f"{schema}.{n}") for n in spec.tables()}
    view.create_view(spark, f"{schema}.base_flags", schema, spec, final=False)
    other = spark.newSession()
    base = other.table(f"{schema}.base_flags")
    expect = baseline.baseline_flags(tables, spec)
    assert base.columns == expect.columns and rows(base) == rows(expect)
    view.create_view(spark, f"{schema}.final_flags", schema, spec, time_column="startts")
    got, expect = other.table(f"{schema}.final_flags"), final.measure(tables, spec, "startts")
    assert got.columns == expect.columns and rows(got) == rows(expect) and got.count() > 0


def test_the_view_follows_its_tables(spark, schema):
    view.create_view(spark, f"{schema}.living", schema, BY_ADMISSION, final=False)
    before = spark.table(f"{schema}.living").count()
    first = spark.table(f"{schema}.admissions").join(spark.table(f"{schema}.patients"), "subject_id").where("year(admittime) - year(dob) >= 18").first()
    spark.sql(f"INSERT INTO {schema}.diagnoses_icd VALUES ({first.subject_id}, {first.hadm_id}, '99592')")
    spark.sql(f"INSERT INTO {schema}.admissions VALUES ({first.subject_id}, 987654321, TIMESTAMP_NTZ '2030-01-01')")
    spark.sql(f"INSERT INTO {schema}.diagnoses_icd VALUES ({first.subject_id}, 987654321, '78552')")
    now = spark.newSession().table(f"{schema}.living")
    assert now.count() >= before + 1 and now.where("hadm_id = 987654321 AND septic_shock = 1").count() == 1
    kind = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {schema}.living").collect()}
    assert kind["Type"] == "VIEW"
