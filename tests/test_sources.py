import datetime as dt

import pytest

from conftest import as_set
from tidemark.sources import tables as src


def test_names_and_times_are_normalised(spark, tmp_path):
    spark.sql("SELECT 1L AS HADM_ID, timestamp'2024-01-01 05:00:00' AS CHARTTIME, 'x' AS drug").write.parquet(
        str(tmp_path / "prescriptions.parquet")
    )
    (df,) = src.load_tables(spark, str(tmp_path), ["prescriptions"]).values()
    assert df.dtypes == [("hadm_id", "bigint"), ("charttime", "timestamp_ntz"), ("drug", "string")]
    assert df.first().charttime == dt.datetime(2024, 1, 1, 5)


def test_csv_tables(spark, tmp_path):
    (tmp_path / "d_items.csv").write_text("ITEMID,LABEL\n1,a\n2,b\n")
    loaded = src.load_tables(
        spark, str(tmp_path), ["d_items"], "csv", {"d_items": "ITEMID int, LABEL string"}, header=True
    )
    assert as_set(loaded["d_items"]) == {(1, "a"), (2, "b")} and loaded["d_items"].columns == ["itemid", "label"]


def test_missing_columns_are_named(spark):
    good = spark.sql("SELECT 1L AS subject_id, date'2000-01-01' AS dob")
    src.check_inputs({"patients": good, "other": good})
    with pytest.raises(ValueError, match="patients.*dob"):
        src.check_inputs({"patients": good.drop("dob")})


def test_append_refuses_unknown_columns(spark):
    base = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert as_set(src.append(base, spark.sql("SELECT 2 AS a"))) == {(1, "x"), (2, None)}
    with pytest.raises(ValueError, match="c"):
        src.append(base, spark.sql("SELECT 2 AS a, 3 AS c"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_snapshot_round_trip(spark, tmp_path, fmt):
    df = spark.sql(
        "SELECT * FROM VALUES (1L, timestamp_ntz'2024-01-01 05:00:00.000001', 1.25D, NULL),"
        " (2L, NULL, NULL, 0) AS v(hadm_id, t, x, f)"
    )
    path = src.export_snapshot(df, str(tmp_path / "out"), fmt)
    again = src.read_snapshot(spark, path, df.schema, fmt)
    assert again.dtypes == df.dtypes and as_set(again) == as_set(df)
    with pytest.raises(ValueError):
        src.export_snapshot(df, path, "xlsx")


def test_published_view_and_catalog_tables(spark):
    src.publish_view(spark.sql("SELECT 1 AS A_COLUMN"), "a_view")
    assert spark.sql("SELECT * FROM a_view").first()[0] == 1
    assert src.literal_rows(spark, [(1, "x")], "a int, b string").collect()[0].b == "x"
