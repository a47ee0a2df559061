"""Hot keys: same rows as an ordinary join, split by the sizes seen, one plan at every size."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from tidemark.operators import scale
from tidemark_checks.queries import REGISTRY as QUERIES


def facts(spark, n=600):
    """Every third row has key 7; exact copies among them; some keys are NULL."""
    return spark.range(n, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"),
    )


def dims(spark):
    return spark.range(5, 30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d")).unionByName(
        spark.sql("SELECT 7L AS k, 71L AS d")
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_join(spark, uneven, how):
    want = sorted(map(str, facts(spark).join(dims(spark), "k", how).collect()))
    assert sorted(map(str, scale.skew_join(facts(spark), dims(spark), ["k"], how).collect())) == want
    uneven()
    assert sorted(map(str, scale.skew_join(facts(spark), dims(spark), ["k"], how).collect())) == want


def executed(df) -> str:
    """Plan after adaptive execution has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("above", ["nothing", "same keys"])
def test_hot_partitions_are_split_beside_aggregates(spark, uneven, above):
    """One side of the join is an aggregate by the keys, and so may be what follows."""
    uneven()
    grouped = dims(spark).groupBy("k").agg(F.max("d").alias("d"))
    joined = scale.skew_join(facts(spark, 20_000), grouped, ["k"])
    out = joined if above == "nothing" else joined.groupBy("k").agg(F.sum("v").alias("v"))
    assert "skew=true" in executed(out)
    plain = facts(spark, 20_000).join(grouped, "k").groupBy("k").agg(F.sum("v").alias("v"))
    assert "skew=true" not in executed(plain)


def test_key_types_may_differ_beyond_the_smaller_one(spark, uneven):
    left = facts(spark).withColumn("k", F.col("k").cast("int"))
    right = dims(spark).unionByName(spark.sql("SELECT 3000000000L AS k, 1L AS d"))
    want = left.join(right, "k").count()
    assert scale.skew_join(left, right, ["k"]).count() == want
    uneven()
    assert scale.skew_join(left, right, ["k"]).count() == want


def test_names_match_whatever_their_case(spark):
    left = facts(spark).withColumnRenamed("k", "K")
    joined = scale.skew_join(left, dims(spark), ["k"])
    assert joined.columns == ["K", "v", "d"] and joined.count() == facts(spark).join(dims(spark), "k").count()
    with pytest.raises(ValueError):
        scale.skew_join(left, dims(spark), ["missing"])


def test_null_keys_meet_only_on_demand(spark):
    right = dims(spark).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 5L AS d"))
    nulls = facts(spark).where("k IS NULL").count()
    assert nulls and scale.skew_join(facts(spark), right, ["k"]).where("k IS NULL").count() == 0
    assert scale.skew_join(facts(spark), right, ["k"], null_safe=True).where("k IS NULL").count() == nulls


def test_a_hot_key_in_one_file_only_is_split(spark, uneven, settings, tmp_path):
    """Map tasks read pieces of a file; a partition is split by the tasks that filled it."""
    path = str(tmp_path / "facts")
    settings(spark__sql__files__maxPartitionBytes=64_000, spark__sql__files__openCostInBytes=64_000)
    for i in range(6):
        n, key = (200_000, "0L") if i == 3 else (3000, f"{i} * 1000 + id % 900")
        rows = spark.range(n, numPartitions=1).selectExpr(f"{key} AS k", "xxhash64(id) AS v")
        rows.write.option("parquet.block.size", 32_000).mode("append").parquet(path)
    uneven()
    right = spark.range(12_000).selectExpr("id AS k", "id AS d").groupBy("k").agg(F.max("d").alias("d"))
    joined = scale.skew_join(spark.read.parquet(path), right, ["k"])
    assert "skew=true" in executed(joined) and joined.count() == 215_000


def shape(df) -> list[str]:
    """Operators of the plan before execution, without their details."""
    return [re.sub(r"^[ :+*-]*(\(\d+\) )?", "", line).split(" ")[0].split("(")[0] for line in plan_text(df).splitlines()]


@pytest.mark.parametrize("name", ["window_flags", "hash_rank", "select_fraction", "append_absent_range", "update_from_join"])
def test_the_plan_does_not_depend_on_the_size(spark, settings, name):
    settings(spark__sql__autoBroadcastJoinThreshold=-1)
    small, large = (QUERIES[name](spark, f"/root/testdata/sf{sf}") for sf in ("0.001", "0.1"))
    assert shape(small) == shape(large)


def test_building_a_plan_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    for name in ("window_flags", "hash_rank", "select_fraction", "select_nested", "append_absent_range"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert tracker.getJobIdsForGroup("planning") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_numbers_survive_a_rerun(spark):
    """Rows from files are numbered; rows from a shuffle are told apart by content, whatever their order."""
    scanned = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("value > 1")
    assert scale.order_is_fixed(scanned.unionByName(scanned).select("user_id", "value"))
    for shuffled in (scanned.distinct(), scanned.orderBy("ts"), scanned.repartition(3), scanned.limit(5)):
        assert not scale.order_is_fixed(shuffled)
    numbers = lambda d: sorted(r[0] for r in d.select(scale.spread_number(d)).collect())
    assert numbers(scanned.repartition(3)) == numbers(scanned.repartition(5))


def test_dims_cannot_be_preserved(spark):
    with pytest.raises(ValueError):
        scale.skew_join(facts(spark), dims(spark), ["k"], "right")


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25_001)], "k string, n int")
    got = scale.repeat_rows(df, "n", "i").groupBy("k").agg(
        F.count("*").alias("c"), F.count_distinct("i").alias("d"), F.min("i").alias("lo"), F.max("i").alias("hi")
    )
    assert {tuple(r) for r in got.collect()} == {("b", 1, 1, 0, 0), ("c", 25_001, 25_001, 0, 25_000)}


def test_materialise_uses_the_shared_folder(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    assert scale.shared_folder(spark) == str(folder)
    df = spark.range(10).withColumn("t", F.lit("2024-01-01").cast("timestamp_ntz"))
    written = scale.materialise(df, "x")
    assert written.schema["t"].dataType == df.schema["t"].dataType
    assert written.count() == 10
    assert any(p.name.startswith("tidemark-x-") for p in folder.iterdir())
    assert "Range" not in plan_text(written)


class _Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, **conf):
        self.conf = conf


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    both = {"spark.checkpoint.dir": "/shared/x/", "spark.sql.warehouse.dir": "/warehouse"}
    assert scale.shared_folder(_Session(**both)) == "/shared/x"
    assert scale.shared_folder(_Session(**{"spark.sql.warehouse.dir": "/warehouse"})) == "/warehouse/tidemark-scratch"


def test_intermediates_can_be_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scale, "shared_folder", lambda _: str(tmp_path))
    scale.remove_intermediates(spark)
    assert QUERIES["group_summary"](spark, "/root/testdata/sf0.001").count() == 1
    assert any(tmp_path.iterdir())
    assert scale.remove_intermediates(spark) > 0
    assert not any(tmp_path.iterdir()) and scale.remove_intermediates(spark) == 0
