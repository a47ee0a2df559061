"""Registered queries against independent SQL on the given tables, and over empty ones."""

import pytest
from llm_tools import SF, duck, spark_rows
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import REGISTRY

TABLES = {t: f"{SF}/{t}.parquet" for t in ("documents", "benchmark", "pages", "labels", "embeddings", "conversations")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert spark_rows(REGISTRY[name](spark, SF)) == duck(ORACLES[name], TABLES)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_empty_tables_give_no_rows(spark, name, tmp_path):
    for table, file in TABLES.items():
        spark.read.parquet(file).limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert REGISTRY[name](spark, str(tmp_path)).count() == 0


def test_native_operators_run_no_python(spark):
    for name in ("op2_mixing", "op4_rule_ledger"):
        plan = REGISTRY[name](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
