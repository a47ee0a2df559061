"""Tables in and out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns each clinical input table must offer (lower case).
INPUT_COLUMNS = {
    "patients": ("subject_id", "dob"),
    "admissions": ("subject_id", "hadm_id", "admittime"),
    "diagnoses_icd": ("subject_id", "hadm_id", "icd9_code"),
    "d_icd_diagnoses": ("icd9_code", "short_title", "long_title"),
    "labevents": ("subject_id", "hadm_id", "charttime", "itemid", "valuenum"),
    "d_labitems": ("itemid", "label", "fluid", "category", "loinc_code"),
    "microbiologyevents": ("subject_id", "hadm_id", "spec_itemid", "charttime", "chartdate"),
    "chartevents": ("subject_id", "hadm_id", "charttime", "itemid", "valuenum"),
    "d_items": ("itemid", "label"),
    "prescriptions": ("subject_id", "hadm_id", "drug", "startdate"),
    "icustays": ("subject_id", "hadm_id", "icustay_id", "intime"),
}

#: Schemas of the generic test tables the queries read.
TEST_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def normalise(df: DataFrame) -> DataFrame:
    """Lower-case column names; timestamps without time zone. A no-op projection is skipped."""
    wanted = []
    changed = False
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
            changed = True
        changed = changed or field.name != field.name.lower()
        wanted.append(c.alias(field.name.lower()))
    return df.select(*wanted) if changed else df


def load_tables(
    spark: SparkSession,
    path: str,
    names: Iterable[str],
    fmt: str = "parquet",
    schemas: Mapping[str, str] = TEST_SCHEMAS,
    **options,
) -> dict[str, DataFrame]:
    """Read ``path/name.fmt`` for each name, lazily.

    A table whose schema is given is planned without a look into its files; this
    matters when a table has very many of them.
    """
    tables = {}
    for n in names:
        reader = spark.read.format(fmt).options(**options)
        if n in schemas:
            reader = reader.schema(schemas[n])
        tables[n] = normalise(reader.load(f"{path.rstrip('/')}/{n}.{fmt}"))
    return tables


def load_catalog_tables(spark: SparkSession, schema: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The same from catalog tables ``schema.name``."""
    return {n: normalise(spark.table(f"{schema}.{n}")) for n in names}


def check_inputs(tables: dict[str, DataFrame]) -> None:
    """Fail early, with names, when an input table lacks a column the measures use."""
    for name, df in tables.items():
        missing = set(INPUT_COLUMNS.get(name, ())) - set(df.columns)
        if missing:
            raise ValueError(f"table {name} lacks columns {sorted(missing)}")


def literal_rows(spark: SparkSession, values: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows given in the program text."""
    return spark.createDataFrame(list(values), schema)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register a result under a name that SQL readers of this session can select from."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_table(df: DataFrame, name: str, mode: str = "errorifexists") -> DataFrame:
    """Write a result as a catalog table, which other sessions can read and which outlives this one.

    The catalog is the session's; with a metastore the table is there for other applications too.
    """
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def export_snapshot(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a result for a report tool, as Parquet or as CSV with a header.

    The writing tasks each produce their own file; nothing passes through the driver.
    """
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif fmt != "parquet":
        raise ValueError(f"unsupported snapshot format {fmt!r}")
    writer.format(fmt).save(path)
    return path


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return reader.format(fmt).load(path)


def append(base: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Rows of both; columns the new rows lack become NULL, columns only they have are refused."""
    extra = set(new_rows.columns) - set(base.columns)
    if extra:
        raise ValueError(f"new rows have columns the table lacks: {sorted(extra)}")
    return base.unionByName(new_rows, allowMissingColumns=True)
