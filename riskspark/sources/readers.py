"""Sources (S1-S7, S9, S14, S16): one function per source kind, all returning
DataFrames, and a name-based dispatch.

Reading is lazy: column choices and, but for columns rewritten on ingest
(``read_parquet``'s ``where``), filters made later reach the scan.
"""

from __future__ import annotations

import datetime as dt
import decimal
import operator
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.sources.sinks import path_exists


class EmptyExtractError(ValueError):
    """Raised when a source returns no rows."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False, **options) -> DataFrame:
    """Headered CSV. Splits are read in parallel (no chunk loop).

    ``usecols`` keeps a subset of columns; other reader options pass through
    (``sep``, ``quote``, ``nullValue`` ...).
    """
    usecols = options.pop("usecols", None)
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.csv(path)
    if usecols:
        df = df.select(*usecols)
    return _nan_to_null(df)


def read_parquet(spark: SparkSession, path: str, where: list[tuple] | None = None, **options) -> DataFrame:
    """Parquet with NaN as NULL. ``where`` holds comparisons (column, operator,
    value) that all must be met; they reach the scan, which a filter on the
    result cannot where a column is rewritten. A comparison rejects NULL, so
    testing it before the rewriting (row groups are skipped) and after it (a
    NaN, which is above everything, goes) gives the filter of the result."""
    df = spark.read.options(**options).parquet(path)
    tests = [_comparison(*w) for w in where or []]
    for t in tests:
        df = df.filter(t)
    df = _nan_to_null(df)
    for t in tests:
        df = df.filter(t)
    return df


COMPARISONS = {"=": "eq", "<": "lt", "<=": "le", ">": "gt", ">=": "ge"}


def _comparison(column: str, op: str, value) -> Column:
    if op not in COMPARISONS:
        raise ValueError(f"comparison {op!r} is none of {list(COMPARISONS)}")
    return getattr(operator, COMPARISONS[op])(F.col(column), F.lit(value))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    return _nan_to_null(spark.read.options(**options).schema(schema).json(path))


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              user: str | None = None, password: str | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None,
              **options) -> DataFrame:
    """S3: a relational database through JDBC.

    With ``table`` + ``partition_column`` the read is split into
    ``num_partitions`` range queries; with ``query`` it is one query.
    """
    r = spark.read.format("jdbc").option("url", url)
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    if query is not None:
        r = r.option("query", query)
    elif table is not None:
        r = r.option("dbtable", table)
        if partition_column:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
                 .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    else:
        raise ValueError("read_jdbc needs query or table")
    for k, v in options.items():
        r = r.option(k, v)
    return _nan_to_null(r.load())


PARAMETER = re.compile(r"'(?:[^']|'')*'|:(\w+)")


def bind(query: str, params: dict | None) -> str:
    """S4 for sources without bound parameters of their own: ``:name`` outside
    quotes becomes a typed literal. A name without a value raises."""
    def literal(m):
        if m[1] is None:
            return m[0]
        if m[1] not in (params or {}):
            raise ValueError(f"no value for parameter :{m[1]}")
        v = params[m[1]]
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, int | decimal.Decimal):
            return str(v)
        if isinstance(v, float):
            if v != v or v in (float("inf"), float("-inf")):
                raise ValueError(f"parameter :{m[1]} is not a finite number")
            return repr(v)
        if isinstance(v, dt.datetime):
            return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
        if isinstance(v, dt.date):
            return f"DATE '{v.isoformat()}'"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        raise TypeError(f"parameter :{m[1]} has type {type(v).__name__}")
    return PARAMETER.sub(literal, query)


def read_sql(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """SQL over catalog tables and views, with bound parameters.

    A warehouse connector registers its tables in the catalog (or as views);
    the query then runs through Catalyst like any other.
    """
    if not query or not query.strip():
        raise ValueError("Query cannot be empty")
    return spark.sql(query, args=params or {})


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_warehouse(spark: SparkSession, query: str | None = None, table: str | None = None,
                   fmt: str = "bigquery", params: dict | None = None, **options) -> DataFrame:
    """A warehouse table through its Spark connector when that is
    installed, otherwise the catalog (a view or table of that name). Any other
    error (credentials, a missing table) is raised."""
    r = spark.read.format(fmt).options(**options)
    try:
        return r.option("query", bind(query, params)).load() if query is not None else r.load(table)
    except Exception as e:  # noqa: BLE001 - a Java exception or an analysis error; only "not installed" is expected
        if "[DATA_SOURCE_NOT_FOUND]" not in str(e):
            raise
    return read_sql(spark, query, params) if query is not None else spark.table(table)


def _nan_to_null(df: DataFrame) -> DataFrame:
    """pandas folds NaN and NULL together; Spark does not. Normalise on ingest."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _jdbc(spark: SparkSession, query: str, *, url: str, params: dict | None = None, **options) -> DataFrame:
    if not query or not query.strip():
        raise ValueError("a database extract needs a query")
    return read_jdbc(spark, url, query=bind(query, params), **options)


#: By name: functions of (spark, query or path or table name, **options).
SOURCES: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv,
    "parquet": read_parquet,
    "json": read_json,
    "jdbc": _jdbc,
    "postgres": _jdbc,
    "sql": read_sql,
    "table": read_table,
    "bigquery": read_warehouse,
    "warehouse": read_warehouse,
}


def register_source(name: str, fn: Callable[..., DataFrame]) -> None:
    """Add a source kind."""
    SOURCES[name] = fn


def get_source(name: str) -> Callable[..., DataFrame]:
    """Choose the source by name; unknown names raise."""
    if name not in SOURCES:
        raise ValueError(f"Unknown source: {name}")
    return SOURCES[name]


def extract(spark: SparkSession, source: str, query: str, **kwargs) -> DataFrame:
    """Extract, then fail on an empty result (one cheap ``isEmpty``)."""
    df = get_source(source)(spark, query, **kwargs)
    if df.isEmpty():
        raise EmptyExtractError(f"[{source}] Extracted data failed validation: no rows")
    return df


def load_reference(spark: SparkSession, primary: str, fallback: str | None = None) -> DataFrame:
    """The drift baseline from its store, then a second path, else raise."""
    for p in (primary, fallback):
        if p and path_exists(spark, p):
            return spark.read.parquet(p)
    raise RuntimeError(f"no reference data at {primary} or {fallback}")


def requests_from_json(df: DataFrame, column: str = "value",
                       schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """JSON request rows to typed rows; unparsable rows are returned
    separately (quarantine) instead of failing the batch."""
    from riskspark import schemas as S
    schema = schema or S.REQUEST
    with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = df.select(F.from_json(F.col(column), with_corrupt,
                                   {"mode": "PERMISSIVE",
                                    "columnNameOfCorruptRecord": "_corrupt"}).alias("r"),
                       F.col(column).alias("_raw"))
    required = [f.name for f in schema.fields]
    bad = F.col("r._corrupt").isNotNull() | F.col("r").isNull()
    for c in required:
        bad = bad | F.col(f"r.{c}").isNull()
    good = parsed.filter(~bad).select("r.*").drop("_corrupt")
    quarantine = parsed.filter(bad).select(F.col("_raw").alias("raw"))
    return good, quarantine


def load_csv_table(spark: SparkSession, path: str, table_path: str) -> DataFrame:
    """Headered CSV with detected types, stored as a table."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    df.write.mode("overwrite").parquet(table_path)
    return spark.read.parquet(table_path)
