"""Catalog DDL: databases, external tables over text and Parquet, partition discovery.

Uses the session catalog (no Hive server).  Dropping an external table keeps
its files.  Identifiers are validated; locations are quoted.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    for part in name.split("."):
        if not _IDENT.match(part):
            raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(f"`{p}`" for p in name.split("."))


def _loc(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: T.StructType, skip: set[str] = frozenset()) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
                     if f.name not in skip)


def create_database(spark: SparkSession, db: str, use: bool = True) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(db)}")
    if use:
        spark.sql(f"USE {_ident(db)}")


def drop_database(spark: SparkSession, db: str) -> None:
    """Remove a database and its table entries; the files of external tables stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {_ident(db)} CASCADE")


def register_delimited(spark: SparkSession, table: str, schema: T.StructType, path: str,
                       dialect: str = "extract", replace: bool = True) -> None:
    from ..sources.delimited import DIALECTS
    d = DIALECTS[dialect]
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_ident(table)}")
    opts = ", ".join(f"{k} {_loc(v)}" for k, v in d.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(table)} ({_columns(schema)}) "
              f"USING csv OPTIONS ({opts}) LOCATION {_loc(path)}")


def register_parquet(spark: SparkSession, table: str, path: str,
                     schema: T.StructType | None = None,
                     partitioned_by: list[str] | None = None, replace: bool = True) -> None:
    """External Parquet table; partitioned tables get their partitions discovered."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_ident(table)}")
    parts = partitioned_by or []
    if parts and schema is None:
        schema = spark.read.parquet(path).schema  # data columns + discovered partition columns
    cols = ""
    if schema is not None:
        ordered = T.StructType([f for f in schema.fields if f.name not in parts]
                               + [f for p in parts for f in schema.fields if f.name == p])
        cols = f"({_columns(ordered)}) "
    part_sql = f"PARTITIONED BY ({', '.join(_ident(p) for p in parts)}) " if parts else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(table)} {cols}USING parquet "
              f"{part_sql}LOCATION {_loc(path)}")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {_ident(table)}")


def ensure_ledger_table(spark: SparkSession, table: str, path: str) -> None:
    from ..schemas import LEDGER
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(table)} ({_columns(LEDGER)}) "
              f"USING parquet LOCATION {_loc(path)}")


def append_into(df: DataFrame, table: str) -> None:
    """Positional append into an existing catalog table."""
    df.write.insertInto(table, overwrite=False)


def table_count(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SELECT COUNT(*) AS total_records FROM {_ident(table)}")
