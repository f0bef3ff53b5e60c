"""Delimited text tables.

Two dialects load to the same typed frame:

* ``extract``: no header, unquoted, comma, the token ``null`` for null,
  booleans ``true``/``false`` (what a database extract writes);
* ``sample``: header line, double-quoted values, empty field = null,
  booleans ``True``/``False``.

Jobs read with declared schemas (see ``schemas``).  Rows that do not fit the schema fail the
read (FAILFAST); ``read_with_rejects`` loads the good rows instead and returns a
record for every cell that does not fit.  For text without a declaration,
``infer_schema`` finds each column's narrowest type in one aggregate; it knows the
dialect's null token, so a nullable integer stays an integer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two text dialects.
DIALECTS = {
    "extract": {"header": "false", "sep": ",", "nullValue": "null", "quote": "\""},
    "sample": {"header": "true", "sep": ",", "nullValue": "", "quote": "\""},
}

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def reader_options(dialect: str = "extract", mode: str = "FAILFAST") -> dict[str, str]:
    return {**DIALECTS[dialect], "mode": mode, "timestampFormat": TIMESTAMP_FORMAT,
            "dateFormat": "yyyy-MM-dd"}


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   dialect: str = "extract", mode: str = "FAILFAST") -> DataFrame:
    return spark.read.schema(schema).options(**reader_options(dialect, mode)).csv(path)


def read_positional(spark: SparkSession, path: str, columns: list[str],
                    schema: T.StructType, dialect: str = "extract") -> DataFrame:
    """Header-less text whose columns are named by position (``toDF``)."""
    df = read_delimited(spark, path, schema, dialect)
    return df.toDF(*columns)


def write_delimited(df: DataFrame, path: str, dialect: str = "extract",
                    mode: str = "overwrite") -> None:
    """Replace the target folder with comma-separated text in the given dialect."""
    opts = {k: v for k, v in DIALECTS[dialect].items()}
    opts["timestampFormat"] = TIMESTAMP_FORMAT
    opts["dateFormat"] = "yyyy-MM-dd"
    if dialect == "sample":
        opts["quoteAll"] = "true"
    df.write.mode(mode).options(**opts).csv(path)


#: the lattice of inferred types: each with the text that it takes, narrow types before wider ones.  The first
#: one that takes all of a column's values is its type; a string takes anything.
INFERRED = [
    (T.BooleanType(), r"(?i)(true|false)"),
    (T.IntegerType(), r"[+-]?[0-9]{1,10}"),
    (T.LongType(), r"[+-]?[0-9]{1,19}"),
    (T.DoubleType(), r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"),
    (T.DateType(), r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    (T.TimestampType(), r"[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?"),
]


def _cells(spark: SparkSession, path: str, columns: list[str], dialect: str, *more: T.StructField) -> DataFrame:
    """The text's cells, null where the dialect says so."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + list(more))
    options = {**reader_options(dialect, "PERMISSIVE"), "enforceSchema": "true"}
    return spark.read.schema(schema).options(**options).csv(path)


def _fits(cell: Column, kind: T.DataType, pattern: str) -> Column:
    return cell.rlike(f"^{pattern}$") & cell.try_cast(kind).isNotNull()


def infer_schema(spark: SparkSession, path: str, columns: list[str], dialect: str = "extract") -> T.StructType:
    """The narrowest type of every column, found in one pass; a column without values is a string."""
    cells = _cells(spark, path, columns, dialect)
    found = cells.agg(*[F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(columns)],
                      *[F.count_if(F.col(c).isNotNull() & ~_fits(F.col(c), kind, pattern)).alias(f"bad_{i}_{k}")
                        for i, c in enumerate(columns) for k, (kind, pattern) in enumerate(INFERRED)]).first()

    def kind_of(i: int) -> T.DataType:
        if not found[f"n_{i}"]:
            return T.StringType()
        return next((kind for k, (kind, _) in enumerate(INFERRED) if not found[f"bad_{i}_{k}"]), T.StringType())

    return T.StructType([T.StructField(c, kind_of(i)) for i, c in enumerate(columns)])


def read_inferred(spark: SparkSession, path: str, columns: list[str], dialect: str = "extract") -> DataFrame:
    """Text with columns by position and inferred types."""
    return read_delimited(spark, path, infer_schema(spark, path, columns, dialect), dialect)


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType,
                      dialect: str = "extract") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects).  A reject is row_text, column_name, value, reason: one per cell that does not fit its
    type, or one per line with a wrong number of fields (no column)."""
    names = [f.name for f in schema.fields]
    line = "_line"
    options = {"columnNameOfCorruptRecord": line}
    cells = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*names, line]])).options(
        **{**reader_options(dialect, "PERMISSIVE"), **options}).csv(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    bad = {f.name: F.col(f.name).isNotNull() & typed[f.name].isNull() for f in schema.fields}
    any_bad = F.col(line).isNotNull()
    for b in bad.values():
        any_bad = any_bad | b
    good = cells.filter(~any_bad).select(*[typed[c].alias(c) for c in names])
    broken = F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("value"),
                      F.lit("wrong number of fields").alias("reason"))
    wrong = F.filter(F.array(*[F.when(bad[f.name], F.struct(
        F.lit(f.name).alias("column_name"), F.col(f.name).alias("value"),
        F.lit(f"not of type {f.dataType.simpleString()}").alias("reason"))) for f in schema.fields]), lambda x: x.isNotNull())
    text = F.coalesce(F.col(line), F.concat_ws(",", *[F.coalesce(F.col(c), F.lit(DIALECTS[dialect]["nullValue"])) for c in names]))
    rejects = cells.filter(any_bad).select(text.alias("row_text"), F.explode(
        F.when(F.col(line).isNotNull(), F.array(broken)).otherwise(wrong)).alias("r")).select("row_text", "r.*")
    return good, rejects
