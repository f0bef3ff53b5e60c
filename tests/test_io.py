"""Sources, sinks and catalog DDL: text dialects, fallback, partitioned tables."""

import datetime as dt
import os

import pytest

from turnstile import adapters, schemas
from turnstile.plans import backlog, catalog
from turnstile.sources import delimited, files, jdbc, messages

SAMPLE = '''"date_id","year","quarter","month","is_annual","period_label","period_start","period_end","created_at"
"41","1999",,,"True","all of 1999","1999-01-01","1999-12-31","2003-04-05 06:07:08.090807"
"42","2001","3",,"False","third quarter","2001-07-01","2001-09-30","2003-04-05 06:07:09"
'''
EXTRACT = '''41,1999,null,null,true,all of 1999,1999-01-01,1999-12-31,2003-04-05 06:07:08.090807
42,2001,3,null,false,third quarter,2001-07-01,2001-09-30,2003-04-05 06:07:09
'''


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-00000.csv"), "w") as f:
        f.write(text)


def test_both_text_dialects_load_the_same_frame(spark, tmp_root):
    _write(tmp_root + "/sample", SAMPLE)
    _write(tmp_root + "/extract", EXTRACT)
    a = delimited.read_delimited(spark, tmp_root + "/sample", schemas.DIM_DATE, "sample").collect()
    b = delimited.read_delimited(spark, tmp_root + "/extract", schemas.DIM_DATE, "extract").collect()
    assert a == b
    assert a[0]["quarter"] is None and a[0]["is_annual"] is True
    assert a[1]["quarter"] == 3 and a[0]["created_at"] == dt.datetime(2003, 4, 5, 6, 7, 8, 90807)


def test_positional_names_and_roundtrip(spark, tmp_root):
    _write(tmp_root + "/extract", EXTRACT)
    cols = [f.name.upper() for f in schemas.DIM_DATE.fields]
    df = delimited.read_positional(spark, tmp_root + "/extract", cols, schemas.DIM_DATE)
    assert df.columns == cols
    delimited.write_delimited(df.toDF(*[c.lower() for c in cols]), tmp_root + "/out")
    back = delimited.read_delimited(spark, tmp_root + "/out", schemas.DIM_DATE).collect()
    assert sorted(back) == sorted(df.toDF(*[c.lower() for c in cols]).collect())


def test_bad_text_fails_fast(spark, tmp_root):
    _write(tmp_root + "/bad", "x,2007,null,null,true,a,2007-01-01,2007-12-31,2026-05-29 15:27:34\n")
    with pytest.raises(Exception):
        delimited.read_delimited(spark, tmp_root + "/bad", schemas.DIM_DATE).collect()


def test_fallback_and_guards(spark, tmp_root):
    assert not files.path_exists(spark, tmp_root + "/nothing")
    os.makedirs(tmp_root + "/empty", exist_ok=True)
    open(tmp_root + "/empty/part-00000", "w").close()
    assert not files.has_data_files(spark, tmp_root + "/empty")
    assert files.read_parquet_or_none(spark, tmp_root + "/empty") is None
    spark.range(3).write.parquet(tmp_root + "/full")
    used, df = files.read_first(spark, [tmp_root + "/inc", tmp_root + "/full"], spark.read.parquet)
    assert used.endswith("/full") and df.count() == 3
    with pytest.raises(files.MissingInput):
        files.read_first(spark, [tmp_root + "/a", tmp_root + "/b"], spark.read.parquet)
    assert not files.has_rows(df.filter("id > 5"))


def test_partitioned_table_discovers_and_prunes(spark, tmp_root):
    raw = adapters.arrival_messages(spark, "/root/testdata/sf0.001")
    counts = backlog.load_backlog(raw, tmp_root + "/arrivals", tmp_root + "/quarantine")
    assert counts.raw == counts.valid + counts.quarantined
    assert counts.valid == counts.deduplicated + counts.duplicates
    catalog.create_database(spark, "io_test", use=False)
    catalog.register_parquet(spark, "io_test.arrivals", tmp_root + "/arrivals",
                             partitioned_by=backlog.PARTITION_KEYS)
    assert spark.table("io_test.arrivals").count() == counts.deduplicated
    q = spark.table("io_test.arrivals").filter("lineName = 'click'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lineName" in plan
    assert spark.read.parquet(tmp_root + "/quarantine").count() == counts.quarantined


def test_external_table_drop_keeps_files(spark, tmp_root):
    spark.range(5).write.parquet(tmp_root + "/t")
    catalog.create_database(spark, "io_drop", use=False)
    catalog.register_parquet(spark, "io_drop.t", tmp_root + "/t")
    spark.sql("DROP TABLE io_drop.t")
    assert spark.read.parquet(tmp_root + "/t").count() == 5


def test_identifiers_are_checked(spark):
    with pytest.raises(ValueError):
        catalog.create_database(spark, "x; DROP TABLE y")


def test_extract_options_and_query():
    conn = jdbc.Connection("jdbc:postgresql://db/x", user="u", password="p")
    opts = jdbc.table_options(conn, "t", jdbc.Bounds("id", 1, 1000, 8))
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id" and opts["dbtable"] == "t"
    sql = jdbc.year_slice_sql(2020)
    assert "d.year = 2020" in sql and sql.startswith("(SELECT f.entry_exit_id")
    with pytest.raises(TypeError):
        jdbc.year_slice_sql("2020 OR 1=1")


def test_extract_reads_the_fact_in_ranges():
    conn, ranges = jdbc.Connection("jdbc:postgresql://db/x"), jdbc.Bounds("entry_exit_id", 1, 1000, 16)
    reads = jdbc.extract_reads(conn, ["dim_date", "dim_lines"], 2020, ranges)
    assert list(reads) == ["dim_date", "dim_lines", "fact_passenger_entry_exit"]
    assert reads["fact_passenger_entry_exit"]["numPartitions"] == "16" and "numPartitions" not in reads["dim_date"]
    assert jdbc.extract_reads(conn, ["big"], bounds=ranges)["big"]["partitionColumn"] == "entry_exit_id"
    with pytest.raises(ValueError):
        jdbc.extract_reads(conn, [], 2020)


def test_topic_options():
    b = messages.topic_options("h:9092", "t", bounded=True)
    assert b["startingOffsets"] == "earliest" and b["endingOffsets"] == "latest"
    assert b["failOnDataLoss"] == "true"
    s = messages.topic_options("h:9092", "t", bounded=False, fail_on_data_loss=False)
    assert s["startingOffsets"] == "latest" and "endingOffsets" not in s


def test_json_messages_roundtrip(spark):
    df = spark.createDataFrame([("a", 1, None)], "id string, n int, z string")
    out = messages.as_json_messages(df, key="id").collect()[0]
    assert bytes(out["value"]).decode() == '{"id":"a","n":1}' and bytes(out["key"]).decode() == "a"


def test_types_are_inferred_with_the_null_token(spark, tmp_root):
    """Each dialect's sample rows infer to their declared types, a nullable integer included."""
    import datetime as dt
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("id", T.IntegerType()), ("big", T.LongType()), ("quarter", T.IntegerType()), ("code", T.DoubleType()),
        ("flag", T.BooleanType()), ("day", T.DateType()), ("at", T.TimestampType()), ("name", T.StringType()),
        ("mixed", T.StringType()), ("empty", T.StringType()))])
    rows = [(1, 5_000_000_000, None, 1.5, True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5), "a, b", "12", None),
            (-7, 3, 4, 500.0, None, None, None, "2020", "x", None), (None, None, 2, None, False, dt.date(2021, 5, 6), None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    for dialect in ("extract", "sample"):
        path = f"{tmp_root}/{dialect}"
        delimited.write_delimited(df, path, dialect)
        assert delimited.infer_schema(spark, path, schema.names, dialect) == schema
        read = delimited.read_inferred(spark, path, schema.names, dialect)
        assert sorted(map(tuple, read.collect()), key=str) == sorted(rows, key=str)


def test_rejects_name_column_and_reason(spark, tmp_root):
    lines = ["1,Angel,2,true", "x,Bank,2,true", "3,Oval,null,null", "4,Bow,two,perhaps", "5,Short", "6,Long,1,false,extra", "null,null,null,null"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(tmp_root)
    schema = spark.createDataFrame([], "station_id int, station_name string, network_id int, flag boolean").schema
    good, rejects = delimited.read_with_rejects(spark, tmp_root, schema)
    assert good.schema == schema and sorted(map(tuple, good.collect()), key=str) == sorted(
        [(1, "Angel", 2, True), (3, "Oval", None, None), (None, None, None, None)], key=str)
    assert {tuple(r) for r in rejects.collect()} == {
        ("x,Bank,2,true", "station_id", "x", "not of type int"), ("4,Bow,two,perhaps", "network_id", "two", "not of type int"),
        ("4,Bow,two,perhaps", "flag", "perhaps", "not of type boolean"),
        ("5,Short", None, None, "wrong number of fields"), ("6,Long,1,false,extra", None, None, "wrong number of fields")}
