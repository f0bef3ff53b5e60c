"""Batch jobs over delimited folders: full load, increment with fallback, exits."""

import os

import pytest
from pyspark.sql import functions as F

from star_fixture import EXPECTED, as_set, small_star
from turnstile.operators import marts
from turnstile.plans import jobs
from turnstile.plans.incremental import MartStore
from turnstile.schemas import STAR_TABLES
from turnstile.sources import delimited, files

FRAMES = {"fact_passenger_entry_exit": "fact", "dim_date": "dates", "dim_stations": "stations",
          "dim_networks": "networks", "dim_lines": "lines", "fact_station_lines": "bridge"}


def full_schema(df, table):
    cols = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in STAR_TABLES[table].fields]
    return df.select(*cols)


def write_folder(star, folder, fact_filter=None, tables=None):
    for table, attr in FRAMES.items():
        if tables is not None and table not in tables:
            continue
        df = getattr(star, attr)
        if table == "fact_passenger_entry_exit" and fact_filter is not None:
            df = df.filter(fact_filter)
        delimited.write_delimited(full_schema(df, table), f"{folder}/{table}")


def test_full_then_increment_from_text(spark, tmp_root):
    star = small_star(spark)
    # full folder: every table, facts outside 2021; increment folder: 2021 facts only
    write_folder(star, tmp_root + "/full", fact_filter=F.col("date_id") != 200)
    write_folder(star, tmp_root + "/inc", fact_filter=F.col("date_id") == 200,
                 tables={"fact_passenger_entry_exit"})
    store = tmp_root + "/store"
    jobs.run_full(spark, tmp_root + "/full", store)
    res = jobs.run_increment(spark, tmp_root + "/inc", tmp_root + "/full", store)
    assert [r[0] for r in res.years.collect()] == [2021]
    m = MartStore(spark, store)
    for name in ("passengers_by_year", "quarterly_trend", "interchange_stations"):
        want = {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in EXPECTED[name]}
        assert as_set(m.mart(name)) == want, name
    # station marts count the fact whose date (999) has no row
    for name in ("busiest_stations", "night_tube_analysis"):
        want = {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in EXPECTED[name]}
        assert as_set(m.mart(name)) == want, name
    # a second full load replaces the first
    jobs.run_full(spark, tmp_root + "/full", store)
    assert 2021 not in {r["year"] for r in m.mart("passengers_by_year").collect()}
    jobs.run_increment(spark, tmp_root + "/inc", tmp_root + "/full", store)
    assert jobs.run_increment(spark, tmp_root + "/inc", tmp_root + "/full", store).loaded is False


def test_increment_exits(spark, tmp_root):
    with pytest.raises(files.MissingInput):
        jobs.run_increment(spark, tmp_root + "/nope", tmp_root + "/full", tmp_root + "/store")
    os.makedirs(tmp_root + "/empty/fact_passenger_entry_exit")
    open(tmp_root + "/empty/fact_passenger_entry_exit/_SUCCESS", "w").close()
    assert jobs.run_increment(spark, tmp_root + "/empty", tmp_root + "/full",
                              tmp_root + "/store") == jobs.NO_NEW_DATA


def test_marts_from_folder_match_frames(spark, tmp_root):
    star = small_star(spark)
    write_folder(star, tmp_root + "/all")
    loaded = jobs.star_from_folder(spark, tmp_root + "/all")
    for name in marts.MART_NAMES:
        assert as_set(marts.mart(loaded, name)) == as_set(marts.mart(star, name)), name
