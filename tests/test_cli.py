"""The command line drives the same jobs (run in-process, no new JVM)."""

import pytest
from pyspark.sql import functions as F

from star_fixture import small_star
from test_jobs import write_folder
from turnstile import adapters
from turnstile.__main__ import main


def test_cli_full_increment_marts(spark, tmp_root, capsys):
    star = small_star(spark)
    write_folder(star, tmp_root + "/full", fact_filter=F.col("date_id") != 200)
    write_folder(star, tmp_root + "/inc", fact_filter=F.col("date_id") == 200,
                 tables={"fact_passenger_entry_exit"})
    assert main(["full", "--tables", tmp_root + "/full", "--store", tmp_root + "/store"], spark) == 0
    assert main(["increment", "--inc", tmp_root + "/inc", "--full", tmp_root + "/full",
                 "--store", tmp_root + "/store", "--snapshot", tmp_root + "/snap"], spark) == 0
    assert main(["marts", "--store", tmp_root + "/store", "--mart", "passengers_by_year"], spark) == 0
    out = capsys.readouterr().out
    assert "loaded years: [2020]" in out and "loaded years: [2021]" in out and "125" in out
    assert spark.read.parquet(tmp_root + "/snap/passengers_by_year").count() == 2


def test_cli_backlog_and_streams(spark, tmp_root, capsys):
    adapters.arrival_messages(spark, "/root/testdata/sf0.001").write.parquet(tmp_root + "/topic")
    assert main(["backlog", "--envelope", tmp_root + "/topic", "--out", tmp_root + "/arr",
                 "--quarantine", tmp_root + "/q"], spark) == 0
    assert main(["stream-upsert", "--envelope", tmp_root + "/topic", "--store", tmp_root + "/ks",
                 "--checkpoint", tmp_root + "/ck", "--available-now"], spark) == 0
    assert main(["keyed", "--store", tmp_root + "/ks", "--show", "3"], spark) == 0
    out = capsys.readouterr().out
    assert "raw=1000" in out and "rows:" in out


def test_cli_extract_asks_for_whole_ranges(spark):
    base = ["extract", "--url", "jdbc:x", "--tables", "t", "--out", "/nowhere"]
    with pytest.raises(SystemExit, match="needs"):
        main([*base, "--fact-year", "2020"], spark)
    with pytest.raises(SystemExit, match="together"):
        main([*base, "--partition-column", "id", "--lower", "1"], spark)
