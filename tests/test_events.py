"""Message parsing, quarantine and dedup on hand-written messages (FIXTURES §3 cases)."""

import datetime as dt

from pyspark.sql import functions as F

from turnstile.operators import events as ev
from turnstile.operators.quality import reconcile

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def envelope(spark, messages):
    rows = [(None if m is None else m.encode(), 0, i, T0 + dt.timedelta(seconds=i))
            for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "value binary, partition int, offset bigint, timestamp timestamp")


GOOD = '{"id":"%s","vehicleId":"v1","stationName":"%s","lineName":%s,"expectedArrival":"%s","timeToStation":%s,"timestamp":"2024-01-01T08:00:00Z"}'


def msg(id_="a", station="Angel", line='"Northern"', arrival="2024-01-01T08:05:00Z", tts="120"):
    return GOOD % (id_, station, line, arrival, tts)


CASES = [
    msg("a"),                                   # 0 valid
    "not json at all",                          # 1 malformed
    "[1, 2, 3]",                                # 2 array
    None,                                       # 3 null value
    '{"vehicleId":"v1"}',                       # 4 missing id
    '{"id":"b"}',                               # 5 missing vehicleId
    msg("c", tts='"x45"'),                      # 6 text for a number -> null, row kept
    msg("d", tts="5.5"),                        # 7 fraction -> null, row kept
    msg("e", tts="0"),                          # 8 zero
    msg("f", tts="null"),                       # 9 null
    msg("g", arrival="garbage"),                # 10 bad date
    msg("h", arrival=""),                       # 11 empty date
    msg("a", station="Angel"),                  # 12 duplicate of 0 at higher offset
    msg("i", station=" King's  Cross "),        # 13 quote + spaces
    msg("j", line="null"),                      # 14 null line
    msg("k")[:-1] + ',"extra":1}',              # 15 unknown field
]


def test_parse_split(spark):
    parsed = ev.parse_arrivals(envelope(spark, CASES))
    valid, bad = ev.split(parsed)
    bad_rows = {r["kafka_offset"]: r["reason"] for r in bad.collect()}
    assert bad_rows == {1: "malformed", 2: "malformed", 3: "null_value", 4: "missing_id",
                        5: "missing_vehicle_id"}
    v = {r["kafka_offset"]: r for r in valid.collect()}
    assert set(v) == {0, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15}
    assert v[6]["timeToStation"] is None and v[7]["timeToStation"] is None
    assert v[8]["timeToStation"] == 0 and v[9]["timeToStation"] is None
    assert v[10]["arrival_date"] is None and v[11]["arrival_date"] is None
    assert v[0]["arrival_date"] == dt.date(2024, 1, 1)
    assert v[14]["lineName"] is None
    assert v[0]["arr_timestamp"] == "2024-01-01T08:00:00Z"
    counts = reconcile(parsed).first().asDict()
    assert counts == {"raw_records": 16, "valid_records": 11, "quarantined_records": 5,
                      "deduplicated_records": 10, "duplicate_records": 1}


def test_dedup_keeps_latest_and_is_idempotent(spark):
    valid = ev.valid_rows(ev.parse_arrivals(envelope(spark, CASES)))
    once = ev.dedup_arrivals(valid)
    a = {r["id"]: r["kafka_offset"] for r in once.collect()}
    assert a["a"] == 12
    twice = ev.dedup_arrivals(once)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_latest_uses_partition_then_offset(spark):
    rows = [(b'{"id":"x","vehicleId":"1"}', 0, 10, T0), (b'{"id":"x","vehicleId":"2"}', 1, 3, T0)]
    df = spark.createDataFrame(rows, "value binary, partition int, offset bigint, timestamp timestamp")
    out = ev.dedup_arrivals(ev.valid_rows(ev.parse_arrivals(df))).collect()
    assert [(r["vehicleId"], r["kafka_partition"]) for r in out] == [("2", 1)]


def test_enrich_cells(spark):
    valid = ev.valid_rows(ev.parse_arrivals(envelope(spark, [msg("i", station=" King's  Cross ", tts="61")])))
    row = ev.enrich(valid).first()
    assert row["row_key"] == "KingsCross#Northern#v1#2024-01-01T08:00:00Z"
    assert row["stationName"] == "Kings  Cross"
    assert row["delayLevel"] == "close" and row["timeToStationMin"] == 1.02
    assert row["peakHours"] == "morning_peak" and row["ingestionTime"] == "2024-01-01 08:00:00"
    assert row["platformName"] == "" and row["timeToStation"] == "61"


def test_missing_ingest_time_defaults_to_now(spark):
    df = spark.createDataFrame([('{"id":"z","vehicleId":"1"}',)], "value string")
    row = ev.enrich(ev.valid_rows(ev.parse_arrivals(df))).first()
    assert row["ingestionTime"] is not None and row["ingestionTime"][:2] == "20"


def test_quarantine_keeps_raw_text(spark):
    bad = ev.quarantine_rows(ev.parse_arrivals(envelope(spark, ["oops"]))).first()
    assert bad["raw_value"] == "oops" and bad["reason"] == "malformed"


def test_parse_evaluates_json_once(spark):
    """The validity filter must not be pushed below the JSON parse (re-parsing per field)."""
    parsed = ev.parse_arrivals(envelope(spark, CASES))
    plan = ev.valid_rows(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert F is not None
