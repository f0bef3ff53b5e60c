"""Command line for the batch and streaming jobs.

  python -m turnstile full        --tables DIR --store DIR [--dialect extract|sample] [--snapshot OUT]
  python -m turnstile increment   --inc DIR --full DIR --store DIR [--reload] [--snapshot OUT]
  python -m turnstile marts       --store DIR [--mart NAME] [--show N]
  python -m turnstile backlog     (--envelope DIR | --servers S --topic T) --out DIR --quarantine DIR
  python -m turnstile stream-append (--envelope DIR | --servers S --topic T) --out DIR --checkpoint DIR
                                  [--trigger-seconds 60] [--run-seconds 3600 | --available-now]
  python -m turnstile stream-upsert (--envelope DIR | --servers S --topic T) --store DIR --checkpoint DIR
                                  [--trigger-seconds 60] [--run-seconds 3600 | --available-now]
  python -m turnstile keyed       --store DIR [--show N]
  python -m turnstile extract     --url URL --tables T1,T2 --out DIR [--user U] [--password-env VAR]
                                  [--fact-year Y]
                                  [--partition-column C --lower N --upper N --partitions N]

Connection secrets are read from environment variables named on the command
line, never passed as values.  The master, memory etc. come from spark-submit
or the usual Spark configuration files.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="turnstile")
    sub = p.add_subparsers(dest="cmd", required=True)

    f = sub.add_parser("full")
    f.add_argument("--tables", required=True)
    f.add_argument("--store", required=True)
    f.add_argument("--dialect", default="extract", choices=["extract", "sample"])
    f.add_argument("--snapshot")

    i = sub.add_parser("increment")
    i.add_argument("--inc", required=True)
    i.add_argument("--full", required=True)
    i.add_argument("--store", required=True)
    i.add_argument("--dialect", default="extract", choices=["extract", "sample"])
    i.add_argument("--reload", action="store_true")
    i.add_argument("--snapshot")

    m = sub.add_parser("marts")
    m.add_argument("--store", required=True)
    m.add_argument("--mart")
    m.add_argument("--show", type=int, default=20)

    def source(sp):
        g = sp.add_mutually_exclusive_group(required=True)
        g.add_argument("--envelope", help="Parquet files in the topic envelope")
        g.add_argument("--servers", help="topic bootstrap servers (needs --topic)")
        sp.add_argument("--topic")
        sp.add_argument("--tolerate-data-loss", action="store_true",
                        help="continue when topic offsets were aged out (default: fail)")
        sp.add_argument("--max-files-per-trigger", type=int)
        sp.add_argument("--max-offsets-per-trigger", type=int,
                        help="micro-batch size cap for a topic stream (e.g. 20 messages)")

    b = sub.add_parser("backlog")
    source(b)
    b.add_argument("--out", required=True)
    b.add_argument("--quarantine", required=True)

    for name in ("stream-append", "stream-upsert"):
        s = sub.add_parser(name)
        source(s)
        if name == "stream-append":
            s.add_argument("--out", required=True)
        else:
            s.add_argument("--store", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--trigger-seconds", type=int, default=60)
        s.add_argument("--run-seconds", type=float, default=3600)
        s.add_argument("--available-now", action="store_true")

    k = sub.add_parser("keyed")
    k.add_argument("--store", required=True)
    k.add_argument("--show", type=int, default=5)

    e = sub.add_parser("extract")
    e.add_argument("--url", required=True)
    e.add_argument("--tables", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--user")
    e.add_argument("--password-env")
    e.add_argument("--fact-year", type=int, help="one year of facts; needs the four range options")
    g = e.add_argument_group("range", "read the fact year (or, without one, the tables) by parallel range queries")
    g.add_argument("--partition-column")
    g.add_argument("--lower", type=int)
    g.add_argument("--upper", type=int)
    g.add_argument("--partitions", type=int)
    return p


def _bounds(a):
    """The extract's range options as Bounds; None without them."""
    from .sources.jdbc import Bounds
    given = (a.partition_column, a.lower, a.upper, a.partitions)
    if all(x is None for x in given):
        if a.fact_year is not None:
            raise SystemExit("--fact-year needs --partition-column, --lower, --upper and --partitions")
        return None
    if any(x is None for x in given):
        raise SystemExit("--partition-column, --lower, --upper and --partitions go together")
    return Bounds(*given)


def _source(spark: SparkSession, a, streaming: bool):
    from .sources import messages
    if a.envelope:
        return messages.envelope_files(spark, a.envelope, streaming, a.max_files_per_trigger)
    if not a.topic:
        raise SystemExit("--topic is required with --servers")
    extra = {"max_offsets_per_trigger": a.max_offsets_per_trigger} if streaming else {}
    return messages.topic_reader(spark, a.servers, a.topic, bounded=not streaming,
                                 fail_on_data_loss=not a.tolerate_data_loss, **extra)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    from .session import build_session
    spark = spark or build_session()
    from .operators import marts
    from .plans import backlog, jobs
    from .plans.incremental import MartStore
    from .streaming import arrivals as stream

    if a.cmd == "full":
        res = jobs.run_full(spark, a.tables, a.store, a.dialect)
        print("loaded years:", sorted(r[0] for r in res.years.collect()))
        if a.snapshot:
            MartStore(spark, a.store).snapshot(a.snapshot)
    elif a.cmd == "increment":
        res = jobs.run_increment(spark, a.inc, a.full, a.store, a.dialect, a.reload)
        if res == jobs.NO_NEW_DATA:
            print("no new data")
            return 0
        print("loaded years:", sorted(r[0] for r in res.years.collect()))
        if a.snapshot:
            MartStore(spark, a.store).snapshot(a.snapshot)
    elif a.cmd == "marts":
        store = MartStore(spark, a.store)
        for name in [a.mart] if a.mart else marts.MART_NAMES:
            print(f"-- {name}")
            marts.ordered(store.mart(name), name).show(a.show, truncate=False)
    elif a.cmd == "backlog":
        c = backlog.load_backlog(_source(spark, a, False), a.out, a.quarantine)
        print(f"raw={c.raw} valid={c.valid} quarantined={c.quarantined} "
              f"deduplicated={c.deduplicated} duplicates={c.duplicates}")
        table = spark.read.parquet(a.out)
        backlog.per_key_counts(table, "lineName").show(30, truncate=False)
        backlog.per_key_counts(table, "arrival_date", order_by_count=False).show(30, truncate=False)
    elif a.cmd in ("stream-append", "stream-upsert"):
        trigger = {"availableNow": True} if a.available_now else \
            {"processingTime": f"{a.trigger_seconds} seconds"}
        src = _source(spark, a, True)
        if a.cmd == "stream-append":
            q = stream.start_append(src, a.out, a.checkpoint, trigger)
        else:
            q = stream.start_keyed_upsert(src, a.store, a.checkpoint, trigger)
        stream.run_for(q, None if a.available_now else a.run_seconds)
    elif a.cmd == "keyed":
        from .operators.topn import preview
        cur = stream.current_rows(spark, a.store)
        if cur is None:
            print("keyed store is empty")
            return 0
        print("rows:", cur.count())
        preview(cur, a.show, "row_key").show(truncate=False)
    elif a.cmd == "extract":
        from .sources import delimited, jdbc
        conn = jdbc.Connection(a.url, a.user,
                               os.environ.get(a.password_env) if a.password_env else None)

        def write(name, df):
            path = f"{a.out.rstrip('/')}/{name}"
            delimited.write_delimited(df, path, "extract")

        reads = jdbc.extract_reads(conn, [t for t in a.tables.split(",") if t], a.fact_year, _bounds(a))
        for name, options in reads.items():
            write(name, spark.read.format("jdbc").options(**options).load())
    return 0


if __name__ == "__main__":
    sys.exit(main())
