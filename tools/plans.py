"""Dump the final (post-AQE) physical plan trees of the headline queries.

    python tools/plans.py [sf_dir] > docs/plan_trees.txt
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from turnstile import adapters  # noqa: E402
from turnstile import queries as registry  # noqa: E402
from turnstile.operators import marts  # noqa: E402
from turnstile.plans import incremental as inc  # noqa: E402
from turnstile.session import build_session, scratch_dir  # noqa: E402

HEADLINE = ["mart_entity_totals", "mart_by_year", "mart_by_line_bridge", "mart_by_network",
            "mart_bridge_degree", "mart_flag_stats", "top10_entities", "mart_row_counts",
            "json_valid_rows", "dedup_events_by_id", "keyed_latest", "load_reconciliation",
            "dedup_lineitem_latest", "years_to_process", "extract_year_slice"]


def tree(df) -> str:
    """The AQE final plan: the query runs first (collect), then is explained."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue().split("\n\n\n")[0]
    return text.split("+- == Initial Plan ==")[0].strip()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    sections = [(n, registry.QUERIES[n](spark, sf_dir)) for n in HEADLINE]
    star = adapters.test_star(spark, sf_dir)
    sections.append(("full load: shared station + date aggregate (one scan)",
                     marts.station_and_date_totals(star.fact)))
    store = inc.MartStore(spark, scratch_dir(spark, "plans-store"))
    store.load(adapters.full_star(spark, sf_dir))
    dated = store.gated_facts(star, "c-plan")
    sections.append(("incremental load: facts meet the gated dates map-side, then one grouping-sets partial",
                     dated.groupingSets([[inc.LOAD_KEY, "station_id"], [inc.LOAD_KEY, "quarter"]],
                                        inc.LOAD_KEY, "station_id", "quarter")
                     .agg(F.sum("total_entry_exit").alias("total_passengers"))))
    for name, df in sections:
        print(f"### {name}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
