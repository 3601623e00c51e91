"""Print the physical plan trees of the headline queries (formatted mode, tree part only).

Usage: python tools/show_plans.py [sf_dir] > PLANS.txt
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tripdemand.operators.aggregates import live_counts  # noqa: E402
from tripdemand.plans.registry import QUERIES, _history, _zone_trips  # noqa: E402
from tripdemand.session import build_session  # noqa: E402
from tripdemand.sources.tables import stats_for_day  # noqa: E402

KEYS = ["trip_counts", "historical_mean", "borough_point_join", "parse_gps_trips",
        "all_trips_union", "replay_messages", "stats_for_day"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue().split("\n\n")[0]
    # Cut the cached polygon-index sub-plans: they are built once per session.
    # A cached table's own plan is printed right after its InMemoryRelation
    # line, starting at some column; the main tree resumes at the first line
    # clearly shallower than that.
    out, skipping, nested_col = [], False, None
    for line in text.splitlines():
        marks = [i for i in (line.find("+- "), line.find(":- ")) if i >= 0]
        col = min(marks) if marks else None
        if skipping:
            if nested_col is None:
                nested_col = col
                continue
            if col is None or col >= nested_col - 3 or "Plan ==" in line:
                continue
            skipping = False
        if "InMemoryRelation" in line:
            out.append(line + "  [cached index table, built once per session]")
            skipping, nested_col = True, None
            continue
        out.append(line)
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    for k in KEYS:
        print(f"### {k}\n\n```\n{tree(QUERIES[k](spark, sf))}\n```\n")
    # The per-micro-batch plan of the live job (J3): counts of one batch
    # joined with the broadcast one-day stats.
    wh = _history(spark, sf)
    stats = F.broadcast(stats_for_day(spark, wh, "Thursday", "January"))
    batch = live_counts(_zone_trips(spark, sf)).join(stats, ["borough_name", "time_block"])
    print(f"### live batch (inside foreachBatch)\n\n```\n{tree(batch)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
