"""spark-submit entry points: ``python -m tripdemand.cli <command> ...``.

Commands mirror the jobs of the original system:

* ``batch``  -- list + classify trip files, count, write trip_data and trip_stats (L1)
* ``stats``  -- recompute trip_stats from the stored trip_data (A2 only)
* ``live``   -- start the live Kafka (or text-folder) job (L2)
* ``replay`` -- turn a trip file into live messages and publish or save them (S13)
* ``report`` -- print a historical, live or overlay profile (R1-R3)
"""

from __future__ import annotations

import argparse
import sys

from tripdemand.operators.aggregates import historical_mean
from tripdemand.operators.replay import replay_messages
from tripdemand.plans.batch import run_batch
from tripdemand.plans.reports import historical_profile, live_profile, overlay_report
from tripdemand.schemas import AS_CODED_ZONE_FIELD, ZONE_FIELD
from tripdemand.session import build_session
from tripdemand.sources.streams import kafka_trip_stream, text_trip_stream
from tripdemand.sources.tables import read_table, write_kafka, write_trip_stats
from tripdemand.sources.trip_files import read_trip_lines
from tripdemand.sources.zones import read_zone_lookup
from tripdemand.streaming.live import day_and_month, start_live


def _index(spark, geojson):
    if not geojson:
        return None
    from tripdemand.operators.spatial import PolygonIndex
    from tripdemand.sources.boroughs import read_borough_geojson
    return PolygonIndex(read_borough_geojson(spark, geojson))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripdemand")
    sub = p.add_subparsers(dest="command", required=True)

    b = sub.add_parser("batch", help="historical counts and means")
    b.add_argument("--input", required=True, help="folder (bucket) holding the trip files")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--zones", required=True, help="zone lookup CSV")
    b.add_argument("--boroughs", help="borough GeoJSON (needed for GPS files)")
    b.add_argument("--prefix", default="yellow")
    b.add_argument("--as-coded-zone-field", action="store_true",
                   help="read field 5 (RatecodeID) as the zone, as the original code did")
    b.add_argument("--fail-on-bad-timestamp", action="store_true")

    s = sub.add_parser("stats", help="recompute trip_stats from trip_data")
    s.add_argument("--warehouse", required=True)

    lv = sub.add_parser("live", help="live job")
    lv.add_argument("--warehouse", required=True)
    lv.add_argument("--zones", required=True)
    lv.add_argument("--date", required=True, help="reference date YYYY-MM-DD")
    lv.add_argument("--checkpoint", required=True)
    src = lv.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", nargs=2, metavar=("SERVERS", "TOPIC"))
    src.add_argument("--text-folder")
    lv.add_argument("--interval", default="60 seconds")
    lv.add_argument("--available-now", action="store_true",
                    help="process what is available, then stop (catch-up runs)")
    lv.add_argument("--preview", action="store_true", help="print ten trips of each batch")
    lv.add_argument("--max-offsets", type=int,
                    help="Kafka maxOffsetsPerTrigger: cap a micro-batch after downtime")

    r = sub.add_parser("replay", help="historical lines -> live messages")
    r.add_argument("--input", required=True)
    r.add_argument("--date", required=True)
    dst = r.add_mutually_exclusive_group(required=True)
    dst.add_argument("--kafka", nargs=2, metavar=("SERVERS", "TOPIC"))
    dst.add_argument("--output", help="write key/value as Parquet")

    rp = sub.add_parser("report", help="print a profile")
    rp.add_argument("kind", choices=["historical", "live", "overlay"])
    rp.add_argument("--warehouse", required=True)
    rp.add_argument("--borough", required=True)
    rp.add_argument("--day")
    rp.add_argument("--month")
    rp.add_argument("--date", help="restrict live rows to one date")
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "report" and args.kind != "live" and not (args.date or args.day and args.month):
        _parser().error("a historical or overlay report needs --date, or --day and --month")
    spark = build_session(app_name=f"tripdemand-{args.command}")
    if args.command == "batch":
        run_batch(spark, args.input, args.warehouse, zones=read_zone_lookup(spark, args.zones),
                  index=_index(spark, args.boroughs), prefix=args.prefix,
                  zone_field=AS_CODED_ZONE_FIELD if args.as_coded_zone_field else ZONE_FIELD,
                  on_bad_timestamp="fail" if args.fail_on_bad_timestamp else "drop")
    elif args.command == "stats":
        write_trip_stats(historical_mean(read_table(spark, args.warehouse, "trip_data")),
                         args.warehouse)
    elif args.command == "live":
        opts = {"maxOffsetsPerTrigger": str(args.max_offsets)} if args.max_offsets else None
        msgs = (kafka_trip_stream(spark, *args.kafka, options=opts) if args.kafka
                else text_trip_stream(spark, args.text_folder))
        q = start_live(spark, msgs, read_zone_lookup(spark, args.zones), args.warehouse,
                       args.date, args.checkpoint, preview=args.preview,
                       trigger=({"availableNow": True} if args.available_now
                                else {"processingTime": args.interval}))
        q.awaitTermination()
    elif args.command == "replay":
        msgs = replay_messages(read_trip_lines(spark, [args.input]), args.date)
        if args.kafka:
            write_kafka(msgs, *args.kafka)
        else:
            msgs.write.mode("overwrite").parquet(args.output)
    elif args.command == "report":
        day, month = args.day, args.month
        if args.date and not (day and month):
            day, month = day_and_month(args.date)
        if args.kind == "historical":
            df = historical_profile(read_table(spark, args.warehouse, "trip_stats"),
                                    day, month, args.borough)
        elif args.kind == "live":
            df = live_profile(read_table(spark, args.warehouse, "real_trip_stats"),
                              args.borough, args.date)
        else:
            df = overlay_report(read_table(spark, args.warehouse, "trip_stats"),
                                read_table(spark, args.warehouse, "real_trip_stats"),
                                args.borough, day, month, args.date)
        df.show(df.count(), truncate=False)  # every row: a report has one per block and mean
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
