"""Run the live application: ``python -m geopulse`` or ``spark-submit`` this file.

Examples::

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version> \\
        geopulse/__main__.py --kafka broker:9092 --topic gps_pings --out s3a://bucket/fleet

    python -m geopulse --files /landing/gps --out /data/fleet --available-now

Every output runs as its own streaming query with its own checkpoint under
``--out``; the process waits for all of them.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geopulse.plans.live_app import DEFAULT_TRIGGER, OUTPUTS, await_all, start_live_app  # noqa: E402
from geopulse.schema import WATERMARK_DELAY  # noqa: E402
from geopulse.session import RECOMMENDED_CONF  # noqa: E402


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="geopulse", description="fleet telemetry streaming application")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", metavar="BOOTSTRAP", help="Kafka bootstrap servers")
    src.add_argument("--files", metavar="PATH", help="folder of JSON-lines messages")
    p.add_argument("--topic", default="gps_pings")
    p.add_argument("--starting-offsets", default="latest", help="latest | earliest")
    p.add_argument("--out", required=True, help="output base path (results, lake, checkpoints)")
    p.add_argument("--watermark", default=WATERMARK_DELAY)
    p.add_argument("--trigger", default=DEFAULT_TRIGGER["processingTime"],
                   help="processing-time trigger interval")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--outputs", default=",".join(OUTPUTS), help="comma-separated subset")
    p.add_argument("--no-branches", action="store_true", help="skip lake and cache branches")
    p.add_argument("--records-per-object", type=int, default=None)
    p.add_argument("--max-files-per-trigger", type=int, default=None, help="with --files: files of a micro-batch")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None, help="with --kafka: messages of a micro-batch")
    p.add_argument("--no-late-rows", action="store_true", help="don't keep pings behind the watermark")
    p.add_argument("--console", action="store_true", help="also print the zone windows")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    args = parse_args(argv)
    b = SparkSession.builder.appName("geopulse")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if args.kafka:
        from geopulse.sources import kafka
        messages = kafka.read_messages(spark, args.kafka, args.topic, starting_offsets=args.starting_offsets,
                                       max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        from geopulse.sources import files
        messages = files.read_message_stream(spark, args.files, args.max_files_per_trigger)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    started = start_live_app(spark, messages, args.out, trigger=trigger,
                             outputs=[o for o in args.outputs.split(",") if o],
                             branches=not args.no_branches, records_per_object=args.records_per_object,
                             fallback_id="_offset_id" if args.kafka else None, watermark=args.watermark,
                             late_rows=not args.no_late_rows, print_zones=args.console)
    await_all(started)


if __name__ == "__main__":
    main()
