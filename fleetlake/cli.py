"""Command line: the pipeline's jobs as spark-submit-able commands.

    python -m fleetlake.cli ingest  --stream telemetry --files DIR | --kafka HOST:PORT
                                    --bronze ROOT --rejects ROOT --checkpoint DIR [--once]
    python -m fleetlake.cli build   --bronze ROOT --out ROOT [--no-tests] [--register]
                                    [--late-data] [--mixed]
    python -m fleetlake.cli late    --stream telemetry --bronze ROOT --out ROOT --since 2024-01-31T00:00:00 [--register]
    python -m fleetlake.cli refresh-mart --out ROOT
    python -m fleetlake.cli drift   [--out ROOT] --alerts PATH [--window 30 --threshold 2.5 --min-history 5]
    python -m fleetlake.cli report  --out ROOT --name mart_listing|latest_per_device|fleet_kpis|
                                    telemetry_trend|job_status_breakdown|latest_health [--show 20]

``ingest`` is one streaming query per stream (``--once``: drain what is available
and stop, the scheduled form). ``build`` rebuilds silver and gold from bronze and
runs the quality gate (``--late-data``: with the indexes that ``late`` needs;
``--mixed``: bronze files may differ in their column types). ``late`` brings silver,
fact and mart up to date with the rows ingested since a time, on the dates these
touch only; ``refresh-mart`` rebuilds only the mart from written tables. ``drift
--state`` keeps tails from run to run and reads new dates only (``--since``: from a date on).
"""

from __future__ import annotations

import argparse
import datetime
import sys

from fleetlake.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fleetlake")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--shuffle-partitions", type=int, default=200)
    sub = p.add_subparsers(dest="cmd", required=True)

    i = sub.add_parser("ingest")
    i.add_argument("--stream", required=True, choices=["telemetry", "calibration", "jobs", "health"])
    src = i.add_mutually_exclusive_group(required=True)
    src.add_argument("--files", help="folder of JSON-lines files (one event per line)")
    src.add_argument("--kafka", help="Kafka bootstrap servers")
    i.add_argument("--topic", default=None)
    i.add_argument("--bronze", required=True)
    i.add_argument("--rejects", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--max-per-trigger", type=int, default=None)
    i.add_argument("--min-partitions", type=int, default=None,
                   help="Kafka: split offset ranges into at least this many tasks (default: cluster cores)")
    i.add_argument("--once", action="store_true")

    b = sub.add_parser("build")
    b.add_argument("--bronze", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--no-tests", action="store_true")
    b.add_argument("--register", action="store_true", help="expose tables in the silver/gold databases")

    b.add_argument("--late-data", action="store_true", help="write the key indexes that late needs")
    b.add_argument("--mixed", action="store_true", help="group bronze files by footer schema")

    la = sub.add_parser("late")
    la.add_argument("--stream", required=True, choices=["telemetry", "calibration", "jobs", "health"])
    la.add_argument("--bronze", required=True)
    la.add_argument("--out", required=True)
    la.add_argument("--since", required=True, help="ingest time of the first new rows (ISO text, UTC)")
    la.add_argument("--register", action="store_true", help="bring the registered tables' partitions in line")

    r = sub.add_parser("refresh-mart")
    r.add_argument("--out", required=True)

    d = sub.add_parser("drift")
    d.add_argument("--out", default=None, help="tables root (default: find fct_telemetry in the catalog)")
    d.add_argument("--alerts", help="where to replace the whole alert set")
    d.add_argument("--state", help="instead: folder of tails and alerts kept from run to run")
    d.add_argument("--since", type=datetime.date.fromisoformat, help="with --state: run again from this date on")
    d.add_argument("--window", type=int, default=30)
    d.add_argument("--threshold", type=float, default=2.5)
    d.add_argument("--min-history", type=int, default=5)

    rep = sub.add_parser("report")
    rep.add_argument("--out", required=True)
    rep.add_argument("--name", required=True, choices=["mart_listing", "latest_per_device", "fleet_kpis",
                                                        "telemetry_trend", "job_status_breakdown",
                                                        "latest_health"])
    rep.add_argument("--show", type=int, default=20)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.cmd == "drift" and not (args.alerts or args.state):
        _parser().error("drift needs --alerts or --state")
    spark = build_session(args.master, args.shuffle_partitions, app=f"fleetlake-{args.cmd}")
    from fleetlake.plans import pipeline, reports
    from fleetlake.schemas import STREAMS

    if args.cmd == "ingest":
        from fleetlake.sources.events import kafka_stream
        from fleetlake.streaming.ingest import file_messages, start_ingest
        spec = STREAMS[args.stream]
        topic = args.topic or spec.topic
        if args.files:
            msgs = file_messages(spark, args.files, topic, args.max_per_trigger)
        else:
            msgs = kafka_stream(spark, args.kafka, topic,
                                min_partitions=args.min_partitions or spark.sparkContext.defaultParallelism,
                                **({"maxOffsetsPerTrigger": str(args.max_per_trigger)} if args.max_per_trigger else {}))
        q = start_ingest(msgs, spec, args.bronze, args.rejects, args.checkpoint, available_now=args.once)
        q.awaitTermination()
    elif args.cmd == "build":
        pipeline.build_all(spark, pipeline.Layers.from_bronze(spark, args.bronze, mixed=args.mixed), args.out,
                           run_tests=not args.no_tests, register=args.register, late_data=args.late_data)
    elif args.cmd == "late":
        from fleetlake.plans import incremental
        dates = incremental.refresh(spark, args.out, args.stream, incremental.fresh_rows(spark, args.bronze, args.stream, args.since))
        if args.register:
            names = [f"stg_{args.stream}", "fct_telemetry", "device_reliability_mart"]
            pipeline.register_all(spark, args.out, names)
        print(f"brought {len(dates)} dates up to date")
    elif args.cmd == "refresh-mart":
        pipeline.refresh_mart(spark, args.out)
    elif args.cmd == "drift" and args.state:
        from fleetlake.plans import drift_runs
        from fleetlake.sources.catalog import find_table
        from fleetlake.sources.tables import read_table
        fct = read_table(spark, args.out, "fct_telemetry") if args.out else spark.table(find_table(spark, "fct_telemetry"))
        drift_runs.run(spark, fct, args.state, args.since, args.window, args.threshold, args.min_history)
        print(f"{drift_runs.read(spark, args.state).count()} drift alerts")
    elif args.cmd == "drift":
        alerts = pipeline.run_drift_detection(spark, args.out, args.alerts, window=args.window,
                                              threshold=args.threshold, min_history=args.min_history)
        print(f"wrote {alerts.count()} drift alerts")
    elif args.cmd == "report":
        from fleetlake.sources.tables import read_table
        t = {n: read_table(spark, args.out, n)
             for n in ("device_reliability_mart", "fct_telemetry", "stg_jobs", "stg_health")}
        df = {"mart_listing": lambda: reports.mart_listing(t["device_reliability_mart"]),
              "latest_per_device": lambda: reports.latest_per_device(t["device_reliability_mart"]),
              "fleet_kpis": lambda: reports.fleet_kpis(t["device_reliability_mart"]),
              "telemetry_trend": lambda: reports.telemetry_trend(t["fct_telemetry"]),
              "job_status_breakdown": lambda: reports.job_status_breakdown(t["stg_jobs"]),
              "latest_health": lambda: reports.latest_health(t["stg_health"])}[args.name]()
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
