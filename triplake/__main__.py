"""Command line: ``python -m triplake <job> ...`` or through spark-submit."""

from __future__ import annotations

import argparse
import sys

from triplake.operators import quality
from triplake.plans import duration, rebuild, serving, stream, trips
from triplake.schemas import MESSAGE_SCHEMA
from triplake.session import open_session
from triplake.sources import bronze, folders, messages
from triplake.sources.tables import read_trips
from triplake.streaming import ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="triplake")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("land", help="land monthly files by year and month")
    job.add_argument("--source", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--streaming-month", required=True, type=folders.require_period)
    job.add_argument("--skip-month", action="append", default=[])
    job.add_argument("--again", action="store_true", help="land unchanged months as well")

    job = jobs.add_parser("ingest", help="store one month of messages")
    job.add_argument("--streaming-month", required=True, type=folders.require_period)
    job.add_argument("--target", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--bootstrap-servers")
    job.add_argument("--topic")
    job.add_argument("--replay-folder")
    job.add_argument("--trigger-seconds", type=int, default=5)
    job.add_argument("--max-per-trigger", type=int)
    job.add_argument("--min-partitions", type=int)
    job.add_argument("--until-done", action="store_true")

    job = jobs.add_parser("trips", help="build the trip table")
    job.add_argument("--batch-root")
    job.add_argument("--stream-root")
    job.add_argument("--zones", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--month", action="append", type=folders.require_period)
    job.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    job.add_argument("--rebalance", action="store_true")

    job = jobs.add_parser("rebuild", help="bring the trips, and what is made of them, up to date")
    job.add_argument("--batch-root")
    job.add_argument("--stream-root")
    job.add_argument("--zones", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--manifest", required=True)
    job.add_argument("--rebalance", action="store_true")
    job.add_argument("--serving", help="also these serving tables")
    job.add_argument("--dataset", help="also this model dataset")
    job.add_argument("--test-month", type=folders.require_period, help="of the dataset")
    job.add_argument("--model", help="also the model on target encodings")

    job = jobs.add_parser("refresh", help="serving tables from the metrics of changed files alone")
    job.add_argument("--batch-root")
    job.add_argument("--stream-root")
    job.add_argument("--zones", required=True)
    job.add_argument("--base", required=True)
    job.add_argument("--state", required=True)

    job = jobs.add_parser("send", help="send the rows of a month as messages")
    job.add_argument("--source", required=True)
    job.add_argument("--month", required=True, type=folders.require_period)
    job.add_argument("--topic", required=True)
    job.add_argument("--bootstrap-servers")
    job.add_argument("--folder", help="store messages here instead, for a replay")
    job.add_argument("--max-rows", type=int)
    job.add_argument("--partitions", type=int, default=stream.PARTITIONS)
    job.add_argument("--log", help="folder that says what was sent; a failed run goes on there")

    job = jobs.add_parser("complete", help="is the stream of a month complete?")
    job.add_argument("--stream-root", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--rows", type=int, required=True)

    job = jobs.add_parser("serving", help="build the serving tables")
    job.add_argument("--trips", required=True)
    job.add_argument("--base", required=True)
    job.add_argument("--year", type=int)
    job.add_argument("--month", type=int)
    job.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")

    job = jobs.add_parser("check", help="report on trips and reconcile serving tables")
    job.add_argument("--trips", required=True)
    job.add_argument("--base", required=True)

    job = jobs.add_parser("export", help="serving tables in few files")
    job.add_argument("--base", required=True)
    job.add_argument("--target", required=True)

    job = jobs.add_parser("dataset", help="build the model dataset")
    job.add_argument("--trips", required=True)
    job.add_argument("--base", required=True)
    job.add_argument("--test-month", required=True, type=folders.require_period)
    job.add_argument("--train-fraction", type=float, default=duration.TRAIN_FRACTION)
    job.add_argument("--test-fraction", type=float, default=duration.TEST_FRACTION)
    job.add_argument("--seed", type=int, default=duration.SEED)
    job.add_argument("--export-to")

    job = jobs.add_parser("train", help="compare duration models")
    job.add_argument("--dataset", required=True)
    job.add_argument("--models-base", required=True)
    job.add_argument("--scores", required=True)
    job.add_argument("--predictions", required=True)
    job.add_argument("--models", default="linear,rf,gbt")
    job.add_argument("--seed", type=int, default=duration.SEED)

    job = jobs.add_parser("train-encoded", help="boosted model on target encodings")
    job.add_argument("--dataset", required=True)
    job.add_argument("--target", required=True)
    job.add_argument("--iterations", type=int, default=250)
    job.add_argument("--seed", type=int, default=duration.SEED)

    job = jobs.add_parser("predict-encoded", help="predict feature rows with that model")
    job.add_argument("--model", required=True)
    job.add_argument("--inputs", required=True)
    job.add_argument("--target", required=True)

    job = jobs.add_parser("predict", help="score a table of planned trips")
    job.add_argument("--models-base", required=True)
    job.add_argument("--inputs", required=True)
    job.add_argument("--target", required=True)
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "trips" and not (args.batch_root or args.stream_root):
        parser.error("give --batch-root, --stream-root or both")
    if args.job == "ingest" and not (args.replay_folder or (args.bootstrap_servers and args.topic)):
        parser.error("give --replay-folder, or --bootstrap-servers with --topic")
    if args.job == "serving" and args.month is not None and args.year is None:
        parser.error("--month needs --year")
    spark = open_session(f"triplake {args.job}")
    return _run(spark, args)


def _run(spark, args) -> int:
    if args.job == "land":
        manifest = bronze.land_files(
            spark, args.source, args.target, args.streaming_month, set(args.skip_month),
            only_changed=not args.again,
        )
        manifest.orderBy("source_period").show(truncate=False)
    elif args.job == "ingest":
        if args.replay_folder:
            source = ingest.replay_source(spark, args.replay_folder, args.max_per_trigger)
        else:
            source = ingest.kafka_source(
                spark,
                args.bootstrap_servers,
                args.topic,
                args.max_per_trigger,
                args.min_partitions,
            )
        query = ingest.start_ingest(
            source,
            args.streaming_month,
            args.target,
            args.checkpoint,
            args.trigger_seconds,
            args.until_done,
        )
        query.awaitTermination()
    elif args.job == "trips":
        trips.build_trips(
            spark,
            args.batch_root,
            args.stream_root,
            args.zones,
            args.target,
            set(args.month) if args.month else None,
            args.mode,
            args.rebalance,
        )
    elif args.job == "rebuild":
        if args.dataset and not args.test_month or args.model and not args.dataset:
            raise SystemExit("a dataset needs --test-month, a model needs --dataset")
        stages = [rebuild.trip_stage(
            spark, args.batch_root, args.stream_root, args.zones, args.target, args.rebalance
        )]
        if args.serving:
            stages.append(rebuild.serving_stage(spark, args.target, args.serving))
        if args.dataset:
            stages.append(rebuild.dataset_stage(spark, args.target, args.dataset, args.test_month))
        if args.model:
            stages.append(rebuild.model_stage(spark, args.dataset, args.model))
        rebuild.rebuild(
            spark, args.batch_root, args.stream_root, stages, args.manifest
        ).show(10_000, truncate=False)
    elif args.job == "refresh":
        periods = rebuild.refresh_serving(
            spark, args.batch_root, args.stream_root, args.zones, args.base, args.state
        )
        print("periods:", ", ".join(periods) or "none")
    elif args.job == "send":
        if (args.folder is None) == (args.bootstrap_servers is None):
            raise SystemExit("give either --bootstrap-servers or --folder")

        def publish(rows) -> None:
            if args.folder is not None:
                messages.store(rows, args.folder, args.topic)
            else:
                messages.send(rows, args.bootstrap_servers, args.topic)

        def arrived():
            return spark.read.schema(MESSAGE_SCHEMA).parquet(args.folder)

        known = args.folder is not None and folders.exists(spark, args.folder)
        print("rows sent:", stream.send_month(
            spark, args.source, args.month, publish, args.max_rows, args.partitions,
            args.log, arrived=arrived if known else None,
        ))
    elif args.job == "complete":
        state = stream.stream_state(
            spark, args.stream_root, args.checkpoint, args.topic, args.rows
        )
        state.show(truncate=False)
        return 0 if state.first()["state"] == "complete" else 1
    elif args.job == "serving":
        serving.build_serving(spark, args.trips, args.base, args.year, args.month, args.mode)
    elif args.job == "check":
        table = read_trips(spark, args.trips)
        quality.row_counts(table, "ingestion_source").show()
        quality.row_counts(table, "pickup_year").orderBy("pickup_year").show()
        quality.enrichment_gaps(table).show(truncate=False)
        report, passed = serving.check_serving(spark, args.trips, args.base)
        report.show(truncate=False)
        print("OVERALL RESULT:", "PASS" if passed else "FAIL")
        return 0 if passed else 1
    elif args.job == "export":
        serving.export_serving(spark, args.base, args.target)
    elif args.job == "dataset":
        duration.build_dataset(
            spark,
            args.trips,
            args.base,
            args.test_month,
            args.train_fraction,
            args.test_fraction,
            args.seed,
        ).show(truncate=False)
        if args.export_to:
            duration.export_dataset(spark, args.base, args.export_to)
    elif args.job == "train":
        duration.train_models(
            spark,
            args.dataset,
            args.models_base,
            args.scores,
            args.predictions,
            args.models,
            args.seed,
        ).show(truncate=False)
    elif args.job == "train-encoded":
        duration.train_encoded(
            spark, args.dataset, args.target, args.iterations, args.seed
        ).show(truncate=False)
    elif args.job == "predict-encoded":
        duration.predict_with_encoded(
            spark, args.model, spark.read.parquet(args.inputs), args.target
        )
    elif args.job == "predict":
        duration.predict_table(
            spark, args.models_base, spark.read.parquet(args.inputs), args.target
        )
    return 0


if __name__ == "__main__":
    sys.exit(main())
