"""Command line for the listing applications, for ``spark-submit``:

    spark-submit lotcast/cli.py batch --train T.csv --test S.csv --out s3://b/out
    spark-submit lotcast/cli.py ingest --kafka broker:9092 --topic listings --landed s3://b/landed
    spark-submit lotcast/cli.py score --landed s3://b/landed --models s3://b/models --out s3://b/scores
    spark-submit lotcast/cli.py score-stream --landed s3://b/landed --models s3://b/models --out s3://b/s

Outputs go to ``--out`` as Parquet/CSV/JSON (``--format``) or, with
``--jdbc-url``, to JDBC tables. Checkpoints and intermediate tables go
under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from lotcast import schemas as S  # noqa: E402
from lotcast.ml import Registry, load_all  # noqa: E402
from lotcast.plans.listing_jobs import (  # noqa: E402
    SCORE_TABLES,
    Sink,
    ingest_messages,
    run_batch,
    score_landed,
    score_landed_stream,
)
from lotcast.session import scratch_root  # noqa: E402
from lotcast.sinks import jdbc_options  # noqa: E402
from lotcast.sources import kafka_options  # noqa: E402
from lotcast.streaming import open_kafka, open_stream  # noqa: E402


def _sink(args) -> Sink:
    if args.jdbc_url:
        return Sink("jdbc", options=jdbc_options(args.jdbc_url, user=args.jdbc_user,
                                                 password=os.environ.get(args.jdbc_password_env or "", None),
                                                 driver=args.jdbc_driver, batchsize=args.jdbc_batchsize,
                                                 truncate=True, num_partitions=args.jdbc_partitions),
                    swap=args.jdbc_swap)
    return Sink(args.format, args.out)


def _model_paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in SCORE_TABLES}


def _scored_with(spark: SparkSession, args) -> dict[str, str]:
    if args.registry:
        release = Registry(spark, args.registry).current()
        if release is None:
            raise SystemExit(f"no release of models under {args.registry}")
        return release.paths
    if not args.models:
        raise SystemExit("--models or --registry is needed")
    return _model_paths(args.models)


def _add_sink_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--out", help="output folder for file sinks (JDBC outputs use fixed table names)")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-batchsize", type=int, default=10000)
    p.add_argument("--jdbc-partitions", type=int, default=8)
    p.add_argument("--jdbc-swap", action="store_true", help="replace whole tables in one step, without a gap")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="lotcast")
    sub = ap.add_subparsers(dest="command", required=True)

    b = sub.add_parser("batch", help="clean, train, evaluate, report")
    b.add_argument("--train", required=True)
    b.add_argument("--test", required=True)
    b.add_argument("--input-format", default="csv")
    b.add_argument("--models", help="model folder (default: under the checkpoint dir)")
    b.add_argument("--registry", help="publish the models as the next release of this registry instead")
    b.add_argument("--reject-nan", action="store_true")
    b.add_argument("--malformed-table", help="also write input lines that do not parse to this output")
    _add_sink_args(b)

    i = sub.add_parser("ingest", help="land JSON listing messages")
    i.add_argument("--kafka", help="bootstrap servers; without it --source is a folder of JSON lines")
    i.add_argument("--topic", default="listings")
    i.add_argument("--source")
    i.add_argument("--max-offsets", type=int)
    i.add_argument("--landed", required=True)
    i.add_argument("--landed-format", default="parquet", choices=["parquet", "csv"])
    i.add_argument("--trigger", default=S.INGEST_INTERVAL, help='interval, or "availableNow"')
    i.add_argument("--checkpoint", help="default: <spark.checkpoint.dir>/lotcast/ingest")

    s = sub.add_parser("score", help="score everything landed, once")
    s.add_argument("--landed", required=True)
    s.add_argument("--models")
    s.add_argument("--registry", help="score with the newest release of this registry")
    s.add_argument("--reference-shape", action="store_true")
    _add_sink_args(s)

    t = sub.add_parser("score-stream", help="score new landed files as they arrive")
    t.add_argument("--landed", required=True)
    t.add_argument("--models")
    t.add_argument("--registry", help="take the newest release of this registry for every micro-batch")
    t.add_argument("--trigger", default=S.SCORE_INTERVAL, help='interval, or "availableNow"')
    t.add_argument("--checkpoint", help="default: <spark.checkpoint.dir>/lotcast/score")
    t.add_argument("--max-files", type=int, help="most landed files per micro-batch")
    _add_sink_args(t)
    return ap


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"lotcast-{args.command}").getOrCreate()
    ckpt = scratch_root(spark)
    if args.command == "batch":
        result = run_batch(spark, args.train, args.test, _sink(args), fmt=args.input_format,
                           model_root=args.models, reject_nan=args.reject_nan,
                           malformed_table=args.malformed_table,
                           registry=Registry(spark, args.registry) if args.registry else None)
    elif args.command == "ingest":
        if args.kafka:
            messages = open_kafka(spark, kafka_options(args.kafka, args.topic,
                                                       max_offsets_per_trigger=args.max_offsets))
        else:
            messages = open_stream(spark, args.source, "value string", fmt="text")
        keep = ["partition", "offset"] if args.kafka else []
        ingest_messages(messages, args.landed, args.checkpoint or f"{ckpt}/lotcast/ingest", fmt=args.landed_format,
                        trigger=args.trigger, keep=keep).awaitTermination()
        result = {"landed": args.landed}
    elif args.command == "score":
        result = score_landed(spark, args.landed, _scored_with(spark, args), _sink(args),
                              reference_shape=args.reference_shape)
    else:
        sink = _sink(args)
        out = "listing_scores" if sink.fmt == "jdbc" else args.out
        registry = Registry(spark, args.registry) if args.registry else None
        q = score_landed_stream(spark, args.landed, None if registry else load_all(_scored_with(spark, args)), out,
                                args.checkpoint or f"{ckpt}/lotcast/score", trigger=args.trigger,
                                jdbc=sink if sink.fmt == "jdbc" else None,
                                max_files_per_trigger=args.max_files, registry=registry)
        q.awaitTermination()
        result = {"scores": out}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
