"""Command line, for spark-submit.

    spark-submit wardflow/main.py batch --lake URI --admissions URI --labs URI [--stage NAME ...]
    spark-submit wardflow/main.py stream --lake URI --checkpoints URI --brokers HOSTS
    spark-submit wardflow/main.py query --lake URI --endpoint summary
    spark-submit wardflow/main.py query --lake URI --endpoint finance-detail --csv URI
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardflow.plans import batch, endpoints  # noqa: E402
from wardflow.session import build_session  # noqa: E402
from wardflow.sources import files  # noqa: E402
from wardflow.sources.lake import Lake  # noqa: E402
from wardflow.streaming import jobs  # noqa: E402


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wardflow")
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("batch", help="run the nightly stages for one delivery")
    run.add_argument("--admissions", required=True)
    run.add_argument("--labs", required=True)
    run.add_argument("--batch-id",
                     default=datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S"))
    run.add_argument("--keep", type=int, default=2, help="published runs to keep")
    run.add_argument("--incremental", action="store_true",
                     help="merge the delivery into Silver instead of rebuilding it")
    run.add_argument("--stage", action="append", choices=batch.STAGES,
                     help="only these stages; give the batch id of the run they belong to")

    stream = commands.add_parser("stream", help="land vital signs and raise alerts")
    stream.add_argument("--checkpoints", required=True)
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers")
    source.add_argument("--folder")
    stream.add_argument("--available-now", action="store_true")
    stream.add_argument("--one-pass", action="store_true",
                        help="land readings, dead letters and alerts of a micro-batch together")

    query = commands.add_parser("query", help="print one endpoint or view as JSON lines")
    query.add_argument("--endpoint", required=True,
                       choices=[*endpoints.ENDPOINTS, *endpoints.VIEWS])
    query.add_argument("--csv", help="write it as headed CSV to this folder instead")

    for command in (run, stream, query):
        command.add_argument("--lake", required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"wardflow-{args.command}")
    lake = Lake(spark, args.lake)
    if args.command == "batch":
        batch.run_batch(spark, lake, args.batch_id, args.admissions, args.labs, keep=args.keep,
                        stages=args.stage, incremental=args.incremental)
    elif args.command == "stream":
        messages = (jobs.kafka_messages(spark, args.brokers) if args.brokers
                    else jobs.file_messages(spark, args.folder))
        if args.one_pass:
            jobs.start_vitals_in_one_pass(messages, lake.path("bronze"), args.checkpoints,
                                          args.available_now).awaitTermination()
            return
        queries = jobs.start_vitals(messages, lake.path("bronze"), args.checkpoints,
                                    available_now=args.available_now)
        for query in queries.values():
            query.awaitTermination()
    else:
        result = {**endpoints.ENDPOINTS, **endpoints.VIEWS}[args.endpoint](lake)
        if args.csv:
            files.write_csv(result, args.csv)
            return
        for line in result.toJSON().toLocalIterator():
            print(line)


if __name__ == "__main__":
    main()
