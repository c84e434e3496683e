"""Run a job: ``python -m studytrail sessions course --jdbc-file connection.json``, or
``spark-submit`` with this file. Secrets belong in the connection file, not on the line."""

from __future__ import annotations

import argparse
import json

from studytrail import jobs
from studytrail.runtime import build_session


def _pair(text: str) -> tuple[str, str]:
    key, sep, value = text.partition("=")
    if not sep:
        raise argparse.ArgumentTypeError(f"{text!r} is not key=value")
    return key, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="studytrail")
    top.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    commands = top.add_subparsers(dest="command", required=True)

    sessions = commands.add_parser("sessions", help="log tables to a session table")
    sessions.add_argument("name", choices=[*jobs.SESSION_TABLES, "all"])
    sessions.add_argument("--jdbc", type=_pair, action="append", default=[], metavar="KEY=VALUE")
    sessions.add_argument("--jdbc-file", help="connection options as a JSON object")
    sessions.add_argument("--mode", choices=["clean", "compat"], default="clean")
    sessions.add_argument("--partitions", type=int, default=200)
    sessions.add_argument("--state", help="folder of the sessions kept from run to run; only new rows are read (clean mode)")
    sessions.add_argument("--heartbeat-position", default="ct", help="heartbeat column that grows in the order of arrival")

    def stream(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--servers", required=True)
        sub.add_argument("--topic", required=True)
        return sub

    relay = stream("relay", "topic to topic")
    relay.add_argument("which", choices=list(jobs.RELAYS))
    relay.add_argument("--target", required=True)
    relay.add_argument("--checkpoint", required=True)
    relay.add_argument("--starting", default="latest", help="latest, earliest or offsets as JSON")

    report = stream("report", "answers to the running report")
    report.add_argument("--root", required=True)
    report.add_argument("--mode", choices=["clean", "compat"], default="clean")

    publish = commands.add_parser("publish", help="summary cells and leaderboards of a running report")
    for name in ("--root", "--points", "--tasks"):
        publish.add_argument(name, required=True)
    publish.add_argument("--mode", choices=["clean", "compat"], default="clean")
    publish.add_argument("--compact", action="store_true", help="also fold finished batches")

    dimension = stream("dimension", "a dimension topic to its cell table")
    dimension.add_argument("dimension", choices=list(jobs.DIMENSIONS))
    dimension.add_argument("--path", required=True)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"studytrail-{args.command}", master=args.master)
    if args.command == "sessions":
        names = list(jobs.SESSION_TABLES) if args.name == "all" else [args.name]
        connection = {}
        if args.jdbc_file:
            with open(args.jdbc_file) as file:
                connection = json.load(file)
        connection |= dict(args.jdbc)
        if args.state and args.mode == "compat":
            raise SystemExit("--state needs the clean mode")
        if args.state:
            jobs.incremental_session_jobs(
                spark, connection, names, args.state, args.partitions, heartbeat_position=args.heartbeat_position
            )
        else:
            jobs.session_jobs(spark, connection, names, args.mode, args.partitions)
        return
    if args.command == "publish":
        jobs.publish_job(spark, args.root, args.points, args.tasks, args.mode, args.compact)
        return
    if args.command == "relay":
        query = jobs.relay_job(
            spark, args.servers, args.which, args.topic, args.target, args.checkpoint, args.starting
        )
    elif args.command == "report":
        query = jobs.report_job(spark, args.servers, args.topic, args.root, args.mode)
    else:
        query = jobs.dimension_job(spark, args.servers, args.topic, args.dimension, args.path)
    query.awaitTermination()


if __name__ == "__main__":
    main()
