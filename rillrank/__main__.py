"""Starts one streaming job: ``spark-submit -m rillrank JOB --source ... --out ... --checkpoint ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillrank import fixed, schemas
from rillrank.functions import json_records, text
from rillrank.operators import ranking
from rillrank.plans import jobs as plans
from rillrank.session import build_session
from rillrank.sources.lines import FileLines, KafkaLines, SocketLines, read_lines, read_table
from rillrank.streaming import carry, jobs, processors, sinks


def _lines(spark: SparkSession, args: argparse.Namespace, place: bool = False) -> DataFrame:
    match args.source:
        case "kafka":
            spec = KafkaLines(args.servers, args.topic, args.group)
        case "socket":
            host, port = args.servers.rsplit(":", 1)
            spec = SocketLines(host, int(port))
        case _:
            spec = FileLines(args.path, args.files_per_trigger)
    return read_lines(spark, spec, streaming=True, place=place)


def _rejects(parsed: json_records.Parsed, args: argparse.Namespace, every: str | None) -> list[StreamingQuery]:
    """Unreadable lines go to a table of their own if one is named."""
    if not args.rejects:
        return []
    return [sinks.start(parsed.rejects, sinks.to_files(args.rejects), f"{args.checkpoint}-rejects", every=every)]


def top_hosts(spark, args, every):
    parsed = plans.traffic_of_lines(_lines(spark, args), "failfast" if args.failfast else "permissive")
    started = jobs.stream_top_hosts(
        parsed.rows, args.out, args.checkpoint, args.order_by, args.n, report=args.report, delay=args.delay,
        every=every, show=args.print)
    return [started, *_rejects(parsed, args, every)]


def word_top_n(spark, args, every):
    return [jobs.stream_word_top_n(_lines(spark, args), args.out, args.checkpoint, n=args.n, delay=args.delay,
                                   every=every, show=args.print)]


def json_window_count(spark, args, every):
    parsed = json_records.parse_students(_lines(spark, args), mode="failfast" if args.failfast else "permissive")
    return [jobs.stream_json_window_count(parsed.rows, args.out, args.checkpoint, every=every),
            *_rejects(parsed, args, every)]


def running_word_count(spark, args, every):
    return [jobs.stream_word_count(_lines(spark, args), args.out, args.checkpoint, args.word, every)]


def running_max(spark, args, every):
    return [jobs.stream_running_max(_lines(spark, args), args.out, args.checkpoint, args.failfast, every)]


def line_counts(spark, args, every):
    lines = _lines(spark, args, place=True)
    return [jobs.stream_record_counts(lines, args.out, f"{args.checkpoint}-carried", args.checkpoint, args.word, every=every)]


def line_maxima(spark, args, every):
    lines = _lines(spark, args, place=True)
    return [jobs.stream_record_maxima(lines, args.out, f"{args.checkpoint}-carried", args.checkpoint, args.failfast,
                                      every=every)]


def window_all_count(spark, args, every):
    return [jobs.stream_window_all_count(_lines(spark, args), args.out, args.checkpoint, every=every)]


def _pairs(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return read_table(spark, args.path, schemas.KEYED_VALUES, args.files_per_trigger)


def breach_flags(spark, args, every):
    return [jobs.stream_breach_flags(_pairs(spark, args), args.out, args.checkpoint, args.threshold, every=every)]


def threshold_alerts(spark, args, every):
    found = processors.threshold_alerts(_pairs(spark, args), args.threshold, args.times)
    return [sinks.start(found, sinks.to_alert_files(args.out), args.checkpoint, every=every)]


def _carried(spark: SparkSession, args: argparse.Namespace, every: str | None, step: carry.Step) -> list[StreamingQuery]:
    return [carry.start(_pairs(spark, args), step, "seq", args.out, f"{args.checkpoint}-carried", args.checkpoint,
                        every=every)]


def record_sums(spark, args, every):
    return _carried(spark, args, every, carry.running_sum(["key"], "seq", "value"))


def record_maxima(spark, args, every):
    return _carried(spark, args, every, carry.running_max(["key"], "seq", "value"))


def carried_alerts(spark, args, every):
    return _carried(spark, args, every, carry.threshold_alerts(args.threshold, args.times))


def count_window_all(spark, args, every):
    return _carried(spark, args, every, carry.count_window_all("seq", args.size, "value"))


def count_window_slide(spark, args, every):
    return _carried(spark, args, every, carry.count_window_slide(["key"], "seq", args.size, args.slide, "value"))


def word_sessions(spark, args, every):
    words = text.tokenise(_lines(spark, args), ",")
    return [jobs.stream_sessions(words, args.out, args.checkpoint, args.gap, {"cnt": ("count", "1")}, ["word"],
                                 every=every)]


JOBS: dict[str, Callable[..., list[StreamingQuery]]] = {
    fn.__name__.replace("_", "-"): fn
    for fn in (top_hosts, word_top_n, json_window_count, running_word_count, running_max, window_all_count,
               line_counts, line_maxima, breach_flags, threshold_alerts, record_sums, record_maxima, carried_alerts, count_window_all,
               count_window_slide, word_sessions)
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="rillrank", description=__doc__)
    p.add_argument("job", choices=JOBS)
    p.add_argument("--source", choices=["kafka", "socket", "files"], default="kafka")
    p.add_argument("--servers", help="brokers, or host:port of a socket")
    p.add_argument("--topic")
    p.add_argument("--group", default="rillrank")
    p.add_argument("--path", help="text files, or the (seq, key, value) table of the threshold, record and count jobs")
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--rejects", help="table for unreadable lines")
    p.add_argument("--order-by", choices=ranking.ORDERS, default="session_num")
    p.add_argument("--n", type=int, default=fixed.TOP_N)
    p.add_argument("--report", action="store_true", help="text reports instead of rows")
    p.add_argument("--word", default=fixed.KEPT_WORD)
    p.add_argument("--threshold", type=int, default=fixed.ALERT_THRESHOLD)
    p.add_argument("--times", type=int, default=fixed.ALERT_TIMES)
    p.add_argument("--size", type=int, default=fixed.COUNT_WINDOW_SIZE, help="rows of a count window")
    p.add_argument("--slide", type=int, default=fixed.COUNT_WINDOW_SLIDE)
    p.add_argument("--gap", default=fixed.SESSION_GAP, help="of session windows")
    p.add_argument("--files-per-trigger", type=int, help="no limit if not given")
    p.add_argument("--delay", default=fixed.WATERMARK_DELAY, help="how late a row may be, of the top jobs")
    p.add_argument("--print", action="store_true", help="print the results of the top jobs as well")
    p.add_argument("--failfast", action="store_true", help="stop at an unreadable line")
    p.add_argument("--once", action="store_true", help="process what is there and stop")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    return JOBS[args.job](spark, args, None if args.once else fixed.CHECKPOINT_INTERVAL)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    for query in run(build_session(f"rillrank {args.job}"), args):
        query.awaitTermination()


if __name__ == "__main__":
    main()
