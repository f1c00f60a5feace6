"""Command line: build, ingest, watch, query and check a layout.

    python -m coinweir BASE build [--full-refresh] [--source landing] [--lines]
    python -m coinweir BASE ingest FOLDER [--source reconciliation] [--lines] [--every "1 minute" | --sweep] [--land-only]
    python -m coinweir BASE watch [--source landing] [--lines] [--every "1 minute"]
    python -m coinweir BASE compact [--keep-hours 168]
    python -m coinweir BASE sql ["select * from subscriptions"] [--rows 100 | --into FOLDER]
    python -m coinweir BASE health

`--input-gb N` before the action says how much a job reads, which sets how finely its shuffles start out. `sql` shows the first
rows of each result and says if there are more; `--into` writes whole results as Parquet instead.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from coinweir.layout import Layout
from coinweir.plans.api import for_presentation, run_sql
from coinweir.plans.pipeline import LANDING, RAW, build
from coinweir.session import session_builder
from coinweir.sources.compaction import KEEP_HOURS, compact_landing
from coinweir.streaming.heartbeat import liveness
from coinweir.streaming.ingest import ingest, start_ingest, sweep
from coinweir.streaming.rebuild import start_landing_watch, start_raw_watch
from coinweir.vocab import RECONCILIATION, WEBHOOK

SHOWN_ROWS = 100


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="coinweir")
    parser.add_argument("base")
    parser.add_argument("--input-gb", type=float)
    actions = parser.add_subparsers(dest="action", required=True)
    built = actions.add_parser("build")
    built.add_argument("--full-refresh", action="store_true")
    built.add_argument("--source", choices=[RAW, LANDING], default=RAW)
    built.add_argument("--lines", action="store_true")
    taken = actions.add_parser("ingest")
    taken.add_argument("folder")
    taken.add_argument("--source", choices=[WEBHOOK, RECONCILIATION], default=WEBHOOK)
    taken.add_argument("--lines", action="store_true")
    how = taken.add_mutually_exclusive_group()
    how.add_argument("--every")
    how.add_argument("--sweep", action="store_true", help="move files to the archive instead of remembering them")
    taken.add_argument("--land-only", action="store_true")
    watched = actions.add_parser("watch")
    watched.add_argument("--source", choices=[RAW, LANDING], default=RAW)
    watched.add_argument("--lines", action="store_true")
    watched.add_argument("--every")
    compacted = actions.add_parser("compact", help="fold closed landing months")
    compacted.add_argument("--keep-hours", type=float, default=KEEP_HOURS)
    asked = actions.add_parser("sql")
    asked.add_argument("text", nargs="?")
    asked.add_argument("--rows", type=int, default=SHOWN_ROWS)
    asked.add_argument("--into")
    actions.add_parser("health")
    return parser.parse_args(argv)


def run(spark: SparkSession, given: argparse.Namespace) -> int:
    """Carry out one action; the result is the exit status."""
    layout = Layout(given.base)
    if given.action == "build":
        for warning in build(spark, layout, given.source, given.full_refresh, lines=given.lines):
            print(f"warning: {warning}")
    elif given.action == "ingest":
        options = {"source": given.source, "lines": given.lines, "rebuild": not given.land_only}
        if given.every:
            started = start_ingest(spark, layout, given.folder, every=given.every, **options)
            started.query.awaitTermination()
        else:
            take = sweep if given.sweep else ingest
            print(f"landed {take(spark, layout, given.folder, **options).landed}")
    elif given.action == "watch" and given.source == LANDING:
        start_landing_watch(spark, layout, given.every).awaitTermination()
    elif given.action == "watch":
        start_raw_watch(spark, layout, given.lines, given.every).awaitTermination()
    elif given.action == "compact":
        print(f"folded {len(compact_landing(spark, layout, keep_hours=given.keep_hours))} months")
    elif given.action == "sql":
        for number, result in enumerate(run_sql(spark, layout, given.text)):
            if given.into:
                result.write.parquet(f"{given.into.rstrip('/')}/{number}")
            else:
                for_presentation(result).show(given.rows, truncate=False)
    elif given.action == "health":
        signals = liveness(spark, layout).collect()
        for signal in signals:
            print(f"{signal.signal}: {'stale' if signal.is_stale else 'alive'}, last seen {signal.last_at}")
        return int(any(signal.is_stale for signal in signals))
    return 0


if __name__ == "__main__":
    asked = arguments()
    size = None if asked.input_gb is None else int(asked.input_gb * 1024**3)
    raise SystemExit(run(session_builder(input_bytes=size).getOrCreate(), asked))
