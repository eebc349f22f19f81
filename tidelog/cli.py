"""Command line (A3): ``python -m tidelog --user u --password p --start-binlog mysql-bin.000001``."""

from __future__ import annotations

import argparse
import signal
import sys
import threading

from .config import Config
from .logs import CATEGORIES, parse_category


def parser() -> argparse.ArgumentParser:
    d = Config()
    p = argparse.ArgumentParser("tidelog", description="Replication log to ordered SQL.")
    p.add_argument("--host", default=d.host)
    p.add_argument("--port", type=int, default=d.port)
    p.add_argument("--user", required=True)
    p.add_argument("--password", required=True)
    p.add_argument("--server-id", type=int, default=d.server_id)
    p.add_argument("--start-binlog", dest="start_file", help="log file to begin with")
    p.add_argument("--start-pos", type=int, default=d.start_pos)
    p.add_argument("--start-gtid", help="GTID set that is already applied")
    p.add_argument("--checkpoint-file", default=d.checkpoint_file)
    p.add_argument("--output", default=d.output, help="path, or - for standard output")
    p.add_argument("--log-dir", help="read log files from a folder instead of a server")
    p.add_argument("--catalog", help="Parquet table of columns: schema, table, column, ordinal, column_key")
    p.add_argument("--threads", type=int, default=d.threads)
    p.add_argument("--decode-queue-size", type=int, default=d.decode_queue_size)
    p.add_argument("--work-queue-size", type=int, default=d.work_queue_size)
    for name, to in (("gtid", "include_gtid"), ("binlog-coords", "include_coords")):
        p.add_argument(f"--include-{name}", dest=to, action="store_true", default=True)
        p.add_argument(f"--no-{name}", dest=to, action="store_false")
    p.add_argument("--ha-lease-file", default=d.ha_lease_file)
    p.add_argument("--ha-node-id", default=d.ha_node_id)
    p.add_argument("--ha-timeout", type=int, default=d.ha_timeout)
    p.add_argument("--reconnect-delay-ms", type=int, default=d.reconnect_delay_ms)
    p.add_argument("--reconnect-delay-max-ms", type=int, default=d.reconnect_delay_max_ms)
    p.add_argument("--io-timeout-ms", type=int, default=d.io_timeout_ms)
    p.add_argument("--ssl", dest="use_tls", action="store_true")
    v = p.add_mutually_exclusive_group()
    v.add_argument("-q", "--quiet", dest="verbosity", action="store_const", const="quiet", default=d.verbosity)
    v.add_argument("-v", "--verbose", dest="verbosity", action="store_const", const="verbose")
    v.add_argument("-vv", "--trace", dest="verbosity", action="store_const", const="trace")
    p.add_argument("--log-category", dest="categories", action="append", choices=[*CATEGORIES, "all"])
    return p


def parse(argv: list[str]) -> Config:
    """A bad option ends with usage and status 2."""
    found = vars(parser().parse_args(argv))
    found["categories"] = tuple(c for name in found["categories"] or ["all"] for c in parse_category(name))
    return Config(**found)


def main(argv: list[str] | None = None) -> int:
    config = parse(sys.argv[1:] if argv is None else argv)
    from pyspark.sql import SparkSession

    from .streaming.service import run

    stop = threading.Event()
    for s in (signal.SIGINT, signal.SIGTERM):  # T11
        signal.signal(s, lambda *_: stop.set())
    return run(SparkSession.builder.appName("tidelog").getOrCreate(), config, stop=stop)
