"""Options of a run and their defaults (A4)."""

from __future__ import annotations

import os
import socket
from dataclasses import dataclass, field


@dataclass
class Config:
    host: str = "127.0.0.1"
    port: int = 3306
    user: str = ""
    password: str = field(default="", repr=False)
    server_id: int = 1001
    start_file: str | None = None
    start_pos: int = 4
    start_gtid: str | None = None
    checkpoint_file: str = "tidelog.checkpoint"
    output: str = "-"
    log_dir: str | None = None  # a folder of log files instead of a server; or where a server's are kept
    catalog: str | None = None  # a Parquet table of columns (schema, table, column, ordinal, column_key)
    ha_lease_file: str = ""
    ha_node_id: str = field(default_factory=lambda: f"{socket.gethostname()}-{os.getpid()}")
    ha_timeout: int = 15
    reconnect_delay_ms: int = 500
    reconnect_delay_max_ms: int = 8000
    io_timeout_ms: int = 1000
    use_tls: bool = False
    include_gtid: bool = True
    include_coords: bool = True
    dedupe_begin: bool = True
    decode_queue_size: int = 1024
    work_queue_size: int = 1024
    threads: int = 4
    verbosity: str = "normal"
    categories: tuple[str, ...] = ("all",)

    @property
    def events_per_batch(self) -> int:
        """Admission of a micro-batch stands for the bounded queues."""
        return max(1, self.decode_queue_size) * max(1, self.threads)


def start_position(config: Config, checkpoint) -> dict:
    """{file, pos, gtid_set}; what is asked for goes before the checkpoint; neither is an error.

    With a GTID set alone the file is empty and the position 4; an executed set in the checkpoint
    goes before a configured one.
    """
    if config.start_file is not None:
        return {"file": config.start_file, "pos": config.start_pos, "gtid_set": config.start_gtid}
    if config.start_gtid is not None:
        return {"file": "", "pos": 4, "gtid_set": config.start_gtid}
    if checkpoint:
        return {"file": checkpoint.file, "pos": checkpoint.position, "gtid_set": checkpoint.gtid_set}
    raise ValueError("no start position: give --start-binlog or --start-gtid, or a checkpoint")
