"""Logging by category."""

from __future__ import annotations

import logging

CATEGORIES = ("service", "connection", "handshake", "binlog", "parser", "query", "output", "checkpoint")
TRACE = 5
LEVELS = {"quiet": logging.ERROR, "normal": logging.INFO, "verbose": logging.DEBUG, "trace": TRACE}
logging.addLevelName(TRACE, "TRACE")


def logger(category: str) -> logging.Logger:
    return logging.getLogger(f"tidelog.{category}")


def parse_category(name: str) -> tuple[str, ...]:
    """The categories a name stands for; an unknown one is an error."""
    if name.lower() == "all":
        return CATEGORIES
    if name.lower() not in CATEGORIES:
        raise ValueError(f"unknown log category: {name}")
    return (name.lower(),)


def set_up(verbosity: str = "normal", categories: tuple[str, ...] = ("all",)) -> None:
    """Errors always show; the rest by verbosity, in the chosen categories."""
    chosen = {c for name in categories for c in parse_category(name)}
    for c in CATEGORIES:
        logger(c).setLevel(LEVELS[verbosity] if c in chosen else logging.ERROR)


def hex_dump(data: bytes, width: int = 16) -> str:
    """Offsets, bytes, printable text. Not for secrets."""
    lines = []
    for at in range(0, len(data), width):
        part = data[at : at + width]
        lines.append(f"{at:08x}  {part.hex(' '):<{3 * width}} {''.join(chr(c) if 32 <= c < 127 else '.' for c in part)}")
    return "\n".join(lines)
