"""A small encoder of replication events, for tests."""

import struct
import zlib

from tidelog.types import CODES


def event(kind, payload, pos=4, ts=1, crc=False):
    crc = crc or kind == 15  # that event has room for a checksum always
    size = 19 + len(payload) + 4 * crc
    head = struct.pack("<IBIIIH", ts, kind, 1, size, pos + size, 0)
    return head + payload + (struct.pack("<I", zlib.crc32(head + payload)) if crc else b"")


def query(text, schema="test"):
    return struct.pack("<IIBHH", 1, 0, len(schema), 0, 0) + schema.encode() + b"\0" + text.encode()


def format_description(alg=0, server="8.0.30-log"):
    return struct.pack("<H", 4) + server.encode().ljust(50, b"\0") + struct.pack("<IB", 0, 19) + bytes([19, alg])


def lenenc(n):
    return bytes([n]) if n < 0xFB else b"\xfc" + struct.pack("<H", n)


def bits(flags):
    out = bytearray((len(flags) + 7) // 8)
    for i, f in enumerate(flags):
        out[i >> 3] |= bool(f) << (i & 7)
    return bytes(out)


def table_map(table_id, schema, table, columns):
    """columns: (type name, meta bytes)."""
    types, metas = bytes(CODES[t] for t, _ in columns), b"".join(m for _, m in columns)
    name = lambda s: bytes([len(s)]) + s.encode() + b"\0"
    return table_id.to_bytes(6, "little") + b"\1\0" + name(schema) + name(table) + lenenc(len(types)) + types + lenenc(len(metas)) + metas + bits([1] * len(types))


def image(values, included=None):
    """values: encoded bytes, None for null; included: which columns are there."""
    here = [v for v, k in zip(values, included or [1] * len(values)) if k]
    return bits([v is None for v in here]) + b"".join(v for v in here if v is not None)


def rows(table_id, n, images, included=None, second=None, version=1):
    extra = struct.pack("<H", 2) if version == 2 else b""
    masks = bits(included or [1] * n) + (bits(second) if second else b"")
    return table_id.to_bytes(6, "little") + b"\1\0" + extra + lenenc(n) + masks + b"".join(images)


def gtid(uuid_hex, gno):
    return b"\1" + bytes.fromhex(uuid_hex) + struct.pack("<Q", gno)


def log(kinds_payloads, file="mysql-bin.000001", crc=False, start=4):
    """(log_file, start_pos, body) rows of events laid end to end."""
    out, pos = [], start
    for kind, payload in kinds_payloads:
        body = event(kind, payload, pos, crc=crc)
        out.append((file, pos, bytearray(body)))
        pos += len(body)
    return out
