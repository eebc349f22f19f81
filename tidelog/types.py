"""Types of the change stream: event codes, column type codes, and DataFrame schemas."""

from __future__ import annotations

# Fixed values of the public replication format.
QUERY, ROTATE, FORMAT_DESCRIPTION, XID, TABLE_MAP = 2, 4, 15, 16, 19
GTID, ANONYMOUS_GTID, PREVIOUS_GTIDS, PARTIAL_UPDATE, TRANSACTION_PAYLOAD = 33, 34, 35, 39, 40
WRITES, UPDATES, DELETES = (23, 30), (24, 31, 39), (25, 32)
ROWS = (*WRITES, *UPDATES, *DELETES)
WITH_EXTRA = (30, 31, 32, 39)  # rows events of version 2 carry extra data
HEADER = 19

#: code -> (name, literal class: numeric, hex or quoted, bytes of TABLE_MAP metadata)
COLUMN_TYPES = {
    0x00: ("DECIMAL", "Q", 0), 0x01: ("TINY", "N", 0), 0x02: ("SHORT", "N", 0), 0x03: ("LONG", "N", 0),
    0x04: ("FLOAT", "N", 1), 0x05: ("DOUBLE", "N", 1), 0x06: ("NULL", "Q", 0), 0x07: ("TIMESTAMP", "Q", 0),
    0x08: ("LONGLONG", "N", 0), 0x09: ("INT24", "N", 0), 0x0A: ("DATE", "Q", 0), 0x0B: ("TIME", "Q", 0),
    0x0C: ("DATETIME", "Q", 0), 0x0D: ("YEAR", "N", 0), 0x0F: ("VARCHAR", "Q", 2), 0x10: ("BIT", "N", 2),
    0x11: ("TIMESTAMP2", "Q", 1), 0x12: ("DATETIME2", "Q", 1), 0x13: ("TIME2", "Q", 1), 0xF5: ("JSON", "Q", 1),
    0xF6: ("NEWDECIMAL", "N", 2), 0xF7: ("ENUM", "Q", 1), 0xF8: ("SET", "Q", 1), 0xF9: ("TINY_BLOB", "H", 1),
    0xFA: ("MEDIUM_BLOB", "H", 1), 0xFB: ("LONG_BLOB", "H", 1), 0xFC: ("BLOB", "H", 1), 0xFD: ("VAR_STRING", "Q", 2),
    0xFE: ("STRING", "Q", 2), 0xFF: ("GEOMETRY", "H", 1),
}
CODES = {name: code for code, (name, *_) in COLUMN_TYPES.items()}
NUMERIC = [c for c, (_, k, _) in COLUMN_TYPES.items() if k == "N"]
HEXED = [c for c, (_, k, _) in COLUMN_TYPES.items() if k == "H"]

RAW = "log_file string, start_pos long, body binary"
CELL = "struct<is_null:boolean,present:boolean,type:smallint,raw:binary,as_string:string>"
COLUMN = "struct<name:string,type:smallint,meta:int,nullable:boolean,pk:boolean,uk:boolean>"
MAPS = "log_file string, start_pos long, table_id long, schema string, table string, types array<smallint>, metas array<int>, nullable array<boolean>, error string"
CHANGES = f"log_file string, start_pos long, table_id long, schema string, table string, op string, row_idx int, before array<{CELL}>, after array<{CELL}>, columns array<{COLUMN}>, error string"
INTERVALS = "sid string, start long, end long"
STATEMENTS = "seq long, row_idx int, sql string"


def spark_type(code: int, meta: int = 0) -> str:
    """The Spark SQL type of a column type, as DDL text, for a typed projection."""
    name = COLUMN_TYPES[code][0] if code in COLUMN_TYPES else "unknown"
    if name in ("DECIMAL", "NEWDECIMAL"):
        p, s = meta >> 8, meta & 0xFF
        return f"decimal({p},{s})" if 0 < p <= 38 else "string"
    return {
        "TINY": "tinyint", "SHORT": "smallint", "LONG": "int", "INT24": "int", "LONGLONG": "bigint", "FLOAT": "float", "DOUBLE": "double",
        "TIMESTAMP": "timestamp", "TIMESTAMP2": "timestamp", "DATE": "date", "DATETIME": "timestamp_ntz", "DATETIME2": "timestamp_ntz",
        "YEAR": "smallint", "BIT": "decimal(20,0)", "ENUM": "int", "SET": "bigint",
        "JSON": "binary", "TINY_BLOB": "binary", "MEDIUM_BLOB": "binary", "LONG_BLOB": "binary", "BLOB": "binary", "GEOMETRY": "binary",
    }.get(name, "string")
