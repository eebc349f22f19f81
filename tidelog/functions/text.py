"""String scalar functions: identifiers, literals, escapes, DDL targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..types import HEXED, NUMERIC
from .binary import hex_literal

#: What becomes of special characters in a quoted literal; the backslash goes first.
ESCAPES = [("\\", "\\\\"), ("\0", "\\0"), ("'", "\\'"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]


def quote_identifier(name: Column) -> Column:
    """back-quoted, with back-quotes doubled."""
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def escape_text(s: Column) -> Column:
    """special characters as backslash sequences."""
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), ESCAPES, s)


def quote_text(s: Column) -> Column:
    return F.concat(F.lit("'"), escape_text(s), F.lit("'"))


def escape_ansi(s: Column) -> Column:
    """for the metadata query: quotes and backslashes doubled."""
    return F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))


def literal(cell: Column) -> Column:
    """DEFAULT, NULL, a number, hex bytes, or quoted text. Bytes that are no UTF-8 text are hexed."""
    code = cell["type"]
    return (
        F.when(~cell["present"], F.lit("DEFAULT"))
        .when(cell["is_null"], F.lit("NULL"))
        .when(code.isin(NUMERIC), cell["as_string"])
        .when(code.isin(HEXED) | cell["as_string"].isNull(), hex_literal(cell["raw"]))
        .otherwise(quote_text(cell["as_string"]))
    )


def strip_ticks(s: Column) -> Column:
    """F5."""
    return F.replace(s, F.lit("`"), F.lit(""))


def starts_ci(s: Column, prefix: str) -> Column:
    """whether s begins with prefix, in any case."""
    return F.lower(F.substring(s, 1, len(prefix))) == prefix.lower()


def split_keep(s: Column, mark: str) -> Column:
    """F8: parts between marks, empty ones too."""
    return F.split(s, "\\" + mark, -1)


# Possessive where a statement may repeat: the engine then loops and does not recurse, however long the statement.
_NAME = r"(?:`(?:[^`]|``)++`|[^\s`.(;,]+)"
_TARGET = rf"({_NAME}(?:\s*\.\s*{_NAME})?)"
_HEAD = r"(?is)^\s*(?:/\*.*?\*/\s*)*+"
#: Statements that change a table: kind -> pattern whose first group is the target, or a list of them.
DDL = {
    "table": _HEAD + r"(?:create\s+(?:or\s+replace\s+)?(?:temporary\s+)?table\s+(?:if\s+not\s+exists\s+)?|alter\s+(?:ignore\s+)?table\s+|truncate\s+(?:table\s+)?)" + _TARGET,
    "view": _HEAD + r"(?:create|alter)\s+(?:or\s+replace\s+)?(?:algorithm\s*=\s*\w+\s+)?(?:definer\s*=\s*\S+\s+)?(?:sql\s+security\s+\w+\s+)?view\s+(?:if\s+not\s+exists\s+)?" + _TARGET,
    "index": _HEAD + r"(?:create\s+(?:unique\s+|fulltext\s+|spatial\s+)?index|drop\s+index)\s+(?:if\s+(?:not\s+)?exists\s+)?\S+\s+(?:using\s+\w+\s+)?on\s+" + _TARGET,
    "drop": _HEAD + r"drop\s+(?:temporary\s+)?(?:table|view)\s+(?:if\s+exists\s+)?(" + _TARGET[1:-1] + r"(?:\s*,\s*" + _TARGET[1:-1] + ")*+)",
    "rename": _HEAD + r"rename\s+table\s+(.+)$",
}


def ddl_targets(query: Column, default_schema: Column) -> Column:
    """array of (schema, table) that a statement changes; empty if it is no DDL.

    Knows optional clauses, ``ON table`` of index statements, and lists of DROP and RENAME.
    """
    single = F.lit(None).cast("string")
    for kind in ("index", "view", "table"):
        found = F.regexp_extract(query, DDL[kind], 1)
        single = F.when(found != "", found).otherwise(single)
    listed = F.split(F.regexp_extract(query, DDL["drop"], 1), r"\s*,\s*")
    pairs = F.split(F.regexp_replace(F.regexp_extract(query, DDL["rename"], 1), r";\s*$", ""), r"(?i)\s*,\s*|\s+to\s+")
    names = F.when(query.rlike(DDL["drop"]), listed).when(query.rlike(DDL["rename"]), pairs).when(single.isNotNull(), F.array(single)).otherwise(F.array().cast("array<string>"))

    def target(name):
        parts = F.split(F.trim(name), r"\s*\.\s*")
        bare = lambda x: F.replace(F.regexp_replace(x, "^`|`$", ""), F.lit("``"), F.lit("`"))
        two = F.size(parts) > 1
        return F.struct(
            F.when(two, bare(parts[0])).otherwise(default_schema).alias("schema"),
            bare(F.when(two, F.try_element_at(parts, F.lit(2))).otherwise(parts[0])).alias("table"),
        )

    return F.filter(F.transform(names, target), lambda t: (F.coalesce(t["schema"], F.lit("")) != "") & (t["table"] != ""))


def fixed6(x: Column) -> Column:
    """a float or double with six decimals."""
    return F.format_string("%.6f", x.cast("double"))


def terminate(query: Column) -> Column:
    """with a final semicolon and a newline; an empty query is a bare newline."""
    return F.concat(query, F.when((query == "") | F.endswith(query, F.lit(";")), F.lit("\n")).otherwise(F.lit(";\n")))
