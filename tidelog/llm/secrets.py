"""Secret scans with multipart credential linking, in DataFrame operations only.

Strong spans (assigned secrets, cloud access ids, long hex runs) are reported as they stand.
Weak candidates (an account name, a short password, an endpoint) mean little alone: the parts of
a scope (text between blank lines) are joined, and one is reported only where its complements
occur in its scope, however far. All parts of a scope are in one row, so the join runs on arrays
inside the row: one pass over the table, no shuffle, and no key that could be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_of

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"  # maximal runs of 16 or more
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

_NAME, _SET = r"(?<![A-Za-z0-9_])", r"""["']?\x20*[:=]\x20*["']?"""
IDENTIFIER = _NAME + r"(?i:user|username|user_?id|login|account|client_?id|access_?key|access_?key_?id)" + _SET + r"[A-Za-z0-9+/_.@=-]{3,}+"
WEAK = _NAME + r"(?i:pass|pwd|pw|pin|key|auth|bearer|credential|private_?key)" + _SET + r"[A-Za-z0-9+/_.=-]{4,}+"
ENDPOINT = (
    r"(?i:https?|ftp|sftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp|jdbc:[a-z]{2,12})://[^\s\"'<>]{3,}+"
    "|" + _NAME + r"(?i:host|hostname|server|endpoint|url)" + _SET + r"[A-Za-z0-9._:/-]{4,}+"
)
BREAK = r"\n[\x20\t]*+\n"
BASE, ADDED = ("assign", "access", "hex"), ("identifier", "weak", "endpoint")
ORDER = {kind: k for k, kind in enumerate((*BASE, *ADDED))}
MARK = "[secret]"
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,sure:boolean>>"
#: Positions are added up in slices of so many matches, as an array that grows is copied each time.
_SLICE = 500


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _placed(pairs: Column, place) -> Column:
    """array of ``place(start, end, pair)`` for pairs (gap, hit) that follow each other in a text."""
    width = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))

    def one(part, first):
        def step(acc, x):
            start = acc["at"] + F.length(x["gap"])
            return F.struct((acc["at"] + width(x)).alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("s"), x.alias("x")))).alias("out"))

        shape = F.transform(F.slice(part, 1, 0), lambda x: F.struct(F.lit(0).alias("s"), x.alias("x")))
        return F.aggregate(part, F.struct(first.alias("at"), shape.alias("out")), step, lambda acc: acc["out"])

    def whole(all_):
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _SLICE).cast("int")), lambda k: F.slice(all_, k * _SLICE + 1, F.lit(_SLICE)))
        sizes = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda n, x: n + width(x)))
        firsts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), F.slice(firsts, 1, F.size(parts)).alias("first")), lambda z: one(z["part"], z["first"])))

    made = lambda y: place(y["s"], y["s"] + F.length(y["x"]["hit"]), y["x"])
    return _let(pairs, lambda all_: F.transform(F.filter(whole(all_), lambda y: y["x"]["hit"].isNotNull()), made))


def _pairs(text: Column, pattern: str) -> Column:
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))


def _found(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """All leftmost non-overlapping matches as spans in code points; ``sure`` is what ``keep`` says of a match."""

    def span(start, end, x):
        sure = keep(x["hit"]) if keep else F.lit(True)
        return F.struct(start.alias("start"), F.lit(ORDER.get(kind, -1)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), sure.alias("sure"))

    there = text.rlike(pattern)
    there = _sets(text) & there if pattern in (ASSIGN, IDENTIFIER, WEAK, ENDPOINT) else there
    return F.when(there, _placed(_pairs(text, pattern), span).cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def _sets(text: Column) -> Column:
    """Whether anything can be assigned at all: a plain search before any pattern."""
    return text.contains(":") | text.contains("=")


def _assigned(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 1)) >= 8


def strong_spans(text: Column) -> Column:
    """The base spans, ordered by start, then kind."""
    assigned = F.filter(_found(text, ASSIGN, "assign", _assigned), lambda s: s["sure"])
    return F.sort_array(F.concat(assigned, _found(text, ACCESS, "access"), _found(text, HEX, "hex")))


def _has(spans: Column, *kinds: str) -> Column:
    return F.exists(spans, lambda x: x["kind"].isin(*kinds))


def _in_scope(text: Column) -> Column:
    """All spans of a scope: the strong ones, and weak candidates that overlap none and have their complements in it."""
    short = F.transform(F.filter(_found(text, ASSIGN, "weak", _assigned), lambda s: ~s["sure"]), lambda s: s.withField("sure", F.lit(True)))
    loose = F.concat(_found(text, IDENTIFIER, "identifier"), _found(text, WEAK, "weak"), short, _found(text, ENDPOINT, "endpoint"))

    def linked(both):
        strong, free = both["strong"], both["free"]
        secret = _has(strong, "assign", "hex") | _has(free, "weak")
        name, place = _has(strong, "access") | _has(free, "identifier"), _has(free, "endpoint")
        said = lambda flags: F.filter(free, lambda w: F.when(w["kind"] == "identifier", flags["secret"]).when(w["kind"] == "weak", flags["other"]).otherwise(flags["both"]))
        flags = F.struct(secret.alias("secret"), (name | place).alias("other"), (secret & name).alias("both"))
        return F.sort_array(F.array_distinct(F.concat(strong, _let(flags, said))))

    free = lambda strong: F.filter(loose, lambda w: ~F.exists(strong, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    return _let(strong_spans(text), lambda strong: _let(F.struct(strong.alias("strong"), free(strong).alias("free")), linked))


def _by_scope(text: Column) -> Column:
    """All spans of a text; no pattern matches over a line's end, so each scope is searched by itself."""
    scopes = F.transform(_pairs(text, BREAK), lambda x: F.struct(F.lit("").alias("gap"), F.concat(x["gap"], F.coalesce(x["hit"], F.lit(""))).alias("hit")))

    def shifted(start, _, x):
        spans = F.when(_sets(x["hit"]) | x["hit"].rlike(ACCESS + "|" + HEX), _in_scope(x["hit"])).otherwise(F.array().cast(_SPAN))
        return F.transform(spans, lambda s: s.withField("start", s["start"] + start).withField("end", s["end"] + start))

    return F.flatten(_placed(scopes, shifted))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secret_spans: array of (start, end, kind), code points, end exclusive.

    Ordered by start, then kind as in ``BASE`` and ``ADDED``. Null and empty texts have none; texts
    of any length are searched whole; rows stay as they are, repeated or not, and equal texts have
    equal spans; an empty table stays empty. A column named secret_spans in the input is replaced,
    any other name may occur.
    """
    columns = [c for c in docs.columns if c != "secret_spans"]
    kept = docs.select(columns)
    name = free_name(kept, "text_or_empty")
    text = F.col(name)
    short = lambda: F.exists(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), lambda v: F.length(v) < 8)
    weak = _sets(text) & (text.rlike("|".join((IDENTIFIER, WEAK, ENDPOINT))) | short())
    spans = F.when(weak, _by_scope(text)).otherwise(strong_spans(text))
    plain = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return kept.withColumn(name, text_of(F.col(text_col))).select(*columns, plain.alias("secret_spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in its text replaced by a mark, and n_chars as the new text has.

    Texts without secrets, null and empty ones stay as they are, and so do n_chars and all other
    columns; each row is treated for itself; an empty table stays empty.
    """

    def step(acc, s):
        gap = F.substring("text", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        more = F.concat(acc["out"], gap, F.when(s["start"] >= acc["at"], F.lit(MARK)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    tail = lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text")))
    spans, name = free_name(docs, "secret_spans"), free_name(docs, "redacted_text")
    found = scan(docs.withColumnRenamed("secret_spans", spans) if spans != "secret_spans" else docs)
    clean = F.when(F.size("secret_spans") > 0, F.aggregate("secret_spans", begin, step, tail)).otherwise(F.col("text"))
    changed = found.withColumn(name, clean)
    size = F.when(F.size("secret_spans") > 0, F.length(name).cast("long")).otherwise(F.col("n_chars"))
    made = {"text": F.col(name).alias("text"), "n_chars": size.alias("n_chars")} | ({"secret_spans": F.col(spans).alias("secret_spans")} if spans != "secret_spans" else {})
    return changed.select(*[made.get(c, F.col(c)) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base spans, their sha256, and all spans as text."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secret_spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs.select("doc_id", "text")).select("doc_id", *map(count, BASE), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("secret_spans")).alias("spans"))
