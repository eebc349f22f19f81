"""Chat formatting: roles from transcripts by a hidden Markov model, and canonical turns.

A row is a piece of a transcript (a turn, or several with speaker markers inside). Its segments
are the observations: the speaker marker in the text, if there is one, and line features (length,
question, number of lines). Hidden states are the roles. Recorded roles teach the model its counts,
of conversations that are not held out; decoding does not see them unless asked to, so that the
result says what the model recovers. Viterbi finds the best roles of a conversation, and turns are
rendered so that joining the pieces in order gives the canonical transcript.

A conversation of any length is decoded exactly without being gathered: the rows are range-sorted
by (conversation, turn); each partition sums up its open ends as max-plus matrices (best score
from the role before to the last role), which are chained on the driver, two for each partition;
then every partition decodes its own part between the roles at its ends.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, in_small_batches, shared_dir, text_of

ROLES = ("system", "user", "assistant")
# Names of speakers.
SPEAKERS = {
    "system": 0, "context": 0, "instruction": 0, "instructions": 0, "developer": 0,
    "user": 1, "human": 1, "customer": 1, "question": 1, "q": 1, "prompt": 1, "student": 1, "me": 1, "you": 1,
    "assistant": 2, "ai": 2, "bot": 2, "agent": 2, "answer": 2, "a": 2, "model": 2, "gpt": 2, "chatbot": 2, "teacher": 2,
}
MARKER = re.compile(r"^[ \t]*(?:<\|)?[#*\[]{0,3}[ \t]*(" + "|".join(sorted(SPEAKERS, key=len, reverse=True)) + r")[ \t]*[\]*]{0,3}[ \t]*(?:\|>|[:>])[ \t]*", re.I | re.M)
HEADER, FOOTER = "<|{role}|>\n", "\n<|end|>\n"
#: Share of speaker markers taken to be right; chance that text without a marker goes on in its role.
TRUST, STAY = 0.98, 0.97
ROWS = 20_000  # rows in a partition, about
_N = len(ROLES)


def segments(text: str, given: str | None) -> list[tuple[int, str]]:
    """(marked role or -1, text) of a row's segments; a row without markers is one segment."""
    own = SPEAKERS.get((given or "").strip().lower(), -1)
    found = list(MARKER.finditer(text)) if ":" in text or ">" in text else []
    if not found:
        return [(own, text)]
    out = [(own, text[: found[0].start()].strip("\n"))] if text[: found[0].start()].strip() else []
    for m, after in zip(found, [*(m.start() for m in found[1:]), len(text)]):
        out.append((SPEAKERS[m[1].lower()], text[m.end() : after].strip("\n")))
    return out


def features(text: str) -> tuple[int, int, int]:
    """Bucket of the length, whether it ends in a question, bucket of its lines."""
    return min(14, len(text).bit_length()), int(text.rstrip().endswith("?")), min(4, text.count("\n").bit_length())


class Model:
    """Log probabilities from counts, each count raised by one."""

    def __init__(self, counts: Counter):
        def logs(kind: str, sizes: tuple[int, ...]) -> np.ndarray:
            table = np.ones(sizes)
            for key, n in counts.items():
                if key[0] == kind:
                    table[key[1:] if len(sizes) > 1 else key[1]] += n
            return np.log(table / table.sum(axis=-1, keepdims=True))

        self.start, self.change = logs("start", (_N,)), logs("change", (_N, _N))
        self.tables = [logs("length", (_N, 15)), logs("question", (_N, 2)), logs("lines", (_N, 5))]
        self.stay = np.log(np.full((_N, _N), (1 - STAY) / (_N - 1)) + np.eye(_N) * (STAY - (1 - STAY) / (_N - 1)))
        self.marked = np.log(np.full((_N, _N), (1 - TRUST) / (_N - 1)) + np.eye(_N) * (TRUST - (1 - TRUST) / (_N - 1)))

    def emission(self, mark: int, seen: tuple[int, int, int]) -> np.ndarray:
        out = sum(t[:, k] for t, k in zip(self.tables, seen))
        return out + self.marked[mark] if mark >= 0 else out

    def step(self, inside: bool, mark: int) -> np.ndarray:
        """Transition scores: within a row a segment without a marker mostly goes on."""
        return self.stay if inside and mark < 0 else self.change


def viterbi(model: Model, seen: list, before: np.ndarray | None, last: int | None) -> tuple[list[int], float]:
    """Best roles of observations (mark, features, inside); ``before``: scores of the role before, ``last``: the last role, if known."""
    score, back = None, []
    for mark, f, inside in seen:
        if score is None and before is None:
            score = model.start + model.emission(mark, f)
            back.append(np.full(_N, -1))
            continue
        ways = (before if score is None else score)[:, None] + model.step(inside, mark)
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + model.emission(mark, f)
    role = int(score.argmax()) if last is None else last
    best, roles = float(score[role]), []
    for b in reversed(back):
        roles.append(role)
        role = int(b[role])
    return roles[::-1], best


def transfer(model: Model, seen: list) -> np.ndarray:
    """Max-plus matrix: best score of the observations from the role before (row) to the last (column)."""
    out = np.where(np.eye(_N, dtype=bool), 0.0, -np.inf)
    for mark, f, inside in seen:
        out = (out[:, :, None] + model.step(inside, mark)[None]).max(axis=1) + model.emission(mark, f)
    return out


def _groups(batches: Iterator[pa.RecordBatch], recorded: bool):
    """(conversation, rows) of a sorted partition; a row: (turn, given role, segments). ``recorded``: the given role is a marker."""
    conv, rows, began = None, [], False
    for batch in batches:
        for c, turn, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if not began or c != conv:
                if began:
                    yield conv, rows
                conv, rows, began = c, [], True
            rows.append((turn, role, segments(text, role if recorded else None)))
    if began:
        yield conv, rows


def _observed(rows: list) -> list:
    return [(mark, features(text), k > 0) for _, _, parts in rows for k, (mark, text) in enumerate(parts)]


def apart(conv: int | None) -> bool:
    """Whether a conversation is held out, as ``common.held_out`` says of its id."""
    return conv is None or zlib.crc32(str(conv).encode()) % 4 == 2


_ENDS = "part int, place int, conv_id long, known boolean, counts array<struct<kind:string,a:int,b:int,n:long>>, matrix array<double>"
_KINDS = ("length", "question", "lines")


def _ends(model: Model | None, recorded: bool = True):
    """For mapInArrow: a partition's counts (no model) or matrices of its first and last conversation."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, counts, edges = TaskContext.get().partitionId(), Counter(), []
        for conv, rows in _groups(batches, recorded):
            seen = _observed(rows)
            if model is None:
                marks = [m for m, _, _ in seen]
                edge = [float(marks[0]), float(marks[-1])]
                if not apart(conv):
                    for (mark, found, inside), previous in zip(seen, [-1, *marks]):
                        if mark < 0:
                            continue
                        for kind, value in zip(_KINDS, found):
                            counts[(kind, mark, value)] += 1
                        if previous >= 0 and not inside:
                            counts[("change", previous, mark)] += 1
                    counts[("start", int(edge[0]), -1)] += edge[0] >= 0
            else:
                edge = transfer(model, seen).ravel().tolist()
                edge += viterbi_scores(model, seen, model.emission(*seen[0][:2]) + model.start).tolist()  # were it to begin here
            edges = [*edges[:1], (conv, edge)] if edges else [(conv, edge)]
        listed = [{"kind": kind, "a": a, "b": b, "n": n} for (kind, a, b), n in counts.items()]
        out = [{"part": part, "place": k, "conv_id": c, "known": c is not None, "counts": listed if k == 0 else None, "matrix": e} for k, (c, e) in enumerate(edges)]
        count = pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
        schema = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("conv_id", pa.int64()), ("known", pa.bool_()), ("counts", pa.list_(count)), ("matrix", pa.list_(pa.float64()))])
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return work


def viterbi_scores(model: Model, seen: list, first: np.ndarray) -> np.ndarray:
    """Best scores by last role of observations that begin a conversation; ``first``: scores of the first."""
    score = first
    for mark, f, inside in seen[1:]:
        score = (score[:, None] + model.step(inside, mark)).max(axis=0) + model.emission(mark, f)
    return score


def _chains(edges: list) -> list[list[int]]:
    """Indices of edges that belong to one conversation over several partitions, in order.

    edges: (part, place, conversation) sorted; a partition with one conversation has one edge.
    """
    chains, current = [], []
    for k, (part, _, conv) in enumerate(edges):
        if current and edges[current[-1]][2] == conv and part > edges[current[-1]][0]:
            current.append(k)
        else:
            chains.append(current)
            current = [k]
    return [c for c in [*chains, current] if len(c) > 1]


def sorted_rows(convs: DataFrame) -> DataFrame:
    """The rows, range-sorted by (conversation, turn, text) and fixed so; no conversation needs one partition."""
    spark = convs.sparkSession
    role = F.col("role").cast("string") if "role" in convs.columns else F.lit(None).cast("string")
    rows = in_small_batches(convs).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text_of(F.col("text")).alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS))
    keys = [F.col("conv_id"), F.col("turn"), F.xxhash64("text", "role"), F.monotonically_increasing_id()]
    shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    marked = rows.withColumn("_tie", keys[2]).withColumn("_n", keys[3])
    order = ["conv_id", "turn", "_tie", "_n"]
    return marked.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text").checkpoint()


def fit(rows: DataFrame) -> Model:
    """The model from the marked segments of ``sorted_rows`` that are not held out; without any, even odds."""
    found = sorted(rows.mapInArrow(_ends(None), _ENDS).collect(), key=lambda r: (r.part, r.place))
    counts: Counter = Counter()
    for r in found:
        counts.update({(c.kind, c.a, c.b): c.n for c in r.counts or []})
    edges = [(r.part, r.place, r.conv_id) for r in found]
    for chain in _chains(edges):
        if apart(edges[chain[0]][2]):
            continue
        for a, b in zip(chain, chain[1:]):  # counted as a start, but it goes on
            before, first = int(found[a].matrix[1]), int(found[b].matrix[0])
            if first >= 0:
                counts[("start", first, -1)] -= 1
                if before >= 0:
                    counts[("change", before, first)] += 1
    return Model(counts)


def chat(convs: DataFrame, model: Model | None = None, use_roles: bool = False) -> DataFrame:
    """(conv_id, turn, part, role, given_role, held_out, starts_turn, rendered) of every segment of every row.

    convs: conv_id, turn, text, and role if recorded (a speaker's name). The model learns from the
    roles of conversations that are not held out; ``role`` is what it recovers from the texts alone,
    or, with ``use_roles``, with recorded roles taken as markers. Joining ``rendered`` in order of
    (conv_id, turn, part) gives each conversation's canonical transcript: neighbouring segments of
    one role make one turn. Null and empty texts are segments like any other; long ones count whole;
    null ids are one conversation; rows with the same turn follow by a hash of their text, repeated
    rows one after the other; an empty table gives no rows; other columns are ignored.
    """
    rows = sorted_rows(convs)
    model = model or fit(rows)
    found = sorted(rows.mapInArrow(_ends(model, use_roles), _ENDS).collect(), key=lambda r: (r.part, r.place))
    edges = [(r.part, r.place, r.conv_id) for r in found]
    before: dict[tuple[int, int], list] = {}  # scores of the role before an edge, and that role
    last: dict[tuple[int, int], int] = {}
    for chain in _chains(edges):
        scores = [np.array(found[chain[0]].matrix[_N * _N :])]
        for k in chain[1:]:
            scores.append((scores[-1][:, None] + np.array(found[k].matrix[: _N * _N]).reshape(_N, _N)).max(axis=0))
        role = int(scores[-1].argmax())
        for n in range(len(chain) - 1, 0, -1):
            part, place, _ = edges[chain[n]]
            last[(part, place)] = role
            matrix = np.array(found[chain[n]].matrix[: _N * _N]).reshape(_N, _N)
            role = int((scores[n - 1] + matrix[:, role]).argmax())
            before[(part, place)] = [scores[n - 1].tolist(), role]
        last[edges[chain[0]][:2]] = role
    goes_on = {edges[k][:2] for chain in _chains(edges) for k in chain[:-1]}
    ends: dict[int, int] = defaultdict(int)
    for part, place, _ in edges:
        ends[part] = max(ends[part], place)
    schema = "conv_id long, turn long, part int, role string, given_role string, starts_turn boolean, rendered string"
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string()]
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        groups = _groups(batches, use_roles)
        current, first = next(groups, None), True
        while current is not None:
            following = next(groups, None)
            conv, rows_ = current
            place = 0 if first else 1
            mine = (part, place) if first or following is None and ends[part] == 1 else None
            enters, forced = (before.get(mine), last.get(mine)) if mine else (None, None)
            roles, _ = viterbi(model, _observed(rows_), np.array(enters[0]) if enters else None, forced)
            previous, at = enters[1] if enters else None, 0
            closes = mine not in goes_on
            for turn, given, parts in rows_:
                for k, (_, text) in enumerate(parts):
                    role = roles[at]
                    at += 1
                    starts = role != previous
                    head = (FOOTER if previous is not None else "") + HEADER.format(role=ROLES[role]) if starts else "\n"
                    out.append((conv, turn, k, ROLES[role], given, starts, head + text + (FOOTER if closes and at == len(roles) else "")))
                    previous = role
            if len(out) >= 5000 or following is None:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                out = []
            current, first = following, False

    made = rows.mapInArrow(work, schema)
    return made.select("conv_id", "turn", "part", "role", "given_role", held_out(F.col("conv_id")).alias("held_out"), "starts_turn", "rendered")
