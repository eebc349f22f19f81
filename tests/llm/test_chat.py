from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from tidelog.llm import chat as ch


@pytest.fixture(scope="module")
def convs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/conversations.parquet")


@pytest.fixture(scope="module")
def model(convs):
    return ch.fit(ch.sorted_rows(convs))


def total(model, seen, roles):
    out, before = 0.0, None
    for (mark, f, inside), role in zip(seen, roles):
        out += (model.start[role] if before is None else model.step(inside, mark)[before, role]) + model.emission(mark, f)[role]
        before = role
    return out


def test_viterbi_by_brute_force(model):
    rng = np.random.default_rng(2)
    for _ in range(30):
        seen = [(int(rng.integers(-1, 3)), (int(rng.integers(0, 15)), int(rng.integers(0, 2)), int(rng.integers(0, 5))), bool(k and rng.integers(0, 2))) for k in range(rng.integers(1, 6))]
        roles, best = ch.viterbi(model, seen, None, None)
        most = max(total(model, seen, r) for r in product(range(3), repeat=len(seen)))
        assert abs(best - most) < 1e-9 and abs(total(model, seen, roles) - most) < 1e-9
        for last in range(3):
            roles, best = ch.viterbi(model, seen, None, last)
            assert roles[-1] == last and abs(best - max(total(model, seen, (*r, last)) for r in product(range(3), repeat=len(seen) - 1))) < 1e-9


def test_markers():
    text = "hello\nUser: hi there\nmore\n### Assistant: yes?\n[system] > x: y\nratio 3: 4"
    assert ch.segments(text, "Human") == [(1, "hello"), (1, "hi there\nmore"), (2, "yes?"), (0, "x: y\nratio 3: 4")]
    assert ch.segments("no marks", "robot") == [(-1, "no marks")] and ch.segments("", None) == [(-1, "")]


def test_roles_are_recovered_without_the_recorded_ones(convs, model):
    rows = ch.chat(convs).collect()
    assert len(rows) == convs.count()
    right = [r.role == r.given_role for r in rows if r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.93
    hidden = {(r.conv_id, r.turn): r.role for r in ch.chat(convs.drop("role"), model).collect()}
    assert all(hidden[r.conv_id, r.turn] == r.role for r in rows)  # the query does not see them either
    assert np.mean([r.role == r.given_role for r in ch.chat(convs, use_roles=True).collect()]) > 0.99


def transcripts(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append(((r.turn, r.part), r))
    return {c: "".join(r.rendered for _, r in sorted(p, key=lambda x: x[0])) for c, p in by.items()}


def plain(rows, roles):
    out, last = "", None
    for (_, text), role in zip(rows, roles):
        out += ("\n<|end|>\n" if last else "") * (role != last) + (f"<|{role}|>\n" if role != last else "\n") + text
        last = role
    return out + "\n<|end|>\n"


def test_parts_of_a_conversation_join(spark, model, monkeypatch):
    """A hot conversation over many partitions is decoded and rendered as in one piece."""
    rng = np.random.default_rng(4)
    rows = [(1, t, None, " ".join("w" * int(rng.integers(1, 9)) for _ in range(int(rng.integers(1, 60)))) + "?" * int(rng.integers(0, 2))) for t in range(400)]
    rows += [(c, t, None, f"text {c} {t}") for c in (0, 2, 3) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(ch, "ROWS", 10)
    got = ch.chat(df, model).collect()
    for conv in (0, 1, 2, 3):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        seen = [(m, ch.features(t), k > 0) for *_, given, text in own for k, (m, t) in enumerate(ch.segments(text, given))]
        roles = [ch.ROLES[k] for k in ch.viterbi(model, seen, None, None)[0]]
        assert [r.role for r in sorted((r for r in got if r.conv_id == conv), key=lambda r: r.turn)] == roles
        assert transcripts(got)[conv] == plain([(0, r[3]) for r in own], roles)


def test_counts_cover_partition_borders(convs, monkeypatch):
    one = ch.fit(ch.sorted_rows(convs))
    monkeypatch.setattr(ch, "ROWS", 7)
    many = ch.fit(ch.sorted_rows(convs))
    assert np.allclose(one.start, many.start) and np.allclose(one.change, many.change) and np.allclose(one.tables[0], many.tables[0])


def test_odd_rows(spark):
    rows = [(1, 0, "user", None, "x"), (1, 0, "user", None, "x"), (1, 1, "??", "", "x"), (None, None, None, "hi", "x"), (2, 5, "assistant", "a" * 50000, "x"), (2, 5, "assistant", "b", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    got = ch.chat(df).collect()
    assert len(got) == 6 and all(r.role in ch.ROLES for r in got)
    assert [r.role for r in got if r.conv_id == 2] == ["assistant"] * 2
    assert ch.chat(df.where("false")).count() == 0 and ch.chat(df.select("conv_id", "turn", "text")).count() == 6
