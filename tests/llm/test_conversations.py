from __future__ import annotations

import hashlib
import random
import re
import zlib

import corpus
import pytest
from pyspark.sql import functions as F

from basketry.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string"
TEXTS = ["Fine.", "Yes!", "no end", "", " \n", "Really?  ", "...", "x", None]


def talks(seed, count, longest=5):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(0, longest)):
            at = rng.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, at, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None]), rng.choice(TEXTS)))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (None, None, None, None)]
    return rows


def in_order(rows):
    filled = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        kind = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(kind)
    return out


def cheapest(rows, faults):
    """Every script with up to two insertions in a row is tried."""
    best = None

    def go(at, inserted, cost, audit, roles, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if not re.fullmatch("(s?(ua)*u?)?", roles):
            return
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, audit, lines), (cost, audit, lines), key=lambda b: b[:2])
        if inserted < 2:
            for role in ("user", "assistant"):
                go(at, inserted + 1, cost + 5, audit + "I", roles + role[0], [*lines, f"{role}:"])
        if at == len(rows):
            return
        _, role, text = rows[at]
        go(at + 1, 0, cost + 2, audit + "D", roles, lines)
        if faults[at] in ("blank", "duplicate"):
            return
        more = 5 if faults[at] == "truncated" else 0
        if role[:1] in ("s", "u", "a"):
            go(at + 1, 0, cost + more, audit + "K", roles + role[0], [*lines, f"{role}:{text}"])
        for new in ("user", "assistant"):
            go(at + 1, 0, cost + more + 1, audit + "R", roles + new[0], [*lines, f"{new}:{text}"])

    go(0, 0, 0, "", "", [])
    return best


def expected(rows):
    by_conv = {}
    for conv, *row in rows:
        by_conv.setdefault(conv, []).append(tuple(row))
    out = []
    for conv, group in by_conv.items():
        group = in_order([r for r in group if r != ("gone",)])
        faults = faults_of(group)
        turns = [t for t, *_ in group if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:], strict=False))
        cost, audit, lines = cheapest(group, faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batch", [2, 4096])
def test_against_all_scripts(spark, monkeypatch, batch):
    monkeypatch.setattr(c, "BATCH_ROWS", batch)
    rows = talks(1, 150)
    rows += [(900, 0, "user", "Hi."), (900, 0, "user", "Hi."), (900, 0, "assistant", "Yes.")]
    df = corpus.clashing(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert corpus.collected(c.repair_digest(c.repair(df))) == expected(rows)


@pytest.mark.parametrize("costs", [(1, 2, 1, 0), (3, 4, 1, 1), (1, 1, 1, 1), (2, 9, 2, 5)])
def test_other_costs_have_the_same_definition(monkeypatch, costs):
    """With dear deletions insertions pay, and ties of all kinds occur."""
    rerole, delete, insert, truncated = costs
    for name, value in zip(("REROLE_COST", "DELETE_COST", "INSERT_COST", "TRUNCATED_COST"), costs, strict=True):
        monkeypatch.setattr(c, name, value)
    rng = random.Random(sum(costs))
    for _ in range(150):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice([None, None, "blank", "truncated"])) for _ in range(rng.randint(0, 6))]
        search, got = c.Survivors(), ""
        for role, fault in rows:
            search.row(role, "x", fault)
            got += "".join(n.letter for n in search.settled())
        cost, rest = search.finish()
        # By definition: full audits per state, rows and insertions in turn.
        best = {c.EMPTY: (0, "")}
        for role, fault in [*rows, (None, "end")]:
            for _ in range(4):
                for state, (total, audit) in list(best.items()):
                    for initial, after in c.NEXT[state].items():
                        if initial != "s":
                            best[after] = min(best.get(after, (9**9, "")), (total + insert, audit + "I"))
            if fault == "end":
                break
            then = {}
            for state, (total, audit) in best.items():
                options = [(state, total + delete, "D")]
                if fault != "blank":
                    more = truncated if fault else 0
                    for initial, after in c.NEXT[state].items():
                        if role[0] == initial:
                            options.append((after, total + more, "K"))
                        elif initial != "s":
                            options.append((after, total + more + rerole, "R"))
                for after, new, letter in options:
                    then[after] = min(then.get(after, (9**9, "")), (new, audit + letter))
            best = then
        assert (cost, got + "".join(n.letter for n in rest)) == min(best[s] for s in c.COMPLETE if s in best)


def test_open_edits_stay_few_on_a_long_conversation():
    search, settled = c.Survivors(), 0
    longest = 0
    rng = random.Random(5)
    for i in range(20_000):
        role = ["user", "assistant"][i % 2] if rng.random() < 0.9 else "system"
        search.row(role, "x.", rng.choice([None, None, None, "truncated"]))
        settled += sum(1 for _ in search.settled())
        longest = max(longest, max(n.depth for _, n in search.best.values()) - search.root.depth)
    assert settled > 19_900 and longest < 100


def test_damage(spark):
    rows = [(i, t, ["user", "assistant"][t % 2], f"Text {t}. Really? {i}") for i in range(80) for t in range(6)]
    rows += [(None, None, None, None), (3, None, "system", "x.")]
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text, kind == 0)
        want += [row] * (2 if kind == 3 else 1)
    got = c.damaged(spark.createDataFrame(rows, SCHEMA))
    assert corpus.collected(got) == sorted(want, key=repr)
    assert {r[4] for r in want} == {True, False}


def test_conversation_without_rows_is_returned(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA).withColumn("gone", F.lit(True))
    nothing = hashlib.sha256(b"").hexdigest()
    assert corpus.collected(c.repair_digest(c.repair(df))) == [(1, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert c.repair_digest(c.repair(c.damaged(df))).collect() == []


def test_one_exchange(spark):
    df = c.repair_digest(c.repair(c.damaged(spark.createDataFrame(talks(2, 20), SCHEMA))))
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
