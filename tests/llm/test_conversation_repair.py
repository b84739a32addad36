"""Conversation repair against a search over all edits."""

import collections
import functools
import hashlib
import random
import re
import zlib

import pytest

from roadpulse.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, cost string, part string, row string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        dark = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not dark else "duplicate" if (role, text) in seen else "" if dark[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit) by recursion over the rows left and where the grammar stands; the roles are only what a pattern needs."""
    told = faults(rows)

    @functools.cache
    def rest(i, state, inserted):
        # state: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn
        found = []
        nexts = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
        if i == len(rows) and state in (0, 3):
            found.append((0, ""))

        def add(cost, edit, i, state, inserted=0):
            if (after := rest(i, state, inserted)) is not None:
                found.append((cost + after[0], edit + after[1]))

        if inserted < 3:
            for role in "ua":
                if role in nexts:
                    add(2, "I", i, nexts[role], inserted + 1)
        if i < len(rows):
            add(3, "D", i + 1, state)
            if told[i] in ("", "truncated"):
                late = told[i] == "truncated"
                if rows[i][0][:1] in nexts:
                    add(late, "K", i + 1, nexts[rows[i][0][:1]])
                for role in "ua":
                    if role in nexts:
                        add(2 + late, "R", i + 1, nexts[role])
        return min(found) if found else None

    for i in range(len(rows), 0, -50):  # from the end, so that no call goes deep
        rest(i, 0, 0)
    return rest(0, 0, 0)


def transcript(rows, audit):
    out, at, wait = [], 0, "u"
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = {"u": "user", "a": "assistant"}[wait]
        out.append(f"{role}:{text}")
        wait = {"s": "u", "u": "a", "a": "u"}[role[0]]
    assert re.fullmatch("(s?(ua)+)?", "".join(t[0] for t in out))
    return "\n".join(out)


def expected(rows):
    told = faults(rows)
    cost, audit = cheapest(rows)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (told.count("blank"), told.count("duplicate"), told.count("truncated"), illegal, cost, audit, hashlib.sha256(transcript(rows, audit).encode()).hexdigest())


def conversations(seed, n, most):
    draw = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(draw.randint(1, most)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "agent"])
            out.append((conv, turn, role, draw.choice(["a.", "b!", "c", "", " \t", "dd?", f"{turn}.", f"{conv} {turn}"])))
    return out


def results(parts):
    return {r.id: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in repair.digests(parts).collect()}


def grouped(rows):
    out = collections.defaultdict(list)
    for conv, _, role, text in rows:
        out[conv].append((role, text))
    return out


@pytest.mark.parametrize("chunk_rows", [512, 7, 2])
def test_against_all_edits(spark, chunk_rows):
    rows = conversations(1, 150, 9)
    got = results(repair.repair(table(spark, rows).repartition(3), chunk_rows=chunk_rows))
    assert got == {conv: expected(own) for conv, own in grouped(rows).items()}


def test_a_conversation_over_many_chunks(spark):
    rows = [(1, t, r, x) for (_, _, r, x), t in zip(conversations(2, 200, 4), range(10_000))] + conversations(3, 1, 3)
    rows += [(9, 5, "user", "the same.")] * 300
    whole = repair.repair(table(spark, rows))
    cut = repair.repair(table(spark, rows), chunk_rows=16)
    assert cut.filter("not whole and id = 9").count() > 10 and cut.filter("size(repaired) > 60").count() == 0
    got = results(cut)
    assert got == results(whole) == {conv: expected(own) for conv, own in grouped(rows).items()}
    assert got[9][4:6] == (2 + 3 * 299, "K" + "D" * 299 + "I")


def test_equal_tops_and_ties():
    # equal costs: the least string wins, over all ways
    assert repair.best(repair.parse("u"))[:2] == (2, "KI") and repair.best(repair.parse("a"))[:2] == (2, "IK")
    assert repair.best(repair.parse(""))[:2] == (0, "") and repair.best(repair.parse("s"))[:2] == (3, "D")
    assert repair.best(repair.parse("uu"))[:2] == (2, "KR") and repair.best(repair.parse("uaSo")) [:2] == cheapest_signs("uaSo")
    assert len(repair.LR.stacks) == 8
    draw = random.Random(6)
    for _ in range(300):
        signs = "".join(draw.choice("suaoSUAOx") for _ in range(draw.randint(0, 8)))
        assert repair.best(repair.parse(signs))[:2] == cheapest_signs(signs), signs


def cheapest_signs(signs):
    rows = []
    for k, sign in enumerate(signs):
        role = {"s": "system", "u": "user", "a": "assistant"}.get(sign.lower(), "other")
        rows.append((role, "" if sign == "x" else f"{k}" if sign.isupper() else f"{k}."))
    return cheapest(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 2, "user", "b."), (None, None, "user", "a."), (1, 3, None, "x."), (1, 3, "user", None), (2, 1, "user", "same."), (2, 1, "user", "same.")]
    got = results(repair.repair(table(spark, rows)))
    assert got[None] == expected([(" ", " "), ("user", "a."), ("user", "b.")])
    assert got[1] == expected([(" ", "x."), ("user", " ")]) and got[2] == expected([("user", "same.")] * 2)
    assert results(repair.repair(table(spark, []))) == {}
    long = [(1, 1, "user", "word " * 400_000 + "."), (1, 2, "assistant", "ok.")]
    assert results(repair.repair(table(spark, long)))[1][4:6] == (0, "KK")
    turns = repair.repair(table(spark, rows)).selectExpr("id", "inline(repaired)").collect()
    assert {(r.id, r.edit, r.role, r.text) for r in turns if r.id == 2} == {(2, "K", "user", "same."), (2, "I", "assistant", "")}


def test_query(spark, tmp_path):
    draw = random.Random(8)
    rows = [(c, t, ("system", "user", "assistant")[min(t, 1 + t % 2)], draw.choice(["Yes. No.", "And?", "Well", "one, two."])) for c in range(80) for t in range(draw.randint(1, 8))]
    rows += [(None, 0, "user", "a."), (500, None, None, None)] + [(600 + k, 1, "user", "x.") for k in range(60)]
    table(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    damaged = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        damaged[conv] += [(turn, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    want = {}
    for conv, own in damaged.items():
        turns = [t for t, *_ in own if t is not None]
        want[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *expected([r[1:] for r in own]))
    assert got == want
    assert any(not own for own in damaged.values()) and any(w[1] for w in want.values()) and any(w[2] for w in want.values())
