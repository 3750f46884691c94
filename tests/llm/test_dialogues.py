import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from carestrata.llm import dialogues
from carestrata.llm.queries import llm_queries

FOLDER = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute_repair(rows):
    """The cheapest and then least edit strings from every state, by a plain search from the end."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    far = (10**9, "")
    best = {"": (0, ""), "a": (0, ""), "u": far, "s": far}

    def relax(costs):
        for _ in range(3):
            costs = {s: min(c, (3 + costs[after[s]][0], "I" + costs[after[s]][1])) for s, c in costs.items()}
        return costs

    best = relax(best)
    for (_, _, role, _), fault in zip(reversed(rows), reversed(faults), strict=True):
        now = {}
        for s in best:
            options = [(4 + best[s][0], "D" + best[s][1])]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] == after[s] or (role[:1] == "s" and s == ""):
                    there = best[role[:1]]
                    options.append((more + there[0], "K" + there[1]))
                options.append((3 + more + best[after[s]][0], "R" + best[after[s]][1]))
            now[s] = min(options)
        best = relax(now)
    cost, audit = best[""]
    lines, at, state = [], 0, ""
    for edit in audit:
        if edit == "I":
            state = after[state]
            lines.append({"u": "user", "a": "assistant"}[state] + ":")
            continue
        role, text = rows[at][2:]
        at += 1
        if edit == "K":
            state = role[0]
            lines.append(f"{role}:{text}")
        elif edit == "R":
            state = after[state]
            lines.append({"u": "user", "a": "assistant"}[state] + f":{text}")
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def grouped(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def check(report, rows, ids):
    found = {r["conv_id"]: r.asDict() for r in report.collect()}
    assert set(found) == set(ids)
    by_conv = grouped(rows)
    for conv, got in found.items():
        assert got == {"conv_id": conv, **brute_repair(by_conv.get(conv, []))}, conv


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(llm_queries()["op13_rank_convergence_repair"](spark, FOLDER), brute_damage(rows), {r[0] for r in rows})


def random_rows(seed, convs, most):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why", "", " \t", "So it goes. ", "More\n", "x"]
    rows = []
    for conv in range(convs):
        style = draw.choice(["user", "mixed", "mixed", "fresh"])
        for turn in range(draw.randint(1, most)):
            role = "user" if style == "user" else draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = f"{conv} {turn}{draw.choice('.?x')}" if style in ("user", "fresh") or draw.random() < 0.5 else draw.choice([*texts, None])
            rows.append((conv, draw.choice([turn, turn, turn + 3, None]), role, text))
    return rows


@pytest.mark.parametrize(("seed", "convs", "most", "chunk"), [(1, 60, 12, 12), (2, 12, 150, 3), (3, 40, 30, 1), (4, 3, 500, 2)])
def test_random_rows_equal_brute_force(spark, monkeypatch, seed, convs, most, chunk):
    """Small chunks cut nearly every conversation, so that fix-up passes do the work."""
    monkeypatch.setattr(dialogues.audits, "__defaults__", (chunk,))
    rows = random_rows(seed, convs, most)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    check(dialogues.repair_report(frame), [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows], range(convs))


def test_one_long_conversation_of_user_rows_never_converges_early(spark, monkeypatch):
    """A run of users only keeps the costs apart over all chunks: passes double their reach."""
    monkeypatch.setattr(dialogues.audits, "__defaults__", (2,))
    rows = [(None, i, "user", f"text {i}.") for i in range(300)] + [(7, 0, "user", "a."), (7, 1, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    check(dialogues.repair_report(frame), rows, {None, 7})


def test_messages_left_alternate(spark):
    rows = random_rows(9, 25, 10)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report = {r["conv_id"]: r for r in dialogues.repair_report(frame).collect()}
    left = grouped(sorted(tuple(r) for r in dialogues.repaired(frame).select("conv_id", "place", "edit", "role", "text").collect()))
    for conv, r in report.items():
        lines = [f"{role}:{text}" for *_, role, text in left.get(conv, [])]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == r["repaired_sha256"]
        assert [e for _, _, e, _, _ in left.get(conv, [])] == [e for e in r["audit"] if e != "D"]


def test_awkward_rows(spark):
    """Null ids, turns, roles and texts, equal rows, extreme turns, clashing columns, no rows at all."""
    rows = [
        (None, None, None, None),
        (None, None, None, None),
        (None, 4, "user", "x" * 100_000 + "."),
        (1, -(2**63), "user", "a."),
        (1, 2**63 - 1, "assistant", "b."),
        (2, 1, "user", "same."),
        (2, 1, "user", "same."),
        (2, 1, "user", "same."),
        (2**62 + 1, 0, "system", "only."),
    ]
    wide = [(*r, "k", 5, "z", 1) for r in rows]
    frame = spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, audit string, first int, map string, tie int")
    found = {r["conv_id"]: r for r in dialogues.repair_report(frame).collect()}
    plain = grouped([(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows])
    for conv, r in found.items():
        expected = brute_repair(plain[conv])
        expected["gaps"] = min(expected["gaps"], 2**63 - 1)
        assert r.asDict() == {"conv_id": conv, **expected}
    assert dialogues.repair_report(frame.limit(0)).count() == 0
    none = dialogues.repair_report(frame.limit(0), ids=frame).collect()
    assert {r["conv_id"] for r in none} == {None, 1, 2, 2**62 + 1}
    assert all(r["cost"] == r["gaps"] == 0 and r["audit"] == "" and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in none)
    named = frame.selectExpr("cast(conv_id as string) as conv_id", "turn", "role", "text")
    assert dialogues.repair_report(named).count() == 4


def test_damage_equals_brute_force(spark):
    rows = [(i % 7 if i % 5 else None, i if i % 11 else None, ["user", None, "assistant"][i % 3], [f"Text {i}. Yes!", None, ""][i % 3]) for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in dialogues.damaged(frame).collect()), key=key) == sorted(brute_damage(rows), key=key)
