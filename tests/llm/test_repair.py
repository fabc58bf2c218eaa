"""Conversation repair: bidirectional search against all edit strings, and the Spark query against plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from promptmill.llm import conversation_repair as cr


def all_edits(rows, inserts=4):
    """(cost, audit) over every edit string with at most ``inserts`` inserts."""
    kinds, n, best = cr.faults(rows), len(rows), []

    def go(i, q, audit, cost, used):
        if best and cost > best[0][0]:
            return
        if i == n and q in cr.ACCEPT:
            best.append((cost, audit))
            best.sort()
            del best[1:]
        if used < inserts:
            go(i, cr.STEP[(q, cr.NEXT_ROLE[q][0])], audit + "I", cost + 5, used + 1)
        if i < n:
            go(i + 1, q, audit + "D", cost + 2, used)
            if kinds[i] in ("blank", "duplicate"):
                return
            extra = 5 if kinds[i] == "truncated" else 0
            kept = cr.STEP.get((q, rows[i][0][:1]))
            if kept is not None:
                go(i + 1, kept, audit + "K", cost + extra, used)
            go(i + 1, cr.STEP[(q, cr.NEXT_ROLE[q][0])], audit + "R", cost + 1 + extra, used)

    go(0, cr.START, "", 0, 0)
    return best[0]


def test_search_equals_all_edit_strings():
    rng = random.Random(5)
    roles = ["system", "user", "assistant", " ", "usr", "x", ""]
    texts = ["", " ", "Hi.", "Hi", "ok!", "dup.", "a?\n", "z", "\t"]
    for _ in range(1500):
        rows = [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(0, 6))]
        assert cr.cheapest_repair(rows) == all_edits(rows), rows


def test_hand_worked():
    # A clean exchange costs nothing; deleting a lone assistant turn (2) beats a user turn before it (5);
    # a late system turn goes; a copy must go and a lone user turn then too (2 + 2 < 2 + 5); an assistant
    # after a system turn is rerolled (1); two deletions (4) beat keeping a truncated turn (5).
    assert cr.cheapest_repair([("user", "Hi."), ("assistant", "Hello.")]) == (0, "KK")
    assert cr.cheapest_repair([("assistant", "Hello.")]) == (2, "D")
    assert cr.cheapest_repair([("user", "Hi."), ("assistant", "Yes."), ("system", "Be nice.")]) == (2, "KKD")
    assert cr.cheapest_repair([("user", "Hi."), ("user", "Hi.")]) == (4, "DD")
    assert cr.cheapest_repair([("system", "Be."), ("assistant", "Hello."), ("assistant", "More.")]) == (1, "KRK")
    assert cr.cheapest_repair([("user", "no end"), ("assistant", "fine."), ("user", "Ok."), ("assistant", "Yes.")]) == (4, "DDKK")
    assert cr.cheapest_repair([]) == (0, "")
    assert cr.apply_audit([("user", "Hi."), ("user", "Hi.")], "KDI") == [("user", "Hi."), ("assistant", "")]


def plain(rows):
    """The query's rows in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub(r"[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if code == 3 else 1)
    out = {}
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1], r[2]))
        pairs = [(r, t) for _, r, t in got]
        turns = [t for t, _, _ in got if t is not None]
        cost, audit = cr.cheapest_repair(pairs) if pairs else (0, "")
        initials = [r[:1] for r, _ in pairs]
        kinds = cr.faults(pairs)
        fixed = "\n".join(f"{r}:{t}" for r, t in cr.apply_audit(pairs, audit))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
            kinds.count("truncated"), sum(a + b not in cr.LEGAL_PAIRS for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256(fixed.encode()).hexdigest(),
        )
    return out


def test_query_against_plain_python(spark):
    rng = random.Random(9)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 7)):
            role = ["system", "user", "assistant"][min(turn, 1 + turn % 2)] if rng.random() > 0.1 else None
            text = rng.choice(["Hello there.", "What is it?", "ok", "  ", None, "Great!", "Sure thing."])
            rows.append((conv, turn if rng.random() > 0.05 else None, role, text))
    rows += [(None, 1, "user", "x."), (None, None, None, None), (5, 2, "user", "Again."), (5, 2, "user", "Again.")]
    rows += [(conv, 0, "user", "only one.") for conv in range(1000, 1040)]  # some of these are all dropped
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, `__conv` int, audit string")
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair_report(df).collect()}
    assert got == plain(rows)
    assert any(v[6] == "" for v in got.values())


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_report(df).count() == 0


@pytest.mark.parametrize("size", [2000])
def test_long_conversation(size):
    rows = [("user" if i % 2 == 0 else "assistant", f"turn {i % 50}.") for i in range(size)]
    cost, audit = cr.cheapest_repair(rows)
    assert len(audit) >= size and cost >= 0
