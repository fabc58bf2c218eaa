"""Conversation structure repair: the cheapest edits found by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, state of the role pattern ``(s?(ua)+)?``);
edges keep, rerole or delete the next row, or insert an empty turn. Both
searches run until their fronts can no longer meet at the best cost, then every
crossing of that cost is joined and the least audit among them is taken.
"""

from __future__ import annotations

import hashlib
import heapq
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.shared import ready

# Fixed values of the contract: edit costs, letters of the audit and the faults of a row.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ENDS = ".!?"
BLANKS = re.compile(r"[^\x20\x09-\x0D]")
LEGAL_PAIRS = {"su", "ua", "au"}

#: States of the role pattern: start, after s, after u, after a; where a role initial leads.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ACCEPT = (START, AFTER_A)
#: The one role an inserted or rerolled turn can take in each state.
NEXT_ROLE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """Each row's first fault: blank, duplicate, truncated or ''."""
    seen, out = set(), []
    for role, text in rows:
        if not BLANKS.search(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            last = [c for c in text if BLANKS.match(c)][-1]
            out.append("" if last in ENDS else "truncated")
        seen.add((role, text))
    return out


def _forward_edges(rows, kinds, node):
    """(letter, cost, next node) leaving a node."""
    i, q = node
    nxt = STEP.get((q, NEXT_ROLE[q][0]))
    yield "I", INSERT, (i, nxt)
    if i == len(rows):
        return
    yield "D", DELETE, (i + 1, q)
    if kinds[i] in ("blank", "duplicate"):
        return
    extra = TRUNCATED if kinds[i] == "truncated" else 0
    kept = STEP.get((q, rows[i][0][:1]))
    if kept is not None:
        yield "K", KEEP + extra, (i + 1, kept)
    yield "R", REROLE + extra, (i + 1, nxt)


def _backward_edges(rows, kinds, node):
    """(letter, cost, previous node) entering a node."""
    i, q = node
    for p in range(4):
        if STEP.get((p, NEXT_ROLE[p][0])) == q:
            yield "I", INSERT, (i, p)
    if i == 0:
        return
    r = i - 1
    yield "D", DELETE, (r, q)
    if kinds[r] in ("blank", "duplicate"):
        return
    extra = TRUNCATED if kinds[r] == "truncated" else 0
    for p in range(4):
        if STEP.get((p, rows[r][0][:1])) == q:
            yield "K", KEEP + extra, (r, p)
        if STEP.get((p, NEXT_ROLE[p][0])) == q:
            yield "R", REROLE + extra, (r, p)


def cheapest_repair(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of rows (role, text) in order, ties by the ASCII-least audit.

    Forward labels are (cost, least prefix), settled in that order; the reverse
    search settles costs to an accepting node. It stops when the two least keys
    add up to more than the best crossing, so all crossings of equal cost are
    seen; suffixes are then spelled from the reverse costs, nearest first.
    """
    kinds = faults(rows)
    n = len(rows)
    forward, backward = {}, {}
    f_heap = [(0, "", (0, START))]
    b_heap = [(0, (n, q)) for q in ACCEPT]
    heapq.heapify(b_heap)
    best = float("inf")

    def top(heap):
        return heap[0][0] if heap else float("inf")

    while f_heap or b_heap:
        if top(f_heap) + top(b_heap) > best:
            break
        if top(f_heap) <= top(b_heap):
            cost, prefix, node = heapq.heappop(f_heap)
            if node in forward:
                continue
            forward[node] = (cost, prefix)
            if node in backward:
                best = min(best, cost + backward[node])
            for letter, weight, nxt in _forward_edges(rows, kinds, node):
                if nxt not in forward:
                    heapq.heappush(f_heap, (cost + weight, prefix + letter, nxt))
                if nxt in backward:
                    best = min(best, cost + weight + backward[nxt])
        else:
            cost, node = heapq.heappop(b_heap)
            if node in backward:
                continue
            backward[node] = cost
            if node in forward:
                best = min(best, forward[node][0] + cost)
            for _, weight, prev in _backward_edges(rows, kinds, node):
                if prev not in backward:
                    heapq.heappush(b_heap, (cost + weight, prev))
                if prev in forward:
                    best = min(best, forward[prev][0] + weight + cost)
    frontier = top(b_heap)
    # Least suffixes of the nodes whose reverse cost is final and below the front: equal costs, later rows first.
    suffix = {}
    for q in ACCEPT:  # an accepting node needs nothing more, whether the reverse search took it or not
        backward[(n, q)] = 0
    for node in sorted((v for v, c in backward.items() if c < frontier or c == 0 and v[0] == n), key=lambda v: (backward[v], -v[0], v[1])):
        i, q = node
        if i == n and q in ACCEPT and backward[node] == 0:
            suffix[node] = ""
            continue
        choices = [
            letter + suffix[nxt]
            for letter, weight, nxt in _forward_edges(rows, kinds, node)
            if nxt in suffix and weight + backward[nxt] == backward[node]
        ]
        if choices:
            suffix[node] = min(choices)
    crossings = [forward[v][1] + suffix[v] for v in forward if v in suffix and forward[v][0] + backward[v] == best]
    for u, (cost, prefix) in forward.items():
        for letter, weight, v in _forward_edges(rows, kinds, u):
            if v in suffix and cost + weight + backward[v] == best:
                crossings.append(prefix + letter + suffix[v])
    return int(best), min(crossings)


def apply_audit(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired rows (role, text) that an audit spells."""
    out, i, q = [], 0, START
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            role, text = rows[i]
            i += 1
            q = STEP[(q, role[:1])]
        else:
            role, text = NEXT_ROLE[q], rows[i][1] if letter == "R" else ""
            i += letter == "R"
            q = STEP[(q, role[0])]
        out.append((role, text))
    return out


def repair_one(rows: list[tuple[str, str]], turns: list) -> dict:
    """All figures of one conversation's rows (role, text), already in order, with their turns."""
    kinds = faults(rows)
    known = [t for t in turns if t is not None]
    initials = [role[:1] for role, _ in rows]
    cost, audit = cheapest_repair(rows) if rows else (0, "")
    repaired = apply_audit(rows, audit)
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": kinds.count("blank"),
        "duplicate": kinds.count("duplicate"),
        "truncated": kinds.count("truncated"),
        "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
    }


SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _repair_sorted(batches):
    """Conversations from rows sorted by (conversation, turn nulls first, role, text), one pass, any batch cuts."""
    import pyarrow as pa

    schema = pa.schema([("conv_id", pa.int64())] + [(n, pa.int64()) for n in FIELDS[:6]] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    out = {"conv_id": [], **{name: [] for name in FIELDS}}
    empty = object()
    key, rows, turns = empty, [], []

    def finish():
        found = repair_one(rows, turns)
        out["conv_id"].append(key)
        for name in FIELDS:
            out[name].append(found[name])

    for batch in batches:
        columns = batch.to_pydict()
        for conv, turn, role, text, alive in zip(columns["__conv"], columns["__turn"], columns["__role"], columns["__text"], columns["__alive"]):
            if conv != key or key is empty:
                if key is not empty:
                    finish()
                key, rows, turns = conv, [], []
            if alive:
                rows.append((role, text))
                turns.append(turn)
        if len(out["conv_id"]) >= 4096:
            yield pa.RecordBatch.from_pydict(out, schema=schema)
            out = {name: [] for name in out}
    if key is not empty:
        finish()
    yield pa.RecordBatch.from_pydict(out, schema=schema)


def damage(conversations: DataFrame) -> DataFrame:
    """(__conv, __turn, __role, __text, __alive): rows after the contract's damage; a dropped row stays as a dead marker.

    Nulls are one space: in the key ``conv_id:turn`` and as role or text.
    """
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    code = F.crc32(F.encode(key, "UTF-8")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("__conv"),
        F.col("turn").cast("bigint").alias("__turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("__role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("__text"),
        code.alias("__code"),
    )
    text = (
        F.when(F.col("__code") == 1, F.lit(""))
        .when(F.col("__code") == 2, F.regexp_replace("__text", r"[.!?]", ""))
        .otherwise(F.col("__text"))
    )
    role = F.when(F.col("__code") == 4, F.lit("user")).otherwise(F.col("__role"))
    times = F.when(F.col("__code") == 3, 2).otherwise(1)
    return rows.select(
        "__conv", "__turn", role.alias("__role"), text.alias("__text"), (F.col("__code") != 0).alias("__alive"),
        F.explode(F.sequence(F.lit(1), times)).alias("__copy"),
    ).drop("__copy")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conversation.

    Rows are damaged as the contract says, then ordered by turn (nulls first,
    then role and text). Faults, illegal role pairs and gaps are counted on
    those rows; the cheapest edits come from ``cheapest_repair``. A conversation
    whose rows were all dropped gives zeros, an empty audit and the hash of an
    empty text. Null conv_ids form one conversation, returned with a null id;
    repeated rows are separate turns. Other columns are ignored; an empty
    table gives an empty result.

    A conversation lies in one task: its rows are a sequence that the lattice
    needs whole. Rows are dealt by conversation and sorted within each task, and
    one Arrow pass walks the conversations in order.
    """
    ready(conversations.sparkSession)
    rows = damage(conversations).repartition("__conv").sortWithinPartitions(
        F.col("__conv").asc_nulls_first(), F.col("__turn").asc_nulls_first(), "__role", "__text"
    )
    return rows.mapInArrow(_repair_sorted, SCHEMA)


def repair_report(conversations: DataFrame) -> DataFrame:
    return repair_conversations(conversations)
