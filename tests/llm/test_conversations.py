from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from docweir.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, part string, numbers string"
WHITE = " \t\n\v\f\r"
NOTHING = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}


def plain(rows):
    """A best-first search over (cost, labels) with the roles written so far held against the pattern itself."""
    if not rows:
        return NOTHING
    kinds, seen = [], set()
    for _, role, text in rows:
        shown = text.strip(WHITE)
        kinds.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    out = {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
    }
    full, begun, done = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?"), set()
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, labels, at, roles, lines = heapq.heappop(heap)
        if (at, roles[-1:]) in done:
            continue
        done.add((at, roles[-1:]))
        if at == len(rows) and full.fullmatch(roles):
            return out | {"cost": cost, "audit": labels, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
        moves = [("I", 5, 0, name, "") for name in ("user", "assistant")]
        if at < len(rows):
            _, role, text = rows[at]
            moves.append(("D", 2, 1, None, ""))
            if kinds[at] not in ("blank", "duplicate"):
                extra = 5 * (kinds[at] == "truncated")
                moves += [("K", extra, 1, role, text), *(("R", 1 + extra, 1, name, text) for name in ("user", "assistant"))]
        for label, price, step, role, text in moves:
            written = roles + (role[:1] if role else "")
            if role is None:
                heapq.heappush(heap, (cost + price, labels + label, at + step, roles, lines))
            elif role and begun.fullmatch(written):
                heapq.heappush(heap, (cost + price, labels + label, at + step, written, (*lines, f"{role}:{text}")))
    raise AssertionError


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def compared(report, wanted):
    found = {r.conv_id: {k: r[k] for k in NOTHING} for r in report.collect()}
    assert found == wanted


def damaged(data):
    out = defaultdict(list)
    for conv, turn, role, text in data:
        rows = out[conv]
        show = lambda v: " " if v is None else str(v)
        role, text = show(role), show(text)
        fault = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        if fault:
            rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def test_the_query_equals_a_search_of_each_conversation(spark, small):
    data = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compared(conversations.op13_conversation_repair(spark, small), {c: plain(in_order(rows)) for c, rows in damaged(data).items()})


def dealt(seed, conversations_of, longest):
    rng = random.Random(seed)
    texts = ["Well.", "So?", "cut off", "", " \t", "Again!", "One. ", "two\n", "."]
    roles = ["user", "assistant", "system", "tool", " ", "", "u"]
    return {c: [(t, rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choice(texts) + (str(t) + "." if rng.random() < 0.5 else "")) for t in sorted(rng.choices(range(3 * longest), k=rng.randint(1, longest)))] for c in range(conversations_of)}


@pytest.mark.parametrize("piece_rows, longest", [(512, 12), (3, 12), (1, 6), (7, 90)])
def test_pieces_change_nothing(spark, monkeypatch, piece_rows, longest):
    monkeypatch.setattr(conversations, "PIECE_ROWS", piece_rows)
    data = dealt(piece_rows, 40, longest)
    order = {c: sorted(rows, key=lambda r: (r[0], r[1])) for c, rows in data.items()}
    unique = {c: [r for i, r in enumerate(rows) if i == 0 or r[:2] != rows[i - 1][:2]] for c, rows in order.items()}  # no ties but in role
    table = spark.createDataFrame([(c, *r, "a", "b", "c") for c, rows in unique.items() for r in rows], SCHEMA)
    found = conversations.repair(table)
    compared(found.report, {c: plain(rows) for c, rows in unique.items()})
    again = defaultdict(list)
    for r in found.turns.orderBy("conv_id", "piece", "place").collect():
        again[r.conv_id].append(f"{r.role}:{r.text}")
    digests = {r.conv_id: r.repaired_sha256 for r in found.report.collect()}
    assert digests == {c: hashlib.sha256("\n".join(again[c]).encode()).hexdigest() for c in unique}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines)) for lines in again.values())


def test_ties_take_the_least_labels():
    row = conversations.Row
    find = lambda *rows: conversations.shortest([conversations.matrix(list(rows))])
    assert find(row("u", False, False)) == (2, [(0, "D")])
    assert find(row("u", False, False), row("u", False, False)) == (1, [(0, "KR")])
    assert find(row("a", False, False), row("u", False, False)) == (2, [(0, "RR")])
    assert find(row("s", False, False)) == (2, [(0, "D")])
    assert find(row("u", True, False), row("a", True, False)) == (4, [(0, "DD")])
    assert find(row("s", False, False), *[row("u", False, False), row("a", False, False)] * 2) == (0, [(0, "KKKKK")])
    assert conversations.shortest([]) == (0, [])


def test_products_are_the_same_in_any_grouping():
    rng = random.Random(8)
    kinds = [conversations.Row(i, f, t) for i in "sua?" for f in (False, True) for t in (False, True)]
    for _ in range(60):
        rows = rng.choices(kinds, k=rng.randint(1, 12))
        cut = sorted(rng.sample(range(len(rows) + 1), rng.randint(0, min(3, len(rows)))))
        parts = [rows[a:b] for a, b in zip([0, *cut], [*cut, len(rows)]) if a < b]
        cost, found = conversations.shortest([conversations.matrix(p) for p in parts])
        assert (cost, "".join(labels for _, labels in found)) == (lambda one: (one[0], one[1][0][1]))(conversations.shortest([conversations.matrix(rows)]))


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_ROWS", 5)
    long = "x" * 3_000_000 + "."
    data = {
        None: [(None, "user", "No number."), (0, "assistant", "An id is missing.")], 1: [(None, " ", " "), (None, "user", " ")],
        2: [(t, "user", "Same.") for t in range(30)], 3: [(7, "user", "Same turn, same text.")] * 40, 4: [(0, "user", long), (9, "assistant", long)],
        5: [(t, "ua"[t % 2] == "u" and "user" or "assistant", f"Turn {t}.") for t in range(41)],
    }
    raw = [(c, t, None if r == " " else r, None if x == " " else x, "a", "b", "c") for c, rows in data.items() for t, r, x in rows]
    compared(conversations.repair(spark.createDataFrame(raw, SCHEMA).repartition(6)).report, {c: plain(in_order(rows)) for c, rows in data.items()})
    none = conversations.repair(spark.createDataFrame([], SCHEMA))
    assert none.report.count() == 0 and none.turns.count() == 0


def test_a_conversation_that_loses_every_row_has_zeros(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hello."), (None, None, None, None)], "conv_id long, turn long, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    wanted = {c: plain(in_order(rows)) for c, rows in damaged([(gone, 0, "user", "Hello."), (None, None, None, None)]).items()}
    assert wanted[gone] == NOTHING
    compared(conversations.op13_conversation_repair(spark, f"file://{tmp_path}"), wanted)
