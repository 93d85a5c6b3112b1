import hashlib
import heapq
import random
import re
import zlib

import pytest

from opslog.llm import conversations as cv
from tests.conftest import rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(faults, entry=cv.START, exits=cv.ENDS):
    """Dijkstra over (cost, letters): the least of the cheapest."""
    heap, done = [(0, "", 0, entry)], set()
    while heap:
        cost, letters, i, q = heapq.heappop(heap)
        if i == len(faults) and q in exits:
            return cost, letters
        if (i, q) in done:
            continue
        done.add((i, q))
        for (state, initial), to in cv.NEXT.items():
            if state == q and initial in "ua":
                heapq.heappush(heap, (cost + 5, letters + "I", i, to))
        if i == len(faults):
            continue
        c = faults[i]
        heapq.heappush(heap, (cost + 2, letters + "D", i + 1, q))
        if c == "-":
            continue
        extra = 5 * c.isupper()
        for (state, initial), to in cv.NEXT.items():
            if state == q:
                if initial == c.lower():
                    heapq.heappush(heap, (cost + extra, letters + "K", i + 1, to))
                if initial in "ua":
                    heapq.heappush(heap, (cost + extra + 1, letters + "R", i + 1, to))


def plain(table, damage=True):
    """The contract row by row."""
    convs = {}
    for conv, turn, role, text in table:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20 if damage else 9
        here = convs.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        here += [] if fault == 0 else [(turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in found if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen, count = "", set(), dict.fromkeys("bdt", 0)
        for _, role, text in found:
            bare = text.strip(" \t\n\x0b\x0c\r")
            c = role[:1] if role[:1] in tuple("sua") else "x"
            kind = "b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
            if kind:
                count[kind] += 1
            faults += "-" if kind in ("b", "d") else c.upper() if kind else c
        initials = [r[1][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(faults)
        lines, i, n = [], 0, sum(c != "D" for c in audit)
        for c in audit:
            if c != "D":
                k = len(lines) - n % 2
                role = found[i][1] if c == "K" else ("user", "assistant")[k % 2]
                lines.append(f"{role}:{'' if c == 'I' else found[i][2]}")
            i += c != "I"
        assert PATTERN.fullmatch("".join(x[0] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, count["b"], count["d"], count["t"], illegal, cost, audit, digest))
    return sorted(out, key=str)


def made(rnd, convs, longest, ids=None):
    table = []
    for conv in ids or range(convs):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["Yes.", "No", "One two!", "\n ", "", None, "Äh?", "end. \t", "x"]) if rnd.random() < 0.6 else f"Row {turn}."
            table.append((conv, rnd.choice([turn, turn, turn + 1, None]) if rnd.random() < 0.2 else turn, role, text))
    return table


@pytest.mark.parametrize("entry", range(4))
def test_search_finds_the_least_of_the_cheapest(entry):
    rnd = random.Random(entry)
    for _ in range(300):
        faults = "".join(rnd.choice("sua-xSUAXuaua") for _ in range(rnd.randint(1, 14)))
        assert cv.search(faults, entry, cv.ENDS) == cheapest(faults, entry)
        for e, x, cost, letters in cv.ways(faults):
            assert (cost, letters) == cheapest(faults, e, (x,))


def test_equals_the_contract(spark):
    table = made(random.Random(1), 150, 9) + made(random.Random(2), 0, 30, [None, 7, -3])
    df = spark.createDataFrame(table, SCHEMA)
    assert rows(cv.repair(cv.damaged(df), df), *COLUMNS) == plain(table)


def test_long_conversations_in_many_segments_are_the_same(spark, monkeypatch):
    rnd = random.Random(4)
    table = made(rnd, 0, 900, [1, 2, 3]) + [(9, None, "user", f"t{i % 50}") for i in range(200)] + made(rnd, 5, 4)
    df = spark.createDataFrame(table, SCHEMA)
    assert rows(cv.repair(df), *COLUMNS) == plain(table, damage=False)
    # Segments and blocks of a few rows: these run in the workers' own copy, so through the functions.
    monkeypatch.setattr(cv, "SEGMENT", 5)
    for _ in range(200):
        faults = "".join(rnd.choice("sua-xSUAXuaua") for _ in range(rnd.randint(6, 40)))
        parts = [faults[i : i + 5] for i in range(0, len(faults), 5)]
        best = {q: (0, None) if q in cv.ENDS else (cv.NEVER, None) for q in cv.FULL}
        for part in reversed(parts):
            found = {q: (cv.NEVER, None) for q in cv.FULL}
            for e, x, cost, letters in cv.ways(part):
                new = (best[x][0] + cost, cv._Rope(letters, best[x][1]))
                if best[x][0] < cv.NEVER and (new[0] < found[e][0] or new[0] == found[e][0] and cv._before(new[1], found[e][1])):
                    found[e] = new
            best = found
        cost, rope = best[cv.START]
        letters = ""
        while rope:
            letters, rope = letters + rope.letters, rope.rest
        assert (cost, letters) == cheapest(faults)


def test_conversations_that_lose_all_rows_and_the_empty_table(spark):
    turn = next(t for t in range(500) if zlib.crc32(f"4:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(4, turn, "user", "Gone.")], SCHEMA)
    none = hashlib.sha256(b"").hexdigest()
    assert rows(cv.repair(cv.damaged(df), df), *COLUMNS) == [(4, 0, 0, 0, 0, 0, 0, "", none)]
    assert cv.repair(df.limit(0), df.limit(0)).count() == 0


def test_repaired_rows_have_the_pattern_and_extra_columns_do_no_harm(spark):
    table = made(random.Random(8), 40, 8)
    df = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 AS block", "2 AS seq", "'m' AS mark", "'x' AS content")
    parts = cv.segments(cv.damaged(df))
    found = {}
    for r in sorted(cv.repaired(parts, cv.plans(parts)).collect(), key=lambda r: (r["conv_id"], r["position"])):
        found.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    want = {r[0]: r[-1] for r in plain(table)}
    for conv, lines in found.items():
        assert PATTERN.fullmatch("".join(x[0] for x in lines))
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want[conv]
