"""Repair of conversation structure: the cheapest edits after which roles alternate, by iterative-deepening A*.

Edits of a conversation's rows in order: Keep (0), Rerole to user or assistant (1), Delete (2; the only one
for blank and repeated rows), Insert an empty user or assistant row anywhere (5).  A truncated row that stays
adds 5.  The initials of what remains must read ``(s?(ua)+)?``.  The search is depth first, edits in ASCII
order, under a bound that grows by one: the first path that is accepted is the cheapest and, of those, the
ASCII-least.  A table of states with the budget they failed with keeps it from entering one twice; its
lower bound sums what each remaining row costs at least.

A conversation of any length is cut into segments of at most ``SEGMENT`` rows.  Where it has more than one,
the search runs for each way into a segment and out of it, and segments are joined from the last to the
first by cost, then by letters.  So long conversations are spread over tasks by ranges of turns, and a task
holds one segment; what is left per conversation is its string of edits and one pass of its repaired text.

Null role and text are one space (so blank), a null turn comes first, a null conv_id is a conversation of its
own.  Rows of one turn are taken by role, then text; repeated rows are duplicates.  Very long texts are
held once per segment.  Only conv_id, turn, role and text are read.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import saved

SEGMENT = 64  # rows that are searched at once
TURNS = 256  # turns of a conversation that go to one task
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # fixed: costs
SPACE = r"[\x20\x09-\x0D]"

# States of the pattern: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
WRITTEN = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}  # what Rerole and Insert can put there
ENDS = (START, AFTER_A)
FULL = {START: 0, AFTER_S: 10, AFTER_U: 5, AFTER_A: 0}  # inserts that end a text from a state
NEVER = 1 << 60

# ---- the search -------------------------------------------------------------
# A row is one character: s, u, a, or x for other roles; upper case if truncated; - if it must go.


def _floors(rows: str) -> list[tuple[int, bool]]:
    """Per position: what the rows from there on cost at least, outside the start, and whether a healthy s is among them."""
    out = [(0, False)]
    for c in reversed(rows):
        cost, healthy = out[-1]
        least = 2 if c == "-" or c.isupper() else 0 if c in "ua" else 1
        out.append((cost + least, healthy or c == "s"))
    return out[::-1]


@lru_cache(maxsize=20_000)
def search(rows: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str]:
    """Cost and edits of the first accepted path from a state before ``rows`` to one of ``exits`` after them."""
    floors, n = _floors(rows), len(rows)
    closing = FULL if exits == ENDS else {q: 0 for q in FULL}

    def least(i: int, q: int) -> int:
        cost, healthy = floors[i]
        return max(cost - (q == START and healthy), 0) + (closing[q] if i == n else 0)

    def moves(i: int, q: int) -> list[tuple[str, int, int, int]]:
        out = []
        c = rows[i] if i < n else ""
        if c:
            out.append(("D", i + 1, q, DELETE))
        out.append(("I", i, NEXT[q, WRITTEN[q]], INSERT))
        if c and c != "-":
            extra = TRUNCATED if c.isupper() else 0
            if (q, c.lower()) in NEXT:
                out.append(("K", i + 1, NEXT[q, c.lower()], KEEP + extra))
            out.append(("R", i + 1, NEXT[q, WRITTEN[q]], REROLE + extra))
        return out

    failed: dict[tuple[int, int], int] = {}
    bound = least(0, entry)
    while True:
        stack, letters = [(0, entry, 0, iter(moves(0, entry)))], []
        if n == 0 and entry in exits:
            return 0, ""
        while stack:
            i, q, spent, rest = stack[-1]
            for letter, j, r, cost in rest:
                left = bound - spent - cost
                if left < least(j, r) or failed.get((j, r), -1) >= left:
                    continue
                letters.append(letter)
                if j == n and r in exits:
                    return spent + cost, "".join(letters)
                stack.append((j, r, spent + cost, iter(moves(j, r))))
                break
            else:
                failed[i, q] = max(failed.get((i, q), -1), bound - spent)
                stack.pop()
                if letters:
                    letters.pop()
        bound += 1


def ways(rows: str) -> list[tuple[int, int, int, str]]:
    """Every (entry, exit) of a segment that edits can reach, with cost and edits."""
    out = []
    for entry in FULL:
        for exit in FULL:
            if entry == exit or exit in (AFTER_U, AFTER_A) or (entry == START and exit == AFTER_S and "s" in rows.lower()):
                out.append((entry, exit, *search(rows, entry, (exit,))))
    return out


# ---- rows to segments -------------------------------------------------------


def _filled(df: DataFrame) -> DataFrame:
    """The four columns; a null role or text is one space."""
    return df.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damaged(df: DataFrame) -> DataFrame:
    """The rows of a conversations table after the faults that crc32 of ``conv_id:turn`` deals out.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    rows = _filled(df)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(name.cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(fault == 3, F.lit(2)).otherwise(F.lit(1))
    kept = rows.withColumn("fault", fault).filter("fault != 0")
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def _ranges(rows: DataFrame) -> DataFrame:
    """Rows with ``block``, the range of turns they are dealt by, and marks for what a block can't see.

    Mark rows come before the rows of their block: one says that its conversation has other blocks, others
    name a role and text that an earlier block has.
    """
    rows = _filled(rows).withColumn("block", F.coalesce(F.call_function("div", F.col("turn"), F.lit(TURNS)), F.lit(-NEVER)))
    light = rows.select("conv_id", "block", F.sha2(F.concat_ws(":", "role", "text"), 256).alias("content"), F.length("role").alias("role_size"))
    blocks = light.groupBy("conv_id").agg(F.min("block").alias("first"), F.max("block").alias("last")).filter("first < last").drop("last")
    here = F.expr("conv_id <=> far")
    far = blocks.withColumnRenamed("conv_id", "far")
    wide = light.join(far, here, "left_semi")
    several = wide.select("conv_id", "block").distinct().withColumns({"content": F.lit(""), "mark": F.lit(0)})
    earliest = wide.groupBy("conv_id", "content", "role_size").agg(F.min("block").alias("first"), F.max("block").alias("last")).filter("first < last")
    again = wide.distinct().alias("w").join(
        earliest.alias("e"), F.expr("w.conv_id <=> e.conv_id AND w.content = e.content AND w.role_size = e.role_size AND w.block > e.first")
    )
    repeated = again.select("w.conv_id", "w.block", F.concat_ws(":", "w.role_size", "w.content").alias("content")).withColumn("mark", F.lit(1))
    marks = several.unionByName(repeated).select(
        "conv_id", "block", "mark", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("content").alias("text")
    )
    return rows.withColumn("mark", F.lit(2)).select(*marks.columns).unionByName(marks)


SEGMENTS = """conv_id {id}, block bigint, seq int, alone boolean, n int, turns bigint, low bigint, high bigint, blank bigint,
duplicate bigint, truncated bigint, illegal bigint, first string, last string, fault string, roles array<string>, texts array<string>"""


class _Segment:
    def __init__(self):
        self.faults, self.roles, self.texts, self.turns = [], [], [], set()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)


def _fault(role: str, text: str, seen: bool) -> tuple[str, str | None]:
    """A row's character for the search and its first fault."""
    bare = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
    if not bare:
        return "-", "blank"
    if seen:
        return "-", "duplicate"
    c = role[0] if role[:1] in ("s", "u", "a") else "x"
    return (c, None) if bare[-1] in ".!?" else (c.upper(), "truncated")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Sorted rows of (conv_id, block) to segments; no more than one segment is held."""
    place, part, seq, alone, seen, last_turn, last_initial = None, None, 0, True, set(), None, None

    def closed(more: bool):
        turns = [t for t in part.turns if t is not None]
        return [
            *place, seq, alone and seq == 0 and not more, len(part.roles), len(turns), min(turns, default=None), max(turns, default=None),
            *part.counts.values(), part.roles[0][:1], part.roles[-1][:1], "".join(part.faults), part.roles, part.texts,
        ]

    for batch in batches:
        conv, block, mark, turn, role, text = (batch.column(k) for k in range(6))
        for i in range(batch.num_rows):
            at = (conv[i].as_py(), block[i].as_py())
            if at != place:
                if part is not None and part.roles:
                    yield closed(False)
                place, part, seq, alone, seen, last_turn, last_initial = at, _Segment(), 0, True, set(), None, None
            m, t, r, x = mark[i].as_py(), turn[i].as_py(), role[i].as_py(), text[i].as_py()
            if m == 0:
                alone = False
                continue
            if m == 1:
                seen.add(x)
                continue
            if len(part.roles) >= SEGMENT:
                yield closed(True)
                part, seq = _Segment(), seq + 1
            content = f"{len(r)}:{hashlib.sha256(f'{r}:{x}'.encode()).hexdigest()}"
            c, fault = _fault(r, x, content in seen)
            seen.add(content)
            if fault:
                part.counts[fault] += 1
            if part.roles and last_initial + r[:1] not in ("su", "ua", "au"):
                part.counts["illegal"] += 1  # between segments: when they are joined
            if t != last_turn or not part.roles and seq == 0:
                part.turns.add(t)  # a turn that goes on from the segment before was counted there
            last_turn, last_initial = t, r[:1]
            part.faults.append(c)
            part.roles.append(r)
            part.texts.append(x)
    if part is not None and part.roles:
        yield closed(False)


def _in_batches(rows: Iterator[list], schema: pa.Schema, size=lambda row: 1, limit: int = 2000) -> Iterator[pa.RecordBatch]:
    held, taken = [], 0
    for row in rows:
        held.append(row)
        taken += size(row)
        if taken >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, taken = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def segments(rows: DataFrame) -> DataFrame:
    """The segments of damaged or other rows (conv_id, turn, role, text), with the counts of each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SEGMENTS.format(id=rows.schema["conv_id"].dataType.simpleString()))
    order = ["conv_id", "block", "mark", F.asc_nulls_first("turn"), "role", "text"]
    dealt = _ranges(rows).repartition("conv_id", "block").sortWithinPartitions(*order)

    def run(batches):
        held = to_arrow_schema(schema)
        yield from _in_batches(_segments(batches), held, lambda row: sum(map(len, row[-1])) + 200 * len(row[-1]), 4 << 20)

    return dealt.select("conv_id", "block", "mark", "turn", "role", "text").mapInArrow(run, schema)


# ---- segments to plans ------------------------------------------------------


class _Rope:
    """Edits from a segment to the end: letters of it, then the rest."""

    __slots__ = ("letters", "rest")

    def __init__(self, letters: str, rest: _Rope | None):
        self.letters, self.rest = letters, rest


def _before(a: _Rope, b: _Rope) -> bool:
    """Whether the letters of ``a`` come before those of ``b``; a common rest is not read."""
    x, y = a.letters, b.letters
    a, b = a.rest, b.rest
    while True:
        k = min(len(x), len(y))
        if x[:k] != y[:k]:
            return x[:k] < y[:k]
        x, y = x[k:], y[k:]
        if not x and not y and a is b:
            return False
        if not x:
            if a is None:
                return bool(y) or b is not None
            x, a = a.letters, a.rest
        if not y:
            if b is None:
                return False
            y, b = b.letters, b.rest


PLANS = "conv_id {id}, block bigint, seq int, entry int, letters string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Segments of whole conversations, the last first, to a plan per segment; the first carries the totals."""
    place, best, taken = None, None, []

    def done():
        cost, rope = best[START]
        state = START
        total = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
        low = high = before = None
        rows = []
        while rope is not None and taken:
            row, steps = taken.pop()
            for k in total:
                total[k] += row[k]
            if row["low"] is not None:
                low = row["low"] if low is None else low
                high = row["high"]
            if before is not None and before + row["first"] not in ("su", "ua", "au"):
                total["illegal"] += 1
            before = row["last"]
            rows.append([place[0], row["block"], row["seq"], state, rope.letters])
            state, rope = steps[state], rope.rest
        gaps = 0 if low is None else high - low + 1 - total["turns"]
        audit = "".join(r[4] for r in rows)
        for k, r in enumerate(rows):
            head = [gaps, *(total[c] for c in ("blank", "duplicate", "truncated", "illegal")), cost, audit]
            yield r + (head if k == 0 else [None] * 7)

    for batch in batches:
        for row in batch.to_pylist():
            if place is None or row["conv_id"] != place[0]:
                if place is not None:
                    yield from done()
                place, taken = [row["conv_id"]], []
                best = {q: (0, None) if q in ENDS else (NEVER, None) for q in FULL}
            if row["alone"]:
                cost, letters = search(row["fault"], START, ENDS)
                best = {START: (cost, _Rope(letters, None))}
                taken.append((row, {START: AFTER_A}))
                continue
            found: dict[int, tuple] = {q: (NEVER, None) for q in FULL}
            steps = {}
            for entry, exit, cost, letters in _ways(row["ways"]):
                rest_cost, rest = best[exit]
                if rest_cost >= NEVER:
                    continue
                old_cost, old = found[entry]
                new = _Rope(letters, rest)
                if rest_cost + cost < old_cost or (rest_cost + cost == old_cost and _before(new, old)):
                    found[entry] = (rest_cost + cost, new)
                    steps[entry] = exit
            best = found
            taken.append((row, steps))
    if place is not None:
        yield from done()


def _ways(text: str) -> Iterator[tuple[int, int, int, str]]:
    for part in text.split(";"):
        entry, exit, cost, letters = part.split(",")
        yield int(entry), int(exit), int(cost), letters


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the ways through a segment of a longer conversation."""
    for batch in batches:
        faults, alone = batch.column("fault").to_pylist(), batch.column("alone").to_pylist()
        found = [None if a else ";".join(f"{e},{x},{c},{s}" for e, x, c, s in ways(f)) for f, a in zip(faults, alone)]
        yield batch.append_column("ways", pa.array(found, pa.string()))


def plans(parts: DataFrame) -> DataFrame:
    """Per segment the state before it and its edits; the first of a conversation also has the counts, cost and audit."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    light = parts.drop("roles", "texts", "n")
    searched = light.mapInArrow(_searched, StructType([*light.schema.fields]).add("ways", "string"))
    order = ["conv_id", F.desc("block"), F.desc("seq")]
    schema = StructType.fromDDL(PLANS.format(id=parts.schema["conv_id"].dataType.simpleString()))

    def run(batches):
        yield from _in_batches(_plans(batches), to_arrow_schema(schema))

    return searched.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, schema)


# ---- plans to repaired texts ------------------------------------------------


def repaired_lines(entry: int, letters: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """Roles and texts of a segment after its edits."""
    state, i = entry, 0
    for letter in letters:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            role, text = roles[i], texts[i]
            state = NEXT[state, role[0]]
        else:
            initial = WRITTEN[state]
            role, text = "user" if initial == "u" else "assistant", "" if letter == "I" else texts[i]
            state = NEXT[state, initial]
        i += letter != "I"
        yield role, text


def _with_plans(parts: DataFrame, planned: DataFrame) -> DataFrame:
    """Plan rows and text rows of a conversation in one order: each plan right before its segment."""
    columns = ["conv_id", "block", "seq", "kind", "entry", "letters", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "roles", "texts"]
    none = {c: F.lit(None) for c in columns}
    first = planned.withColumns({"kind": F.lit(0), "roles": none["roles"].cast("array<string>"), "texts": none["texts"].cast("array<string>")})
    second = parts.select("conv_id", "block", "seq", "roles", "texts").withColumn("kind", F.lit(1))
    second = second.withColumns({c: F.lit(None).cast(planned.schema[c].dataType) for c in columns if c not in second.columns})
    both = first.select(*columns).unionByName(second.select(*columns))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "block", "seq", "kind")


def repaired(parts: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position, role and text."""

    def run(batches):
        schema = pa.schema([("conv_id", ID), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

        def lines():
            now, position, plan = NEVER, 0, None
            for row in (r for b in batches for r in b.to_pylist()):
                if row["kind"] == 0:
                    plan = (row["entry"], row["letters"])
                    if row["audit"] is not None:
                        now, position = row["conv_id"], 0
                    continue
                for role, text in repaired_lines(*plan, row["roles"], row["texts"]):
                    yield [now, position, role, text]
                    position += 1

        yield from _in_batches(lines(), schema, lambda row: len(row[3]) + 100, 4 << 20)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = parts.schema["conv_id"].dataType
    ID = to_arrow_type(kind)
    return _with_plans(parts, planned).mapInArrow(run, f"conv_id {kind.simpleString()}, position bigint, role string, text string")


RESULT = "conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def digests(parts: DataFrame, planned: DataFrame) -> DataFrame:
    """Per conversation its counts, cost, edits and the SHA-256 of its repaired text, in one streamed pass."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(RESULT.format(id=parts.schema["conv_id"].dataType.simpleString()))
    names = [f.name for f in schema.fields[:-1]]

    def run(batches):
        def rows():
            head, digest, plan, started = None, None, None, False
            for row in (r for b in batches for r in b.to_pylist()):
                if row["kind"] == 0:
                    if row["audit"] is not None:
                        if head is not None:
                            yield [*head, digest.hexdigest()]
                        head, digest, started = [row[c] for c in names], hashlib.sha256(), False
                    plan = (row["entry"], row["letters"])
                    continue
                for role, text in repaired_lines(*plan, row["roles"], row["texts"]):
                    digest.update(f"\n{role}:{text}".encode() if started else f"{role}:{text}".encode())
                    started = True
            if head is not None:
                yield [*head, digest.hexdigest()]

        yield from _in_batches(rows(), to_arrow_schema(schema))

    return _with_plans(parts, planned).mapInArrow(run, schema)


def repair(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` with counts, cost, audit and digest; of ``every``, if given, also those without rows."""
    parts = saved(segments(rows), "segments")
    out = digests(parts, saved(plans(parts), "plans"))
    if every is None:
        return out
    none = hashlib.sha256(b"").hexdigest()
    ids = every.select(F.col("conv_id").alias("id")).distinct()
    all_ids = ids.join(out, F.expr("id <=> conv_id"), "left").drop("conv_id").withColumnRenamed("id", "conv_id")
    zeros = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return all_ids.withColumns({**zeros, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(none))})
