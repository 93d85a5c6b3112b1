"""Removal of passages that repeat anywhere in the table, by content-defined fingerprints of words.

Every stretch of ``min_words`` words holds a fingerprint: of the rolling hashes over three fifths as many
words that lie in it, the smallest is chosen (winnowing).  The choice depends on the stretch alone, so two places of
one passage choose the same, whatever stands around them and whether lines or sentences end in it.  The first
occurrence of a fingerprint (smallest id, then place) is its keeper.  A fingerprint also carries a byte of
each stretch of ``min_words`` words around it: where that differs from the keeper's, the first occurrence
of the fingerprint with this stretch is a keeper too, so that each repeated stretch is compared with
its own first holder, whatever part of it an earlier document has.  A keeper's words go once to each
document that shares fingerprints with it; there the two are compared word by word, byte by byte (white
space between words doesn't count) from end to end at the fingerprint's distance.  What is equal for at
least ``min_words`` words is removed from every document but the keeper.

Whole lines of such a run go (a paragraph on one line is cut after its sentences, as a wrapped one
would be); of a line that the run holds in part, the part goes if it has ``PART`` words, since fewer at
a border may be equal by chance.  Text that repeats itself at a distance under ``min_words`` goes where
the run holds ``min_lines`` whole lines.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate
from operator import ne

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import free_names, mix, pieces_of, saved, strings, tidy

MIN_LINES = 2
MIN_WORDS = 50
REQUESTS = 256  # of one keeper in a row, on average
PART = 8  # words of a line that is not removed as a whole
AT_ONCE = 300_000  # words fingerprinted together
CUT = re.compile(r"(?<=\n)|(?<=[.!?] )")
HASHED = 1 << 18  # bytes hashed together; a longer word is hashed by itself
# White space as ``str.split`` has it.
SPACES = [c for c in range(0x3001) if chr(c).isspace()]
SPACE_CODE = np.isin(np.arange(0x3002), SPACES)
SPACE_BYTE = SPACE_CODE[:256] & (np.arange(256) < 128)
WIDE = [chr(c).encode() for c in SPACES if c > 127]
WIDE_2, WIDE_3 = (np.array([int.from_bytes(w, "big") for w in WIDE if len(w) == n]) for n in (2, 3))
WIDE_LEAD = np.isin(np.arange(256), [w[0] for w in WIDE])


def lines_of(text: str | None) -> list[str]:
    """Pieces that join to the text again; blank pieces belong to the one before."""
    out: list[str] = []
    if not text:
        return out
    if "\0" in text:
        pieces = CUT.split(text)
    else:  # the same places, found by plain searches
        for end in ("\n", ". ", "! ", "? "):
            text = text.replace(end, end + "\0")
        pieces = text.split("\0")
    for piece in pieces:
        if out and not piece.strip():
            out[-1] += piece
        elif piece:
            out.append(piece)
    return out


STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 2**64)
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(STEP))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, m, np.uint64)])) for m in (STEP, BACK))


def powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``STEP`` and of its inverse, from 0 to ``size`` at least."""
    return _powers(max(HASHED, 1 << max(0, size - 1).bit_length()))


def word_places(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words in UTF-8 bytes of texts that lie from edge to edge."""
    white = SPACE_BYTE[data]
    lead = np.flatnonzero(WIDE_LEAD[data])
    if len(lead):
        follow = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.int64)
        two = follow[lead] << 8 | follow[lead + 1]
        for at, width in ((lead[np.isin(two, WIDE_2)], 2), (lead[np.isin(two << 8 | follow[lead + 2], WIDE_3)], 3)):
            for k in range(width):
                white[at + k] = True
    border = np.concatenate([[True], white, [True]])  # of the bytes before and after
    border_after = border[2:].copy()
    border_after[edges[edges > 0] - 1] = True
    border_before = border[:-2]
    border_before[edges[edges < len(data)]] = True
    solid = ~white
    return np.flatnonzero(solid & border_before), np.flatnonzero(solid & border_after) + 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bytes of all words, and the number of words of each text."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    edges = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]
    edges -= edges[0]
    begins, ends = word_places(data, edges)
    out = np.empty(len(begins), np.uint64)
    powers, inverse = powers_to(HASHED)
    lo = 0
    while lo < len(begins):
        first = begins[lo]
        hi = int(np.searchsorted(ends, first + HASHED, side="right"))
        if hi == lo:
            out[lo] = xxhash.xxh3_64_intdigest(data[first : ends[lo]].tobytes())
            lo += 1
            continue
        part = data[first : ends[hi - 1]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[part] * inverse[: len(part)])])
        a, b = begins[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = mix((sums[b] - sums[a]) * powers[a])
        lo = hi
    return out, np.diff(np.searchsorted(begins, edges))


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every ``width`` neighbours."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        x = best(x[:-step], x[step:])
        reach += step
    return x


def prints_of(texts: list[np.ndarray], min_words: int = MIN_WORDS) -> tuple[np.ndarray, ...]:
    """(text, first word, hash, period, around) of the fingerprints of several texts' hashed words.

    ``around`` has a byte for each stretch of ``min_words`` words that holds the fingerprint: from 1 on, 0 where a
    stretch would leave the text; the first begins where the fingerprint does, the last ends where it ends.
    Where a hash comes again within ``min_words`` words, only the first of the chain stays, with the distance as its period.
    """
    size = max(1, 3 * min_words // 5)
    window = min_words - size + 1
    sizes = np.array([len(t) for t in texts], np.int64)
    x = np.concatenate([np.zeros(0, np.uint64), *texts])
    if len(x) < min_words:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, np.zeros((0, window), np.uint8)
    powers, inverse = powers_to(len(x))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * inverse[: len(x)])])

    def rolled(width: int) -> np.ndarray:
        return mix((sums[width:] - sums[:-width]) * powers[: len(sums) - width])

    h = rolled(size)
    owner = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    first = np.arange(len(x) - min_words + 1)
    within = owner[first] == owner[first + min_words - 1]
    # A hash is chosen where it is the smallest of a stretch: the largest of the smallest around it.
    least = np.where(within, _sliding(h, window, np.minimum), np.uint64(0))
    margin = np.zeros(window - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([margin, least, margin]), window, np.maximum) == h)
    order = np.argsort(h[at], kind="stable")
    p = at[order]
    t, v = owner[p], h[p]
    near = (t[1:] == t[:-1]) & (v[1:] == v[:-1]) & (p[1:] - p[:-1] < min_words)
    stays = np.concatenate([np.ones(min(1, len(p)), bool), ~near])
    period = np.zeros(len(p), np.int64)
    period[:-1][near] = (p[1:] - p[:-1])[near]
    at, period = p[stays], period[stays]
    t, v = t[stays], v[stays]
    whole = (rolled(min_words) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    stretches = np.concatenate([margin.astype(np.uint8), np.where(within, whole, np.uint8(0)), np.zeros(min_words, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(stretches, window)[at][:, ::-1]
    return t, at - begin[t], v, period, np.ascontiguousarray(around)


PRINT = "k1 bigint, k2 bigint, size int, start int, period int, h bigint, around binary"


def _print_rows(min_words: int):
    def run(batches):
        for batch in (part for whole in batches for part in pieces_of(whole)):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x, counts = word_hashes(batch.column(batch.schema.get_field_index("text")))
            ends = np.cumsum(counts)
            rows = np.flatnonzero(counts >= min_words)
            turns = (np.cumsum(counts[rows]) - 1) // AT_ONCE
            for some in np.split(rows, np.flatnonzero(np.diff(turns)) + 1):
                text_no, start, value, period, around = prints_of([x[ends[r] - counts[r] : ends[r]] for r in some], min_words)
                at = some[text_no]
                places = np.arange(len(at) + 1, dtype=np.int32) * around.shape[1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "k1": k1[at], "k2": k2[at], "size": counts[at].astype(np.int32), "start": start.astype(np.int32),
                        "period": period.astype(np.int32), "h": value.view(np.int64),
                        "around": pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(around)]),
                    }
                )

    return run


SEGMENT = "r1 bigint, r2 bigint, first int, words string, matches array<struct<shift:int>>"
SEGMENT_ARROW = pa.schema(
    [
        ("r1", pa.int64()), ("r2", pa.int64()), ("first", pa.int32()), ("words", pa.string()),
        ("matches", pa.list_(pa.struct([("shift", pa.int32())]))),
    ]
)


def _segments(names: tuple[str, ...]):
    """The keeper's words as far as they can lie beside a document that asks for them."""
    text_at, asks_at, k1, k2 = names

    def run(batches):
        for batch in batches:
            rows, held = [], 0
            keys = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in (k1, k2)]
            for own1, own2, text, asks in zip(*keys, strings(batch, text_at), batch.column(batch.schema.get_field_index(asks_at))):
                words = text.split() if text else []
                for ask in asks:
                    ask = ask.as_py()
                    lo, kept = 0, None
                    if (ask["r1"], ask["r2"]) != (own1, own2):
                        # Not all of a long keeper: no run can leave the document that asks.
                        lo = max(0, min(-m["shift"] for m in ask["matches"]))
                        kept = " ".join(words[lo : max(ask["size"] - m["shift"] for m in ask["matches"])])
                    rows.append({"r1": ask["r1"], "r2": ask["r2"], "first": lo, "words": kept, "matches": ask["matches"]})
                    held += len(kept or "")
                    if len(rows) >= 2000 or held >= 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=SEGMENT_ARROW)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=SEGMENT_ARROW)

    return run


def _equal_runs(mine: list[str], other: list[str], min_words: int) -> list[tuple[int, int]]:
    """Where two lists of words are equal, word beside word, for so many words."""
    if mine == other:
        return [(0, len(mine))]
    edges = np.concatenate([[-1], np.flatnonzero(np.fromiter(map(ne, mine, other), bool, len(mine))), [len(mine)]])
    long = np.flatnonzero(np.diff(edges) > min_words)
    return list(zip((edges[long] + 1).tolist(), edges[long + 1].tolist()))


def removed_words(text: str, segments: list[dict], min_lines: int, min_words: int) -> tuple[list[tuple[int, int]], int, int]:
    """Places of the characters that go, the number of lines, and how many of them lose something.

    A match is a ``shift``, the distance at which words are equal; with ``starts``, only the runs that hold one of those words count.
    """
    lines = lines_of(text)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    border = np.concatenate([[True], SPACE_CODE[np.minimum(code, len(SPACE_CODE) - 1)], [True]])
    froms, tos = np.flatnonzero(border[:-1] & ~border[1:]), np.flatnonzero(~border[:-1] & border[1:])
    line_ends = np.fromiter(accumulate(map(len, lines)), np.int64, len(lines))
    line_begins = np.concatenate([[0], line_ends[:-1]])
    ends = np.searchsorted(froms, line_ends)
    begins = np.concatenate([[0], ends[:-1]])
    words = text.split()
    gone = np.zeros(len(words) + 1, bool)
    for seg in segments:
        own = seg["words"] is None
        kept, first = (words, 0) if own else (seg["words"].split(" "), seg["first"])
        for m in seg["matches"]:
            # Word i lies beside word i - shift of the keeper.
            shift = m["shift"] + first
            lo, hi = max(0, shift), min(len(words), shift + len(kept))
            if hi - lo < min_words:
                continue
            starts = m.get("starts")
            for a, b in _equal_runs(words[lo:hi], kept[lo - shift : hi - shift], min_words):
                a, b = a + lo, b + lo
                if starts is not None and not any(a <= start < b for start in starts):
                    continue
                if not own or shift >= min_words or np.count_nonzero((begins >= a) & (ends <= b)) >= min_lines:
                    gone[a:b] = True
    cuts = []
    before = np.concatenate([[0], np.cumsum(gone)])
    lose = before[ends] - before[begins]
    whole = (lose == ends - begins) & (lose > 0)
    turns = np.flatnonzero(np.diff(np.concatenate([[False], whole, [False]])))
    cuts += zip(line_begins[turns[::2]].tolist(), line_ends[turns[1::2] - 1].tolist())
    lost = int(np.count_nonzero(whole))
    for line in np.flatnonzero((lose > 0) & ~whole):
        begin, end = int(begins[line]), int(ends[line])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[begin:end], [False]])))
        parts = [(begin + a, begin + b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= PART]
        cuts += [(int(froms[a]), int(froms[b] if b < end else tos[b - 1])) for a, b in parts]
        lost += bool(parts)
    return sorted(cuts), len(lines), lost


def _rewrite(text_at: str, segments_at: str, added: tuple[str, str], min_lines: int, min_words: int):
    def run(batches):
        for batch in (part for whole in batches for part in pieces_of(whole, text_at, rows=500)):
            texts, counts, gone_counts = [], [], []
            for text, segs in zip(strings(batch, text_at), batch.column(batch.schema.get_field_index(segments_at))):
                cuts, lines, gone = removed_words(text, segs.as_py(), min_lines, min_words) if segs.is_valid else ([], len(lines_of(text)), 0)
                at, parts = 0, []
                for a, b in cuts:
                    parts.append(text[at:a])
                    at = b
                texts.append("".join([*parts, text[at:]]) if cuts else text)
                counts.append(lines)
                gone_counts.append(gone)
            kept = [c for c in batch.schema.names if c != segments_at]
            columns = [pa.array(texts, pa.string()) if c == text_at else batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int32()), pa.array(gone_counts, pa.int32())], names=[*kept, *added])

    return run


def _hits(shared: DataFrame) -> DataFrame:
    """Occurrences of shared fingerprints, each with every ``keeper`` that it is compared with."""
    place = F.struct("k1", "k2", "start")
    first = shared.groupBy("h").agg(F.min(F.struct("k1", "k2", "start", "around")).alias("keeper"))
    met = shared.join(first, "h")
    by_print = met.filter(place != F.struct("keeper.k1", "keeper.k2", "keeper.start"))
    # Stretches that the first occurrence doesn't have.
    other = by_print.filter(F.col("around") != F.col("keeper.around")).withColumn("turn", F.explode(F.sequence(F.lit(1), F.length("around"))))
    mark, kept = F.substring("around", F.col("turn"), F.lit(1)), F.substring("keeper.around", F.col("turn"), F.lit(1))
    other = other.filter((mark != kept) & (mark != F.lit(b"\0"))).select("h", "turn", mark.alias("mark"), "k1", "k2", "size", "start")
    holders = other.groupBy("h", "turn", "mark").agg(F.min(place).alias("keeper"), F.count("*").alias("many")).filter("many > 1").drop("many")
    by_stretch = other.join(holders, ["h", "turn", "mark"]).filter(place != F.col("keeper"))
    columns = ["k1", "k2", "size", "start"]
    plain = by_print.select(*columns, F.struct("keeper.k1", "keeper.k2", "keeper.start").alias("keeper"))
    return plain.unionAll(by_stretch.select(*columns, "keeper"))


def dedup_lines(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with repeated passages cut from ``text``, plus ``n_lines`` and ``n_removed`` (lines that lose something).

    Needs ``doc_id`` and ``text``; all columns are kept (an added name that is taken gets an
    underscore).  A null text or one under ``min_words`` words stays as it is; rows of equal id and equal text count as
    one document and are treated alike; null ids come first.  An empty table gives no rows.
    """
    f1, f2, asks, segs, n_lines, n_removed = free_names(documents.columns, "key_id", "key_text", "asks", "segments", "n_lines", "n_removed")
    keyed = documents.withColumns(
        {f1: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))), f2: F.xxhash64(F.col("text"))}
    )
    rows = keyed.select(F.col(f1).alias("k1"), F.col(f2).alias("k2"), F.col("text").cast("string").alias("text"))
    prints = saved(rows.mapInArrow(tidy(_print_rows(min_words)), PRINT), "prints")
    again = prints.groupBy("h").agg(F.count("*").alias("many")).filter("many > 1").select("h")
    shared = saved(prints.join(again, "h"), "shared")
    hits = _hits(shared).select(
        F.col("keeper.k1").alias(f1), F.col("keeper.k2").alias(f2), F.col("k1").alias("r1"), F.col("k2").alias("r2"), "size", (F.col("start") - F.col("keeper.start")).alias("shift")
    )
    inside = prints.filter("period > 0").select(
        F.col("k1").alias(f1), F.col("k2").alias(f2), F.col("k1").alias("r1"), F.col("k2").alias("r2"), "size", F.col("period").alias("shift")
    )
    # Dealt by the pair of documents: the diagonals and the pairs need one shuffle.
    diagonals = hits.unionAll(inside).repartition(f1, f2, "r1", "r2").distinct()
    pairs = saved(diagonals.groupBy(f1, f2, "r1", "r2", "size").agg(F.collect_list(F.struct("shift")).alias("matches")), "pairs")
    # The text of a keeper is read once for some requests together; one that very many documents ask
    # for has as many rows as it needs.
    many = pairs.groupBy(f1, f2).agg(F.ceil(F.count("*") / REQUESTS).alias("rows"))
    spread = pairs.join(many, [f1, f2]).withColumn("row", F.pmod(F.xxhash64("r1", "r2"), F.col("rows")))
    asked = spread.groupBy(f1, f2, "row").agg(F.collect_list(F.struct("r1", "r2", "size", "matches")).alias(asks)).drop("row")
    # Both joins move the same rows by the same key: Spark shuffles the texts once.
    found = keyed.join(asked, [f1, f2]).mapInArrow(tidy(_segments(("text", asks, f1, f2))), SEGMENT)
    own = found.groupBy(F.col("r1").alias(f1), F.col("r2").alias(f2)).agg(
        F.collect_set(F.struct("matches", "first", "words")).alias(segs)
    )
    joined = keyed.join(own, [f1, f2], "left").select(*documents.columns, segs)
    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in documents.schema)
    return joined.mapInArrow(tidy(_rewrite("text", segs, (n_lines, n_removed), min_lines, min_words)), f"{schema}, {n_lines} int, {n_removed} int")
