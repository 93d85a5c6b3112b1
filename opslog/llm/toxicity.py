"""Toxicity by a bidirectional gated recurrent network with attention pooling over word windows.

A word enters as the sum of its own embedding (hashed) and the mean embedding of its character
n-grams.  Two gated recurrent passes read a window of ``WINDOW`` words, attention pools
their states, and a logistic unit scores the window.  Windows overlap by half and cover the whole text; a
document's score is that of its worst window, calibrated on training documents.

Labels are for documents, toxic words for a few places in them: training starts from the windows
that hold words of high log-odds, then alternates with re-choosing each toxic document's windows and each
clean document's hardest window by the network itself.  Training is numpy on at most
``MAX_TOXIC`` + ``MAX_CLEAN`` labelled rows (smallest hash of the id); scoring runs in the tasks.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import held, keep_rows, pieces_of, strings, tidy

WINDOW, STEP = 32, 16
HIDDEN, WIDTH = 8, 12
WORD_ROWS, GRAM_ROWS = 1 << 15, 1 << 14
MAX_TOXIC, MAX_CLEAN = 1000, 2500
WINDOWS_EACH = 4  # training windows of one toxic document, chosen anew each round
THRESHOLD = 0.7
KNOWN_WORDS = 100_000
BATCH, STEPS = 512, 40  # windows a step at most, steps an epoch at least
EDGE = re.compile(r"^\W+|\W+$")


def plain(word: str) -> str:
    return EDGE.sub("", word.lower())


def grams(word: str) -> list[int]:
    """Rows of a word's character n-grams: all of three, and its first four and five."""
    marked = f"^{word}$"
    parts = [marked[i : i + 3] for i in range(max(1, len(marked) - 2))] + [marked[:5], marked[:6]]
    return [xxhash.xxh3_64_intdigest(p.encode("utf-8", "replace"), seed=3) % GRAM_ROWS for p in parts]


def word_row(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"), seed=1) % WORD_ROWS


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """The weights; ``way`` 0 reads forward, 1 backward."""

    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 5) -> Network:
        rnd = np.random.default_rng(seed)

        def init(*shape, scale):
            return rnd.normal(0, scale, shape).astype(np.float32)

        h, d = HIDDEN, WIDTH
        return Network(
            {
                "words": init(WORD_ROWS, d, scale=0.1), "grams": init(GRAM_ROWS, d, scale=0.3),
                "in": init(2, d, 3 * h, scale=0.4), "in_b": np.zeros((2, 1, 3 * h), np.float32),
                "rec": init(2, h, 3 * h, scale=0.3), "att": init(2 * h, h, scale=0.3), "att_v": init(h, scale=0.3),
                "out": init(2 * h, scale=0.3), "out_b": np.zeros(1, np.float32),
            }
        )

    def inputs(self, rows: np.ndarray, gram_rows: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Word vectors; ``gram_rows`` holds ``many[i]`` rows for word ``i``, one after the other."""
        if not len(rows):
            return np.zeros((0, WIDTH), np.float32)
        sums = np.add.reduceat(self.w["grams"][gram_rows], np.cumsum(many) - many, axis=0)
        return self.w["words"][rows] + sums / many[:, None].astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What the gates get from each word: [way, word, 3 h]."""
        return (x @ self.w["in"] + self.w["in_b"]).astype(np.float32)

    def forward(self, gates: np.ndarray, index: np.ndarray, length: np.ndarray, keep: bool = False):
        """Logits of windows: ``index`` [T, B] into ``gates``, the first ``length`` words of each count."""
        (t, b), h = index.shape, HIDDEN
        live = (np.arange(t)[:, None] < length[None, :]).astype(np.float32)
        states = np.zeros((t, b, 2 * h), np.float32)
        tape = []
        for way in (0, 1):
            s, rec = np.zeros((b, h), np.float32), self.w["rec"][way]
            for k in range(t) if way == 0 else range(t - 1, -1, -1):
                g, u = gates[way][index[k]], s @ rec
                zr = g[:, : 2 * h] + u[:, : 2 * h]
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                z, r = zr[:, :h], zr[:, h:]
                n = np.tanh(g[:, 2 * h :] + r * u[:, 2 * h :])
                after = (n + z * (s - n)) * live[k][:, None]
                if keep:
                    tape.append((way, k, s, z, r, n, u[:, 2 * h :]))
                s = after
                states[k, :, way * h : way * h + h] = s
        hid = np.tanh(states @ self.w["att"])
        e = np.where(live > 0, np.exp(np.clip(hid @ self.w["att_v"], -30, 30)), 0)
        a = e / np.maximum(e.sum(0), 1e-9)
        pooled = (a[:, :, None] * states).sum(0)
        logit = pooled @ self.w["out"] + self.w["out_b"][0]
        return (logit, (tape, states, hid, a, pooled, live)) if keep else logit

    def gradients(self, gates, index, length, target, weight):
        """Loss and gradients of the recurrent weights and of the gates' inputs [way, word, 3 h]."""
        h = HIDDEN
        logit, (tape, states, hid, a, pooled, live) = self.forward(gates, index, length, keep=True)
        p = _sigmoid(logit)
        loss = float(-(weight * (target * np.log(p + 1e-7) + (1 - target) * np.log(1 - p + 1e-7))).sum() / weight.sum())
        d = (weight * (p - target) / weight.sum()).astype(np.float32)
        grad = {"out": pooled.T @ d, "out_b": np.array([d.sum()], np.float32)}
        d_pooled = d[:, None] * self.w["out"]
        d_states = a[:, :, None] * d_pooled
        d_a = (states * d_pooled).sum(2)
        d_e = a * (d_a - (a * d_a).sum(0))
        grad["att_v"] = np.tensordot(d_e, hid, ([0, 1], [0, 1]))
        d_hid = d_e[:, :, None] * self.w["att_v"] * (1 - hid * hid)
        grad["att"] = np.tensordot(states, d_hid, ([0, 1], [0, 1]))
        d_states += d_hid @ self.w["att"].T
        grad["rec"] = np.zeros_like(self.w["rec"])
        flow = np.zeros((2, *index.shape, 3 * h), gates.dtype)
        ds = None
        for way, k, s, z, r, n, un in reversed(tape):
            if ds is None or (way == 0 and k == len(index) - 1):
                ds = np.zeros_like(s)
            out = (ds + d_states[k, :, way * h : way * h + h]) * live[k][:, None]
            dn = out * (1 - z) * (1 - n * n)
            dz = out * (s - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            d_u = np.concatenate([dz, dr, dn * r], 1)
            grad["rec"][way] += s.T @ d_u
            ds = out * z + d_u @ self.w["rec"][way].T
            flow[way, k] = np.concatenate([dz, dr, dn], 1)
        d_gates = np.zeros_like(gates)
        for way in (0, 1):
            rows, sums = _sum_rows(index.ravel(), flow[way].reshape(-1, 3 * h))
            d_gates[way, rows] = sums
        return loss, grad, d_gates


class Vocabulary:
    """Distinct words of a task with their place; marks at a word's ends and its case don't count.

    A word that follows itself is read once: repetition is no evidence.
    """

    def __init__(self):
        self.place: dict[str, int] = {}
        self.raw: dict[str, int] = {}
        self.new: list[str] = []

    def add(self, words: list[str]) -> np.ndarray:
        raw = self.raw
        for w in set(words).difference(raw):
            key = plain(w)
            if key not in self.place:
                self.place[key] = len(self.place)
                self.new.append(key)
            raw[w] = self.place[key]
        at = np.fromiter(map(raw.__getitem__, words), np.int32, len(words))
        return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def _rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [grams(w) for w in words]
    many = np.array([len(g) for g in found], np.int64)
    flat = np.concatenate([np.array(g, np.int64) for g in found]) if found else np.zeros(0, np.int64)
    return np.array([word_row(w) for w in words], np.int64), flat, many


def windows(n: int) -> np.ndarray:
    """First words of the windows that cover ``n`` words; each overlaps the next by half."""
    return np.arange(0, max(1, n - STEP), STEP) if n else np.zeros(0, np.int64)


def _cut(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word indices [T, windows], words in the window) of all windows."""
    firsts = [windows(len(d)) for d in docs]
    owner = np.repeat(np.arange(len(docs)), [len(f) for f in firsts])
    text = np.concatenate([*docs, np.zeros(WINDOW, np.int32)])
    ends = np.cumsum([len(d) for d in docs]) if docs else np.zeros(0, int)
    begin = (ends - [len(d) for d in docs])[owner] + np.concatenate(firsts) if len(owner) else np.zeros(0, int)
    length = np.minimum(WINDOW, ends[owner] - begin) if len(owner) else np.zeros(0, int)
    return owner, text[begin[None, :] + np.arange(WINDOW)[:, None]], length


class Model:
    """A trained network with its calibration; scores batches of texts."""

    def __init__(self, net: Network, slope: float = 1.0, shift: float = 0.0, key: str | None = None):
        self.net, self.slope, self.shift, self.key = net, slope, shift, key or uuid.uuid4().hex
        self._forget()

    def _forget(self) -> None:
        self.words = Vocabulary()
        self.gates = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def __reduce__(self):
        return _restored, (self.key, self.net, self.slope, self.shift)

    def _learn(self) -> None:
        """Gates of the words that are new since the last call."""
        if self.words.new:
            fresh, size = self.net.project(self.net.inputs(*_rows(self.words.new))), len(self.words.place)
            if size > self.gates.shape[1]:
                wider = np.zeros((2, 2 * size, 3 * HIDDEN), np.float32)
                wider[:, : self.gates.shape[1]] = self.gates
                self.gates = wider
            self.gates[:, size - fresh.shape[1] : size] = fresh
            self.words.new = []

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """Worst window of each text; minus infinity without words."""
        if len(self.words.place) > KNOWN_WORDS or len(self.words.raw) > 4 * KNOWN_WORDS:
            self._forget()
        docs = [self.words.add(t.split() if t else []) for t in texts]
        self._learn()
        owner, index, length = _cut(docs)
        worst = np.full(len(texts), -np.inf, np.float32)
        for lo in range(0, len(owner), 4096):
            part = self.net.forward(self.gates, index[:, lo : lo + 4096], length[lo : lo + 4096])
            np.maximum.at(worst, owner[lo : lo + 4096], part)
        return worst

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = self.logits(texts).astype(np.float64)
        return np.where(np.isfinite(x), _sigmoid(self.slope * np.where(np.isfinite(x), x, 0) + self.shift), 0.0)


def _restored(key: str, *parts) -> Model:
    """The worker process's copy: the words it has met are kept from task to task."""
    return held(("model", key), lambda: Model(*parts, key=key))


class _Adagrad:
    def __init__(self, rate: float):
        self.rate, self.seen = rate, {}

    def step(self, name: str, weight: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        seen = self.seen.setdefault(name, np.full_like(weight, 1e-6))
        at = slice(None) if rows is None else rows
        seen[at] += grad * grad
        weight[at] -= self.rate * grad / np.sqrt(seen[at])


def _sum_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    distinct, first = np.unique(rows[order], return_index=True)
    return distinct, np.add.reduceat(values[order], first, axis=0)


def _epoch(net: Network, opt: _Adagrad, rows, index, length, target, rnd) -> float:
    words, flat, many = rows
    at = np.cumsum(many) - many
    total, order = 0.0, rnd.permutation(len(target))
    share = max(1e-3, float(target.mean()))
    size = min(BATCH, max(32, len(order) // STEPS))
    for lo in range(0, len(order), size):
        pick = order[lo : lo + size]
        used, local = np.unique(index[:, pick], return_inverse=True)
        local = local.reshape(WINDOW, len(pick))
        counts = many[used]
        some = np.repeat(at[used] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        x = net.inputs(words[used], flat[some], many[used])
        t = target[pick].astype(np.float32)
        weight = np.where(t > 0, 0.5 / share, 0.5 / max(1e-3, 1 - share)).astype(np.float32)
        loss, grad, d_gates = net.gradients(net.project(x), local, length[pick], t, weight)
        total += loss * len(pick)
        grad["in"] = np.einsum("nd,wng->wdg", x, d_gates)
        grad["in_b"] = d_gates.sum(1, keepdims=True)
        dx = np.einsum("wng,wdg->nd", d_gates, net.w["in"])
        for name, g in grad.items():
            opt.step(name, net.w[name], g)
        opt.step("words", net.w["words"], (s := _sum_rows(words[used], dx))[1], s[0])
        spread = np.repeat(dx / many[used][:, None].astype(np.float32), many[used], axis=0)
        opt.step("grams", net.w["grams"], (s := _sum_rows(flat[some], spread))[1], s[0])
    return total / len(order)


def _log_odds(docs: list[np.ndarray], toxic: np.ndarray, size: int) -> np.ndarray:
    """How much likelier a word is in toxic documents; 0 for rare words."""
    pos, neg = np.zeros(size), np.zeros(size)
    for d, y in zip(docs, toxic):
        (pos if y else neg)[np.unique(d)] += 1
    odds = np.log((pos + 0.3) / (toxic.sum() + 1)) - np.log((neg + 0.3) / ((1 - toxic).sum() + 1))
    return np.where(pos >= 2, odds, 0)


def _calibrate(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic fit of the label on the worst window's logit, rows weighted to the toxic ``share``."""
    mean, spread = float(x.mean()), float(x.std()) or 1.0
    u = np.stack([(x - mean) / spread, np.ones(len(x))], 1)
    weight = np.where(y > 0, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
    beta, ridge = np.array([1.0, 0.0]), np.diag([1e-2, 1e-4]) * len(y) / 100
    for _ in range(30):
        p = _sigmoid(u @ beta)
        grad = u.T @ (weight * (p - y)) + ridge @ beta
        beta = beta - np.linalg.solve((u * (weight * p * (1 - p) + 1e-6)[:, None]).T @ u + ridge, grad).clip(-2, 2)
    a = max(0.05, beta[0])
    return a / spread, float(beta[1]) - a * mean / spread


def train(
    texts: list[str | None], labels: list[int], share: float | None = None, rounds: int = 4, epochs: int = 2, seed: int = 11
) -> Model | None:
    """A model from labelled texts; None where a class is missing.

    Every fifth text is kept for the calibration, to the toxic ``share`` of all labelled rows.
    """
    toxic = np.array(labels, np.float64)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    rnd, net = np.random.default_rng(seed), Network.fresh()
    model, opt = Model(net), _Adagrad(0.05)
    docs = [model.words.add(t.split() if t else []) for t in texts]
    vocabulary = list(model.words.place)
    rows = _rows(vocabulary)
    owner, index, length = _cut(docs)
    spare = np.arange(len(docs)) % 5 == 4
    if min(toxic[spare].sum(), (1 - toxic)[spare].sum()) < 5:
        spare[:] = False
    fit = ~spare[owner]
    is_toxic = (toxic[owner] > 0) & fit
    clean = np.flatnonzero((toxic[owner] == 0) & fit)
    best = _log_odds([d for d, k in zip(docs, spare) if not k], toxic[~spare], len(vocabulary))[index].max(0)

    def top(values: np.ndarray, mine: np.ndarray, beyond: float) -> np.ndarray:
        """Windows ``mine`` above a value, and the best one of every document."""
        order = mine[np.lexsort((-values[mine], owner[mine]))]
        first = np.concatenate([[True], owner[order][1:] != owner[order][:-1]]) if len(order) else np.zeros(0, bool)
        return order[first | (values[order] > beyond)]

    positive = top(best, np.flatnonzero(is_toxic), 2.5)
    hard = np.zeros(0, int)
    for turn in range(rounds):
        mixed = positive[rnd.permutation(len(positive))]
        mixed = mixed[np.argsort(owner[mixed], kind="stable")]
        _, first, many = np.unique(owner[mixed], return_index=True, return_counts=True)
        seeds = mixed[np.arange(len(mixed)) - np.repeat(first, many) < WINDOWS_EACH]
        some = rnd.choice(clean, min(len(clean), max(2000, 2 * len(seeds))), replace=False)
        pick = np.concatenate([seeds, some, hard])
        target = np.concatenate([np.ones(len(seeds)), np.zeros(len(some) + len(hard))])
        for _ in range(max(epochs, min(6, 20_000 // len(pick)))):
            _epoch(net, opt, rows, index[:, pick], length[pick], target, rnd)
        gates = net.project(net.inputs(*rows))
        value = np.concatenate([net.forward(gates, index[:, k : k + 4096], length[k : k + 4096]) for k in range(0, len(owner), 4096)])
        hard = top(value, clean, -0.5)
        positive = top(value, np.flatnonzero(is_toxic), 1.0)
    worst = np.full(len(docs), -np.inf)
    np.maximum.at(worst, owner, value)
    # With few spare toxic rows their logits are too uneven a base: then all rows calibrate.
    real = np.isfinite(worst) & (spare if toxic[spare].sum() >= 30 else True)
    return Model(net, *_calibrate(worst[real], toxic[real], share if share is not None else float(toxic.mean())))


def held_out(doc_id):
    """Whether a row is kept from training: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(documents: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN):
    """Texts and labels of the training rows (at most so many of each label), and the toxic share of all."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [known.filter(F.col("toxic") == y).orderBy(*order).limit(n) for y, n in ((1, max_toxic), (0, max_clean))]
    counted = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    ids = F.broadcast(chosen[0].unionAll(chosen[1]))  # at most max_toxic + max_clean rows
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.join(ids, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: r["doc_id"])
    share = counted.get(1, 0) / max(1, sum(counted.values()))
    return [r["text"] for r in rows], [r["toxic"] for r in rows], share


def _score(model: Model | None):
    def run(batches):
        for batch in (part for whole in batches for part in pieces_of(whole, rows=500)):
            texts = list(strings(batch, "text"))
            score = model.scores(texts) if model else np.zeros(len(texts))
            kept = [c for c in batch.schema.names if c != "text"]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*kept, "score"])

    return run


def score(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    Null and blank texts score 0, as does everything without a model (labels of one kind only).
    Null ids, repeated rows and an empty table are kept as they are; other columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = docs.mapInArrow(tidy(_score(model), holds=True), "doc_id bigint, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` without the rows that the model rejects; no row moves."""
    return keep_rows(documents, lambda: lambda texts: model.scores(texts) < threshold) if model else documents
