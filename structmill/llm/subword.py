"""Subword-bag text classifier: hashed word and character n-gram vectors, averaged, into a softmax.

The model is trained jointly (vectors and output layer) by stochastic gradient descent in
numpy on a bounded sample of labelled rows.  As the output is linear in the
average, a trained model folds into one number per bucket, and scoring a text is
a mean of table look-ups; so unseen misspellings score through shared n-grams.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.llm import words as W
from structmill.llm.shared import short_batches


@dataclass(frozen=True)
class Params:
    """``rows`` bounds the labelled sample; a small one is gone through more often than ``epochs``, for ``steps`` steps.
    ``min_texts``: sampled texts that must hold a bucket, else it weighs nothing; of fewer than 20 times as many texts, a twentieth."""

    rows: int = 4000
    bits: int = 18
    dim: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    fold: bool = True
    epochs: int = 20
    steps: int = 40_000
    rate: float = 1.5
    out_rate: float = 0.01
    gain: float = 50.0
    most_step: float = 40.0
    min_texts: int = 5
    seed: int = 7


_ODD = np.uint64(0x9E3779B97F4A7C15)


def features(data: np.ndarray, offsets: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and word of each word and n-gram, and document of each word; an n-gram may hold the blank before or after its word."""
    table = W.LOWER if p.fold else np.arange(256, dtype=np.uint8)
    space = W.SPACE[data]
    start, end, doc = W.bounds(data, offsets, ~space)
    shift = np.uint64(64 - p.bits)
    out, owner = [(W.hashes(data, start, end, p.fold) >> shift).astype(np.int32)], [np.arange(len(start))]
    # blanks count as one byte value, and one stands between documents, so that no n-gram crosses
    buf = np.full(len(data) + len(offsets), 32, np.uint8)
    buf[np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) + 1] = np.where(space, 32, table[data])
    blank = buf == 32
    own = blank.astype(np.int32)
    own[1:] += np.cumsum(~blank[1:] & blank[:-1], dtype=np.int32)
    own -= 1
    h = buf.astype(np.uint64)
    broken = np.zeros(len(buf), bool)  # a blank inside
    with np.errstate(over="ignore"):
        for k in range(1, max(p.grams)):
            h = h[:-1] * np.uint64(257) + buf[k:]
            broken = broken[:-1] | blank[k - 1 : -1] if k > 1 else broken[:-1]
            if k + 1 in p.grams:
                keep = np.flatnonzero(~(broken | (blank[: len(h)] & blank[k:])))
                out.append(((h[keep] * _ODD + np.uint64(k)) * _ODD >> shift).astype(np.int32))
                owner.append(own[keep])
    return np.concatenate(out), np.concatenate(owner), doc


def train(texts: Iterable[str], labels: np.ndarray, p: Params) -> np.ndarray:
    """One float per bucket, then bias: the log-odds of label 1 is bias + the mean of a text's entries."""
    rng = np.random.default_rng(p.seed)
    n = len(labels)
    if n == 0 or labels.min() == labels.max():
        rate = (labels.sum() + 1) / (n + 2) if n else 0.5
        return np.append(np.zeros(1 << p.bits), np.log(rate / (1 - rate))).astype(np.float32)
    least = min(p.min_texts, max(1, n // 20))
    seen = np.zeros(1 << p.bits, np.int32)
    # of all texts end to end: pieces of their own would leave the worker's memory in shreds
    every, shares, many = bytearray(), bytearray(), []
    for text in texts:
        ids, counts = _buckets(text, p)
        seen[ids] += 1
        every += ids.astype(np.int32).tobytes()
        shares += (counts / max(counts.sum(), 1)).astype(np.float32).tobytes()
        many.append(len(ids))
    known = (seen >= least)[np.frombuffer(every, np.int32)]
    ends = np.append(0, np.cumsum([np.count_nonzero(k) for k in np.split(known, np.cumsum(many)[:-1])]))
    every = np.frombuffer(every, np.int32)[known]
    shares = np.frombuffer(shares, np.float32)[known]
    docs = [(every[a:b], shares[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    vectors = rng.normal(0, 1e-3, (1 << p.bits, p.dim)).astype(np.float32)
    out = rng.normal(0, 1 / np.sqrt(p.dim), p.dim).astype(np.float32)
    out = np.stack([-out, out])
    bias = np.log([(labels == 0).mean(), (labels == 1).mean()]).astype(np.float32)
    one = np.eye(2, dtype=np.float32)
    epochs = max(p.epochs, p.steps // n)
    for epoch in range(epochs):
        rate = np.float32(p.rate * (1 - epoch / epochs))
        for i in rng.permutation(n):
            ids, share = docs[i]
            mean = (share @ vectors[ids]) * np.float32(p.gain)
            z = out @ mean + bias
            z = np.exp(z - z.max())
            back = z / z.sum() - one[labels[i]]
            # the ids of one text are distinct, so one indexed assignment updates them all
            # a step moves the text's own log-odds by ``most_step`` at most, which short texts would pass and diverge
            turn = rate * np.float32(p.gain**2) * (share @ share) * ((out[1] - out[0]) @ (out[1] - out[0]))
            step = rate * np.float32(p.gain) * min(np.float32(1), np.float32(p.most_step) / max(turn, np.float32(1e-9)))
            vectors[ids] -= np.outer(share * step, back @ out)
            out -= np.float32(p.out_rate) * rate * np.outer(back, mean)
            bias -= np.float32(p.out_rate) * rate * back
    fold = np.where(seen >= least, vectors @ (out[1] - out[0]) * p.gain, 0)
    return np.append(fold, bias[1] - bias[0]).astype(np.float32)


def _buckets(text: str, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text's features, and their counts; a long text is looked at in pieces, cut at blanks."""
    data, offsets = W.buffers(pa.array([text], pa.large_string()))
    counts: np.ndarray | None = None
    a, stop = 0, int(offsets[-1])
    while True:
        b = _at_blank(data, a + W.CHUNK // 2, stop)
        ids, _, _ = features(data[a:b], np.array([0, b - a]), p)
        if a == 0 and b >= stop:
            return np.unique(ids, return_counts=True)
        more = np.bincount(ids, minlength=1 << p.bits)
        counts = more if counts is None else counts + more
        a = b
        if a >= stop:
            ids = np.flatnonzero(counts)
            return ids, counts[ids]


def log_odds(column: pa.Array, model: np.ndarray, p: Params) -> np.ndarray:
    """Of each whole text; a text without words gets the bias."""
    data, offsets = W.buffers(column)
    n = len(offsets) - 1
    total, many = np.zeros(n), np.zeros(n, np.int64)
    weight, room = model[:-1], W.CHUNK // 2
    for lo, hi in W.slices(offsets, room):
        a, stop = int(offsets[lo]), int(offsets[hi])
        while True:  # a longer document goes in pieces, cut at blanks
            b = _at_blank(data, a + room, stop)
            ids, word, doc = features(data[a:b], np.clip(offsets[lo : hi + 1], a, b) - a, p)
            owner = doc[word]
            total[lo:hi] += np.bincount(owner, weight[ids], hi - lo)
            many[lo:hi] += np.bincount(owner, minlength=hi - lo)
            a = b
            if a >= stop:
                break
    return total / np.maximum(many, 1) + model[-1]


def _at_blank(data: np.ndarray, at: int, stop: int) -> int:
    """The first blank from ``at`` on, or ``stop``."""
    while at < stop and not W.SPACE[data[at]]:
        at += 1
    return min(at, stop)


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, p: Params) -> DataFrame:
    """text and y of a bounded sample, the first ``p.rows`` in hash order, of labelled rows outside the held-out fold.

    A doc_id that labels or documents repeat counts once (largest label, least
    text); null labels and ids take no part.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (held_out(modulus, held) == F.lit(False)))
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(rows), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    return texts.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, p: Params) -> np.ndarray:
    """The model, trained in one task on the bounded sample; texts do not come to the driver."""

    def learn(batches):
        texts, y = [], []
        for batch in batches:
            texts.append(batch.column("text"))
            y.append(batch.column("y").to_numpy())
        model = train((t.as_py() for part in texts for t in part), np.concatenate(y) if y else np.zeros(0, np.int64), p)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()])], names=["model"])

    found = short_batches(sample(docs, labels, label, modulus, held, p)).mapInArrow(learn, "model binary").collect()
    return np.frombuffer(found[0]["model"], np.float32) if found else train([], np.zeros(0, np.int64), p)


def held_out(modulus: int, held: int):
    """Whether a row is of the fold that labels are not learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == held, F.lit(False))


def prefixed(docs: DataFrame) -> DataFrame:
    """The columns of docs, renamed but for text, so that none has the name of a result."""
    return docs.toDF(*[c if c == "text" else f"d_{c}" for c in docs.columns])


def classify(docs: DataFrame, model: np.ndarray, p: Params, threshold: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` of docs, then score (0 to 1) and predicted (1 from the threshold up) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            z = log_odds(batch.column("text"), shared.value, p)
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            columns = [batch.column(c) for c in keep] + [pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

    source = short_batches(docs).select(*dict.fromkeys([*keep, "text"]))
    schema = source.select(*keep).schema.add("score", "double").add("predicted", "integer")
    return source.mapInArrow(score, schema)
