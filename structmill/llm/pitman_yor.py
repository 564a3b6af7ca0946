"""Language-model scores by a hierarchical Pitman-Yor model with Gibbs-sampled seating.

Each context restaurant (the hash bucket of the word before) draws its words from
one parent, the root restaurant, whose customers are the tables of its children;
the root draws from the uniform over the training vocabulary and one unknown.

Tokens are shuffled once, by word, so a task holds all contexts of its words and
their root restaurants.  A sweep draws the table count of each (context, word)
from its full conditional, by generalised Stirling numbers up to ``EXACT``
customers, and by their limit for many customers beyond (means within 2 % as long
as a pair's tables are not many more than its customers to the power of the
discount, which a test holds; up to a third too many far beyond).  A draw depends on
its word and context alone, not on the task that makes it.  What other tasks
hold enters by the totals of tables per context as of the last exchange.  A
task repeats earlier sweeps from their seeds, so no seating is stored.  Scores
average the predictive probabilities of the samples at the exchanges, where all
totals are exact and each context's probabilities sum to 1.

A word that is a large share of all tokens is split over tasks by context; its
root restaurant is kept with the totals.  What comes to the driver is of fixed
size: totals by context bucket, and at most ``4 * tasks`` split words.

Defined cases: null and empty texts are one end token; null ids are learnt from;
repeated rows are counted and scored each; without training tokens every token
is the unknown with probability 1.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.llm import words as W
from structmill.llm.shared import saved, short_batches

CONTEXT_BITS = 16
SLICE_BYTES = 2 << 20
EXACT = 512
#: Weights of tables held at once.
SEATED = 1 << 16
#: Bytes of text whose tokens are one part: what a task holds at once.
PART_BYTES = 4 << 20
#: Documents whose sums a scoring task holds at once.
SUMMED = 1 << 20
STRENGTH, ROOT_STRENGTH, ROOT_DISCOUNT = 2.0, 10.0, 0.7
#: Sweeps before each exchange of totals; a sample of the seating is taken at each exchange.
SWEEPS = (3, 1)
MODULUS, HELD = 7, 2
#: Documents of a slice; the 16th bit of a token's document marks held-out ones.
_DOCS_AT_MOST = 1 << 15
_END = np.uint64(0x452821E638D01377)
_START = np.uint64(0x13198A2E03707344)


def tokens(column: pa.Array):
    """(first document, last + 1, word, context bucket and document of each token) by slices; each text ends with the end token."""
    data, offsets = W.buffers(column)
    for lo, hi in W.slices(offsets, SLICE_BYTES):
        for lo, hi in ((a, min(a + _DOCS_AT_MOST, hi)) for a in range(lo, hi, _DOCS_AT_MOST)):
            part = data[offsets[lo] : offsets[hi]]
            start, end, doc = W.bounds(part, offsets[lo : hi + 1] - offsets[lo])
            h = W.hashes(part, start, end, True)
            n = hi - lo
            at = np.cumsum(np.bincount(doc, minlength=n))
            word = np.insert(h, at, _END)
            owner = np.insert(doc, at, np.arange(n))
            before = np.append(_START, word[:-1])
            before[np.append(True, owner[1:] != owner[:-1])] = _START
            yield lo, hi, word, (W.mix(before, 600) >> np.uint64(64 - CONTEXT_BITS)).astype(np.uint16), owner


def _common(batches, share):
    for batch in batches:
        for _, _, word, _, _ in tokens(batch.column("text")):
            w, n = np.unique(word, return_counts=True)
            keep = n >= share * len(word)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(w[keep], np.uint64(0)).view(np.int64)), pa.array(np.append(n[keep], len(word)))], names=["word", "n"])


def _pack(arrays) -> bytes:
    """Arrays end to end, after their lengths and types."""
    head = np.array([x for a in arrays for x in (len(a), a.itemsize)], np.int64)
    return head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(blob, kinds):
    head = np.frombuffer(blob, np.int64, 2 * len(kinds))
    out, at = [], head.nbytes
    for n, size, kind in zip(head[::2], head[1::2], kinds):
        out.append(np.frombuffer(blob, kind, n, at))
        at += int(n * size)
    return out


_SENT = (np.uint64, np.uint32, np.uint16, np.uint16, np.int32)


def _send(batches, parts, split):
    """part, bid, blob: the tokens of a slice of documents by task, and of each slice its documents (kind 1)."""
    k = 0
    for batch in batches:
        ids, held = batch.column("doc_id"), batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, word, context, doc in tokens(batch.column("text")):
            bid = TaskContext.get().partitionId() << 32 | k
            k += 1
            hot = np.isin(word, split)
            part = np.where(hot, W.mix(word + context, 601), W.mix(word, 602)) % np.uint64(parts)
            marked = (doc | held[lo + doc].astype(np.int64) << 15).astype(np.uint16)
            order = np.lexsort((doc, context, word, part))
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = []
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[p] : cuts[p + 1]]
                w = word[at]
                first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
                rows.append((p, _pack([w[first], np.diff(np.append(first, len(w))).astype(np.uint32), context[at], marked[at], np.array([hi - lo], np.int32)])))
            n = len(rows)
            counts = np.bincount(doc, minlength=hi - lo).astype(np.uint32)
            some = ids.slice(lo, hi - lo)
            null = some.is_null().to_numpy(zero_copy_only=False)
            meta = _pack([some.fill_null(0).cast(pa.int64()).to_numpy(), null.astype(np.uint8), held[lo:hi].astype(np.uint8), counts])
            columns = [[p for p, _ in rows] + [k % parts], [bid] * (n + 1), [0] * n + [1], [b for _, b in rows] + [meta]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.binary()))], names=["part", "bid", "kind", "blob"])


_DOCS = (np.int64, np.uint8, np.uint8, np.uint32)
_PART = (np.uint64, np.uint32, np.uint16, np.uint32, np.uint16, np.int64, np.int32)


def _merge(batches):
    """One row per part, its tokens sorted by word and context (kind 0), besides the documents' rows (kind 1); rows come sorted by part."""
    part, sent = None, []
    for batch in batches:
        other = [i for i, x in enumerate(batch.column("kind").to_pylist()) if x]
        if other:
            yield batch.take(pa.array(other))
        for r in batch.to_pylist():
            if not r["kind"]:
                if sent and r["part"] != part:
                    yield _part(part, sent)
                    sent = []
                part = r["part"]
                sent.append((r["bid"], r["blob"]))
    if sent:
        yield _part(part, sent)


def _part(part: int, sent: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """The row of one part, from what the slices have sent."""
    sent.sort()
    bids = np.array([b for b, _ in sent], np.int64)
    words, counts, contexts, docs, many = zip(*(_unpack(b, _SENT) for _, b in sent))
    distinct, index = np.unique(np.concatenate(words), return_inverse=True)
    token = np.repeat(index.astype(np.uint32), np.concatenate(counts))
    del words, counts, index
    source = np.repeat(np.arange(len(bids), dtype=np.uint32), [len(c) for c in contexts])
    contexts, docs = np.concatenate(contexts), np.concatenate(docs)
    sizes = np.bincount(token, minlength=len(distinct)).astype(np.uint32)
    key = token.astype(np.uint64) << np.uint64(16) | contexts
    del token
    order = np.argsort(key, kind="stable").astype(np.uint32)
    del key
    blob = _pack([distinct, sizes, contexts[order], source[order], docs[order], bids, np.concatenate(many)])
    del order, source, contexts, docs
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([0], pa.int64()), pa.array([0], pa.int32()), pa.array([blob])], names=["part", "bid", "kind", "blob"])


class Part:
    """The restaurants of one task: distinct (word, context) pairs, their training counts, and all tokens."""

    def __init__(self, blob, split: np.ndarray):
        self.words, sizes, context, self.source, doc, self.bids, self.docs = _unpack(blob, _PART)
        word = np.repeat(np.arange(len(self.words), dtype=np.int32), sizes)
        new = np.append(True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])) if len(word) else np.zeros(0, bool)
        self.pair = np.cumsum(new, dtype=np.int32) - 1
        self.word, self.context = word[new], context[new].astype(np.int64)
        learnt, self.doc = doc < 1 << 15, doc & np.uint16((1 << 15) - 1)
        self.count = np.bincount(self.pair[learnt], minlength=len(self.word))
        self.total = np.bincount(self.word, self.count, len(self.words)).astype(np.int64)
        self.split = np.searchsorted(split, self.words).clip(max=max(len(split) - 1, 0)) if len(split) else np.zeros(len(self.words), int)
        self.is_split = split[self.split] == self.words if len(split) else np.zeros(len(self.words), bool)
        self.seen = np.flatnonzero(self.count)
        #: Each pair's own draws, wherever it is held.
        self.draws = W.mix(self.words[self.word] ^ W.mix(self.context.astype(np.uint64), 603), 604)

    def sample(self, stage: int, totals: list[dict]):
        """Table counts of the seen pairs and of the words' root restaurants after stages 0 .. ``stage``; stage 0 is one table a pair."""
        count, word, context = self.count[self.seen], self.word[self.seen], self.context[self.seen]
        tables = np.ones(len(self.seen), np.int64)
        root = np.minimum(1, np.bincount(word, minlength=len(self.words)))
        yield tables, root
        for s in range(stage):
            g = totals[s]
            others = g["tables"][context] - tables
            for sweep in range(SWEEPS[s]):
                customers = np.bincount(word, tables, len(self.words))
                p = root_probability(customers, root, g)
                p[self.is_split] = g["split_p"][self.split[self.is_split]]
                tables = seat(count, np.log(p[word]), STRENGTH, g["discount"], others, self.draws[self.seen] ^ W.mix(np.full(1, sweep), 700 + s))
                customers = np.bincount(word, tables, len(self.words)).astype(np.int64)
                own = np.flatnonzero(customers)
                root = np.zeros(len(self.words), np.int64)
                root[own] = seat(customers[own], np.full(len(own), -np.log(g["V"] + 1)), ROOT_STRENGTH, ROOT_DISCOUNT, np.full(len(own), float(g["root_tables"])), self.words[own] ^ W.mix(np.full(1, sweep), 800 + s))
            yield tables, root


def root_probability(customers, tables, g):
    back = (ROOT_STRENGTH + ROOT_DISCOUNT * g["root_tables"]) / (g["V"] + 1)
    return (np.maximum(customers - ROOT_DISCOUNT * tables, 0) + back) / (ROOT_STRENGTH + g["root_customers"])


@lru_cache(4)
def log_stirling(d: float, n: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t)."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0
    for c in range(n):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], np.log(np.maximum(c - t * d, 0)) + out[c, 1 : c + 2])
    return out


def seat(count, log_p, strength, d, others, keys) -> np.ndarray:
    """Table counts drawn for dishes of ``count`` customers and parent probability exp(log_p), with ``others`` tables beside theirs; each draw depends on its 64-bit key alone."""
    tables = np.ones(len(count), np.int64)
    order = np.argsort(count, kind="stable")
    ends = np.searchsorted(count[order], np.arange(EXACT + 2))
    table = log_stirling(d, EXACT)
    keys = W.mix(keys, 605)
    uniform = (keys >> np.uint64(11)) * 2.0**-53
    for c in range(2, EXACT + 1):
        t = np.arange(1, c + 1)
        for lo in range(ends[c], ends[c + 1], SEATED // c):
            at = order[lo : min(lo + SEATED // c, ends[c + 1])]
            weight = np.cumsum(np.log(strength + d * (others[at, None] + t - 1)), axis=1) + t * log_p[at, None] + table[c, 1 : c + 1]
            weight = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), axis=1)
            tables[at] = 1 + (weight < uniform[at, None] * weight[:, -1:]).sum(1).clip(max=c - 1)
    at = order[ends[EXACT + 1] :]
    # the limit of these weights for many customers: all tables but one are negative binomial
    p = np.exp(log_p[at]).clip(max=1 - 1e-9)
    draws = [np.random.default_rng(k).negative_binomial(n, q) for k, n, q in zip(keys[at].tolist(), strength / d + others[at] + 1, 1 - p)]
    tables[at] = np.minimum(1 + np.array(draws, np.int64), count[at])
    return tables


def _totals(batches, stage, shared):
    """Of all parts of a task: tables and customers by context, and sums; as (slice, blob)."""
    split, totals = shared.value
    size = 1 << CONTEXT_BITS
    sums = None
    for batch in batches:
        for i in range(batch.num_rows):
            part = Part(batch.column("blob")[i].as_buffer(), split)
            for tables, root in part.sample(stage, totals):
                pass
            seen = part.seen
            by_context = np.bincount(part.context[seen], tables, size)
            customers = np.bincount(part.context[seen], part.count[seen], size)
            word_tables = np.bincount(part.word[seen], tables, len(part.words))
            mine = ~part.is_split
            one = np.zeros(6)
            one[:] = word_tables.sum(), root[mine].sum(), (part.total[mine] > 0).sum(), part.count.sum(), (part.count == 1).sum(), (part.count == 2).sum()
            hot = [np.bincount(part.split[part.is_split], x[part.is_split], len(split)) for x in (part.total, word_tables)]
            mine = np.concatenate([by_context, customers, one, *hot, np.zeros(-(6 + 2 * len(split)) % 4096)])
            sums = mine if sums is None else sums + mine
            del part
    for k, x in enumerate(np.split(sums, len(sums) // 4096) if sums is not None else []):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()])], names=["slice", "sums"])


def _add(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column("slice").to_pylist(), batch.column("sums")):
            x = np.frombuffer(x.as_buffer())
            sums[k] = sums[k] + x if k in sums else x
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()])], names=["slice", "sums"])


def _exchange(parts: DataFrame, stage: int, split, shared, before: dict | None) -> dict:
    rows = parts.mapInArrow(partial(_totals, stage=stage, shared=shared), "slice int, sums binary").repartition("slice").mapInArrow(_add, "slice int, sums binary").collect()
    flat = np.concatenate([np.frombuffer(r["sums"]) for r in sorted(rows, key=lambda r: r["slice"])]) if rows else np.zeros((2 << CONTEXT_BITS) + 6 + 2 * len(split))
    size = 1 << CONTEXT_BITS
    g = {"tables": flat[:size], "customers": flat[size : 2 * size]}
    g["root_customers"], g["root_tables"], V, g["N"], ones, twos = flat[2 * size : 2 * size + 6]
    g["split_count"], hot = flat[2 * size + 6 :][: len(split)], flat[2 * size + 6 + len(split) :][: len(split)].astype(np.int64)
    g["V"] = V + np.count_nonzero(g["split_count"])
    g["discount"] = before["discount"] if before else float(np.clip(ones / max(1, ones + 2 * twos), 0.1, 0.95))
    root = np.minimum(hot, 1)
    if before and len(split):
        own = hot > 0
        root[own] = seat(hot[own], np.full(own.sum(), -np.log(g["V"] + 1)), ROOT_STRENGTH, ROOT_DISCOUNT, np.full(own.sum(), g["root_tables"]), split[own] ^ W.mix(np.zeros(1), 800 + stage))
    g["root_tables"] += root.sum()
    g["split_p"] = root_probability(hot, root, g)
    return g


def _scores(batches, shared):
    """bid, blob: of each slice of documents, the sums that the tokens of this task's parts add."""
    split, totals = shared.value
    sums: dict[int, list] = {}
    room = 0
    for batch in batches:
        for row in range(batch.num_rows):
            part = Part(batch.column("blob")[row].as_buffer(), split)
            mean = np.zeros(len(part.word))
            for s, (tables, root) in enumerate(part.sample(len(SWEEPS), totals[:-1])):
                if s:
                    g = totals[s]
                    customers = np.bincount(part.word[part.seen], tables, len(part.words))
                    p0 = root_probability(customers, root, g)
                    p0[part.is_split] = g["split_p"][part.split[part.is_split]]
                    there = STRENGTH + g["customers"][part.context]
                    own = part.count.astype(float)
                    own[part.seen] -= g["discount"] * tables
                    mean += (own + (STRENGTH + g["discount"] * g["tables"][part.context]) * p0[part.word]) / there
            total = part.total.astype(float)
            total[part.is_split] = totals[-1]["split_count"][part.split[part.is_split]]
            score = np.log10(mean / len(SWEEPS))
            base, known = np.log10(total + 1)[part.word], (total > 0)[part.word]
            order = np.argsort(part.source, kind="stable")
            cuts = np.searchsorted(part.source[order], np.arange(len(part.bids) + 1))
            for i, (bid, n) in enumerate(zip(part.bids.tolist(), part.docs.tolist())):
                at = order[cuts[i] : cuts[i + 1]]
                doc, pair = part.doc[at], part.pair[at]
                mine = [np.bincount(doc, x[pair], n) for x in (known, base, score)]
                room += 0 if bid in sums else n
                sums[bid] = [a + b for a, b in zip(sums[bid], mine)] if bid in sums else mine
            del part
            if room > SUMMED:
                yield _summed(sums)
                sums, room = {}, 0
    if sums:
        yield _summed(sums)


def _summed(sums: dict[int, list]) -> pa.RecordBatch:
    """bid, blob: of each slice, the documents with tokens and their sums."""
    blobs = []
    for known, base, score in sums.values():
        at = np.flatnonzero(score)
        blobs.append(_pack([at.astype(np.uint16), known[at].astype(np.uint32), base[at], score[at], np.array([len(score)], np.int32)]))
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(blobs, pa.binary())], names=["bid", "blob"])


_SUMS = (np.uint16, np.uint32, np.float64, np.float64, np.int32)


def _finish(batches, N, V):
    """doc_id and sums of the documents of each slice; rows come sorted by slice."""
    meta, sums, at = None, None, None

    def result():
        ids, null, held, n = _unpack(meta, _DOCS)
        known, base, score = sums if sums else (np.zeros(len(ids)),) * 3
        columns = [pa.array(ids, mask=null.astype(bool)), pa.array(held.astype(bool)), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base - n * np.log10(N + V + 1)), pa.array(score.astype(float))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    for batch in batches:
        for r in batch.to_pylist():
            if r["bid"] != at:
                if meta is not None:
                    yield result()
                meta, sums, at = None, None, r["bid"]
            if r["kind"]:
                meta = r["blob"]
            else:
                there, *x, n = _unpack(r["blob"], _SUMS)
                sums = sums or [np.zeros(n[0]) for _ in x]
                for a, b in zip(sums, x):
                    a[there] += b
    if meta is not None:
        yield result()


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-size // PART_BYTES))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % MODULUS == HELD, F.lit(False))
    rows = short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"))
    common = rows.select("text").mapInArrow(partial(_common, share=1 / (8 * tasks)), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    common = saved(common, "common")
    total = common.where("word = 0").agg(F.sum("n")).first()[0] or 0
    split = np.sort(np.array([r["word"] for r in common.where((F.col("word") != 0) & (F.col("n") >= total / (4 * tasks))).collect()], np.int64).view(np.uint64))
    sent = rows.mapInArrow(partial(_send, parts=tasks, split=split), "part int, bid long, kind int, blob binary")
    stored = saved(sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_merge, "part int, bid long, kind int, blob binary"), "tokens")
    parts, meta = stored.where("kind = 0").select("part", "blob"), stored.where("kind = 1")
    totals: list[dict] = []
    sc = spark.sparkContext
    for stage in range(len(SWEEPS) + 1):
        shared = sc.broadcast((split, totals))
        totals = [*totals, _exchange(parts, stage, split, shared, totals[-1] if totals else None)]
    shared = sc.broadcast((split, totals))
    # few scoring tasks, as each sends a row of sums for each slice of documents
    sums = parts.coalesce(max(1, tasks // 8)).mapInArrow(partial(_scores, shared=shared), "bid long, blob binary").withColumn("kind", F.lit(0))
    last = totals[-1]
    both = sums.unionByName(meta.select("bid", "blob", "kind")).repartition(-(-tasks * 3 // 8), "bid").sortWithinPartitions("bid")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return both.mapInArrow(partial(_finish, N=last["N"], V=last["V"]), schema).withColumn("train_tokens", F.lit(int(last["N"])).cast("long"))


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, tokens, perplexity of the model and of the base, over all documents."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))


def op1_pitman_yor(docs: DataFrame) -> DataFrame:
    """The scores of all texts, and each text's perplexity; cases as above (a text has one token at least)."""
    return score_texts(docs).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
