"""Removal of word sequences that occur earlier in the corpus, found by recompression.

Each round names maximal runs of equal symbols and then pairs (left symbol, right
symbol), sides drawn from the name by a hash.  Names are hashes of what they
stand for, so they are global without a table of names.  Each symbol carries the
range of words that its making looked at; equal ranges make equal symbols, so a
window of words that holds the range of a high-level symbol holds that symbol in
every occurrence.  Windows go to the task of the longest symbol that they hold
(key), in runs, with a 64-bit hash of the whole window each; tasks compare (key,
hash) and flag all but the first occurrence.  Windows that hold no symbol go by
another hash of their own.  A first pass counts the windows of each symbol; those
of a symbol with a large share of all windows go by symbol and window hash, so no
symbol is one task's work.

Windows under one symbol are told apart by the 64 bits alone, as they share the
key; of n of them about n^2 / 2^65 pairs match falsely.  Before the shuffle each slice of
documents flags its own repeats and sends the first only, so a passage that a
third of all documents share arrives once a slice.

Defined cases: null texts have no words; null doc_id counts as the largest id;
rows of one doc_id are one document (a window of one row repeats another's only
at a later start); texts of fewer words than a window keep all.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from structmill.llm import words as W
from structmill.llm.shared import saved, short_batches

WIDTH = 20
ROUNDS = 2
LONGEST = 8
#: Flags (8 bytes for 31 windows) up to which their table is broadcast to the last pass; beyond, texts are shuffled.
BROADCAST_CELLS = 4_000_000
#: A symbol's windows are split when they are more than one in so many of a partition's share.
SPLIT = 4
_FAR = np.int64(1) << 40
_SCHEMA = "key long, doc_id long, tid long, start int, subs binary, mask int"


def symbols(h: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS, longest: int = LONGEST) -> tuple[np.ndarray, ...]:
    """Name, first word, words, and range looked at (lo, hi) of the symbols that stand for the words ``h`` after the rounds."""
    at = np.arange(len(h))
    name, start, size, lo, hi, own = h, at, np.ones(len(h), np.int64), at, at, doc
    with np.errstate(over="ignore"):
        for r in range(rounds):
            # runs
            same = np.append(False, (name[1:] == name[:-1]) & (own[1:] == own[:-1]))
            first = np.flatnonzero(~same)
            k = np.diff(np.append(first, len(name)))
            lo, hi = _look(lo, hi, own, np.ones(len(name), bool), np.ones(len(name), bool))
            merge = (k > 1) & (k * size[first] <= longest)
            stay = np.repeat((k > 1) & ~merge, k)  # a run too long to be one symbol: it looked at an unknown number of words
            lo, hi = np.where(stay, -_FAR, lo), np.where(stay, _FAR, hi)
            keep = ~same | np.repeat(~merge, k)
            groups = np.flatnonzero(keep)
            count = np.diff(np.append(groups, len(name)))
            name = np.where(count > 1, W.mix(name[groups] + np.uint64(0xA0761D6478BD642F) * count.astype(np.uint64), 100 + r), name[groups])
            lo, hi = np.minimum.reduceat(lo, groups), np.maximum.reduceat(hi, groups)
            start, own, size = start[groups], own[groups], size[groups] * count
            # pairs
            left = (W.mix(name, 200 + r) & np.uint64(1)).astype(bool)
            lo, hi = _look(lo, hi, own, ~left, left)
            pair = np.append(left[:-1] & ~left[1:] & (own[1:] == own[:-1]) & (size[1:] + size[:-1] <= longest), False)
            groups = np.flatnonzero(~np.append(False, pair[:-1]))
            both = pair[groups]
            nxt = np.minimum(groups + 1, len(name) - 1)
            name = np.where(both, W.mix(name[groups] * np.uint64(0xE7037ED1A0B428DB) + name[nxt], 300 + r), name[groups])
            lo, hi = np.minimum.reduceat(lo, groups), np.maximum.reduceat(hi, groups)
            size = np.add.reduceat(size, groups)
            start, own = start[groups], own[groups]
    return name, start, size, lo, hi


def _look(lo, hi, own, leftwards, rightwards):
    """Ranges after each symbol has looked at its neighbours; beyond a document's ends lies the unknown."""
    apart = own[1:] != own[:-1]
    before = np.append(-_FAR, np.where(apart, -_FAR, lo[:-1]))
    after = np.append(np.where(apart, _FAR, hi[1:]), _FAR)
    # a neighbour's own range may reach to the other side
    before_hi = np.append(-_FAR, np.where(apart, -_FAR, hi[:-1]))
    after_lo = np.append(np.where(apart, _FAR, lo[1:]), _FAR)
    new_lo = np.minimum(np.where(leftwards, np.minimum(lo, before), lo), np.where(rightwards, after_lo, _FAR))
    new_hi = np.maximum(np.where(rightwards, np.maximum(hi, after), hi), np.where(leftwards, before_hi, -_FAR))
    return new_lo, new_hi


def anchors(h: np.ndarray, doc: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window within one document: its first word, key, and a hash of all its words that the key has no part in."""
    whole, inside = W.windows(h, doc, width)
    at = np.flatnonzero(inside)
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    name, start, size, lo, hi = symbols(h, doc)
    first = np.searchsorted(start, at)
    best, chosen = np.zeros(len(at), np.int64), np.full(len(at), -1)
    live = np.arange(len(at))
    for t in range(width):
        j = first[live] + t
        ok = j < len(start)
        live, j = live[ok], j[ok]
        ok = start[j] + size[j] <= at[live] + width
        live, j = live[ok], j[ok]
        if not len(live):
            break
        better = (lo[j] >= at[live]) & (hi[j] < at[live] + width) & (size[j] > best[live])
        best[live[better]], chosen[live[better]] = size[j[better]], j[better]
    key = np.where(chosen >= 0, W.mix(name[chosen], 400), W.mix(whole[at], 401))
    return at, key, W.windows(h, doc, width, 1)[0][at]


def _runs(key, row, pos, wanted):
    """First index and length of runs of consecutive wanted windows of one key; at most 31 in a run."""
    at = np.flatnonzero(wanted)
    if not len(at):
        return at, at
    new = np.append(True, (np.diff(at) != 1) | (key[at[1:]] != key[at[:-1]]) | (row[at[1:]] != row[at[:-1]]) | (pos[at[1:]] != pos[at[:-1]] + 1))
    begin = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(new | (since % 31 == 0))
    return at[begin], np.diff(np.append(begin, len(at)))


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(counts * values.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _flag_rows(doc_id, tid, pos, flagged):
    """doc_id, tid, start, mask of flagged windows, 31 starts a row."""
    at = np.flatnonzero(flagged)
    order = at[np.lexsort((pos[at], tid[at], doc_id[at]))]
    cell = pos[order] // 31
    new = np.append(True, (np.diff(cell) != 0) | (np.diff(doc_id[order]) != 0) | (np.diff(tid[order]) != 0)) if len(order) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    bit = np.left_shift(1, pos[order] - cell * 31, dtype=np.int64)
    mask = np.bitwise_or.reduceat(bit, begin) if len(begin) else bit
    return doc_id[order[begin]], tid[order[begin]], (cell[begin] * 31).astype(np.int32), mask.astype(np.int32)


def _busy(batches, share):
    """key, n: symbols with at least that share of a slice's windows, and the slice's windows (key null)."""
    for batch in batches:
        for _, _, h, doc in W.words(batch.column("text"), False):
            _, key, _ = anchors(h, doc)
            names, n = np.unique(key, return_counts=True)
            keep = n >= share * len(key)
            yield pa.RecordBatch.from_arrays([pa.array([None, *names[keep].view(np.int64)], pa.int64()), pa.array([len(key), *n[keep]], pa.int64())], names=["key", "n"])


def busy_symbols(texts: DataFrame, parts: int) -> np.ndarray:
    """Symbols with more than 1 / (SPLIT * parts) of all windows, and some with half of that; at most 2 * SPLIT * parts."""
    share = 1 / (2 * SPLIT * parts)
    # of a symbol's windows, those in slices where its share is lower are less than this share of all windows
    counted = saved(texts.mapInArrow(partial(_busy, share=share), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "busy")
    total = counted.where("key is null").agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("key").isNotNull() & (F.col("n") >= share * total)).collect()
    return np.sort(np.array([r["key"] for r in found], np.int64).view(np.uint64))


def _sends(batches, busy):
    """Windows by key, and the repeats found within a slice of documents."""
    for batch in batches:
        ids, tids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tid"))
        for lo, hi, h, doc in W.words(batch.column("text"), False):
            at, key, sub = anchors(h, doc)
            if not len(at):
                continue
            with np.errstate(over="ignore"):
                key = np.where(np.isin(key, busy), W.mix(key + sub, 402), key)
            begin = np.searchsorted(doc, np.arange(hi - lo))
            row = doc[at]
            pos = (at - begin[row]).astype(np.int64)
            doc_id, tid = ids[lo + row], tids[lo + row]
            with np.errstate(over="ignore"):
                wid = W.mix(key, 5) ^ (sub * np.uint64(0x9E3779B97F4A7C15))
            order = np.lexsort((pos, doc_id, wid))
            again = np.append(False, (wid[order[1:]] == wid[order[:-1]]) & (key[order[1:]] == key[order[:-1]]) & (sub[order[1:]] == sub[order[:-1]]))
            # all but the group's first place
            lead = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))]
            late = np.zeros(len(at), bool)
            late[order] = (doc_id[order] != doc_id[lead]) | (pos[order] != pos[lead])
            a, n = _runs(key, row, pos, ~late)
            subs = sub[~late]
            yield pa.RecordBatch.from_arrays([pa.array(key[a].view(np.int64)), pa.array(doc_id[a]), pa.array(tid[a]), pa.array(pos[a].astype(np.int32)), _binaries(subs, n), pa.array(np.zeros(len(a), np.int32))], names=["key", "doc_id", "tid", "start", "subs", "mask"])
            if late.any():
                d, t, s, m = _flag_rows(doc_id, tid, pos, late)
                empty = _binaries(np.zeros(0, np.uint64), np.zeros(len(d), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(W.mix(d.view(np.uint64), 6).view(np.int64)), pa.array(d), pa.array(t), pa.array(s), empty, pa.array(m)], names=["key", "doc_id", "tid", "start", "subs", "mask"])


def _compares(batches):
    """Flags of all windows but the first of each (key, hash); rows come sorted by key, document and start."""

    def flags(table):
        key, doc_id, tid, start, mask = (table.column(c).to_numpy() for c in ("key", "doc_id", "tid", "start", "mask"))
        data, offsets = W.buffers(table.column("subs"))
        n = np.diff(offsets) // 8
        known = n == 0
        sub = np.frombuffer(data.tobytes(), np.uint64)
        row = np.repeat(np.arange(len(n)), n)
        pos = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        with np.errstate(over="ignore"):
            wid = W.mix(key[row].view(np.uint64), 5) ^ (sub * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(wid, kind="stable")
        again = np.append(False, (wid[order[1:]] == wid[order[:-1]]) & (sub[order[1:]] == sub[order[:-1]]) & (key[row[order[1:]]] == key[row[order[:-1]]]))
        lead = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))] if len(order) else order
        late = np.zeros(len(row), bool)
        late[order] = (doc_id[row[order]] != doc_id[row[lead]]) | (pos[order] != pos[lead])
        d, t, s, m = _flag_rows(doc_id[row], tid[row], pos, late)
        out = [np.concatenate(x) for x in zip((d, t, s, m), (doc_id[known], tid[known], start[known], mask[known]))]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["doc_id", "tid", "start", "mask"])

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        key = table.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if cut:
            yield flags(table.slice(0, cut).combine_chunks())
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield flags(held.combine_chunks())


def _keeps(batches):
    for batch in batches:
        n_words, n_removed, sha, kept = [], [], [], []
        cells = batch.column("cells")
        data, offsets = W.buffers(batch.column("text"))
        for lo, hi in W.slices(offsets):
            part = data[offsets[lo] : offsets[hi]]
            local = offsets[lo : hi + 1] - offsets[lo]
            start, end, doc = W.bounds(part, local)
            begin = np.searchsorted(doc, np.arange(hi - lo + 1))
            cover = np.zeros(len(start) + 1, np.int64)
            for i in range(lo, hi):
                if cells[i].is_valid:
                    flags = cells[i].values.to_numpy()
                    first, mask = flags >> 31, flags & 0x7FFFFFFF
                    at = np.unique((first[:, None] + np.arange(31))[(mask[:, None] >> np.arange(31)) & 1 > 0]) + begin[i - lo]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + WIDTH, -1)
            keep = np.cumsum(cover)[:-1] == 0
            words = np.diff(begin)
            left = np.bincount(doc[keep], minlength=hi - lo)
            # the kept words' bytes, each with the blank after it but for a document's last
            step = np.zeros(len(part) + 2, np.int64)
            ks, ke, kd = start[keep], end[keep], doc[keep]
            last = np.append(kd[1:] != kd[:-1], True) if len(kd) else np.zeros(0, bool)
            np.add.at(step, ks, 1)
            np.add.at(step, np.where(last, ke, ke + 1), -1)
            take = np.cumsum(step)[: len(part)] > 0
            out = np.where(W.SPACE[part], 32, part).astype(np.uint8)[take].tobytes()
            sizes = np.bincount(np.searchsorted(local, np.flatnonzero(take), "right") - 1, minlength=hi - lo)
            ends = np.cumsum(sizes)
            for a, b in zip(ends - sizes, ends):
                kept.append(out[a:b].decode())
                sha.append(hashlib.sha256(out[a:b]).hexdigest())
            n_words += words.tolist()
            n_removed += (words - left).tolist()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (words joined by one blank) of every document."""
    last = F.lit((1 << 63) - 1)
    rows = short_batches(docs).select(F.coalesce(F.col("doc_id").cast("long"), last).alias("doc_id"), F.xxhash64("text").alias("tid"), "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long_enough = rows.where(F.length("text") >= 2 * WIDTH - 1)
    sent = long_enough.mapInArrow(partial(_sends, busy=busy_symbols(long_enough.select("text"), parts)), _SCHEMA)
    found = sent.repartition(parts, "key").sortWithinPartitions("key", "doc_id", "start").mapInArrow(_compares, "doc_id long, tid long, start int, mask int")
    flags = saved(found.groupBy("doc_id", "tid").agg(F.collect_list(F.shiftleft(F.col("start").cast("long"), 31).bitwiseOR(F.col("mask").cast("long"))).alias("cells")), "repeats")
    few = (flags.agg(F.sum(F.size("cells"))).first()[0] or 0) <= BROADCAST_CELLS
    flags = flags.withColumnsRenamed({"doc_id": "f_id", "tid": "f_tid"})
    joined = rows.join(F.broadcast(flags) if few else flags, (F.col("doc_id") == F.col("f_id")) & (F.col("tid") == F.col("f_tid")), "left")
    joined = joined.select(F.when(F.col("doc_id") != last, F.col("doc_id")).alias("doc_id"), "text", "cells")
    return joined.mapInArrow(_keeps, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op9_substrings(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).drop("kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM f WHERE n > 1),
e AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d WHERE len(w) > 0),
k AS (SELECT e.doc_id, string_agg(x, ' ' ORDER BY e.i) FILTER (WHERE c.i IS NULL) AS kept, count(c.i) AS n_removed FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.i = c.i GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
