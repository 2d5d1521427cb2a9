"""Repeated byte strings by blockwise suffix sorting with a difference cover.

Suffixes matter here only by their first WINDOW bytes: two suffixes tie if those are equal.
A difference cover of period v marks places of every document such that for any two places
there is a shift below v that leads both to marked ones. So when two suffixes tie, at that
shift two marked suffixes agree in DEPTH = WINDOW - v + 1 bytes.

1. Marked suffixes (8 of 57) whose first DEPTH bytes occur once in all are left out, by
   fingerprints: equal bytes have equal fingerprints, so a tie is never lost, and a
   fingerprint that two strings share only keeps a suffix that wasn't needed.
2. The others, the cover sample, are sorted by their bytes, one bucket at a time (a bucket is
   a range of fingerprints of the first DEPTH bytes, so that ties meet in one). From order and
   common prefixes comes each one's rank at every depth up to WINDOW; what stands before it is
   ranked likewise, backwards.
3. Any other suffix that starts some shift before a marked one is not sorted by itself: its
   place among those it may tie with is the pair of ranks at its shift, that of the bytes
   between it and the mark, and that of the marked suffix to the depth that is left. Of
   suffixes with equal pairs the first in document order stays, the others start strings that
   have been seen earlier. Decisions rest on bytes alone.

A marked string that has been found in more than HOT_BLOCKS blocks of documents would bring
too many sample suffixes into one bucket, each with other surroundings. Around such marks
the strings of WINDOW bytes themselves are looked up, in order of blocks, with what has been
seen as the only memory: a block sends a string once, whatever number of documents has it.

Equal suffixes of a block with equal surroundings are one entry. The number of buckets
follows from the number of entries; a task takes up one at a time. Buckets are dealt with in
PASSES: what one pass shuffles is gone before the next one starts, which bounds the disk
that the sample's bytes need.

Defined cases: a null text has no bytes; a text shorter than WINDOW bytes keeps all; a text
of any length is one row of one block, worked on with some 20 times its size in memory;
repeated rows: the first in document order keeps its bytes (rows with equal ids in any
order); ids must be whole numbers, null ids stand before all others, in order of a hash of
their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiloom.llm import blobs as B
from poiloom.llm import words as W
from poiloom.llm.common import own_names, small_batches

WINDOW = 100
#: A perfect difference set: every difference modulo PERIOD occurs exactly once. Fixed values.
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: A marked string in more blocks than these is looked up by whole windows.
HOT_BLOCKS = 256
#: Codes of marked strings: they tie, and are hot.
TIED, HOT = 1, 2
#: Entries of a bucket, and entries gathered at a time.
BUCKET, GATHERED = 1 << 17, 1 << 16
#: Passes over the sample, each with its share of the buckets.
PASSES = 3
#: Fingerprints made at a time.
SLICE = 1 << 17
#: Kinds of answers.
COVERED, SEEN = 0, 1


def byte_prints(raw: bytes, places: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit fingerprint of the width bytes from each place on; width is 8 at least."""
    found = np.empty(len(places), dtype=np.uint64)
    if not len(places):
        return found
    eight = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    shifts = [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]
    for i in range(0, len(places), SLICE):
        at = places[i : i + SLICE]
        acc = np.full(len(at), W.ODD)
        for s in shifts:
            x = eight[at + s] * W.MIX1
            x ^= x >> np.uint64(32)
            acc ^= x
            acc *= W.MIX2
            acc ^= acc >> np.uint64(29)
        found[i : i + SLICE] = W.mixed(acc)
    return found


def cover_places(begin: np.ndarray, width: int, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """Marked places of documents laid end to end, from which width bytes of the same document follow."""
    lengths = np.diff(begin)
    longest = int(lengths.max(initial=0))
    turns = longest // period + 1
    marks = (np.arange(turns)[:, None] * period + np.array(cover)).ravel()
    found = [b + marks[: int(np.searchsorted(marks, n - width, side="right"))] for b, n in zip(begin[:-1].tolist(), lengths.tolist(), strict=True) if n >= width]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def reachable(marked: np.ndarray, begin: np.ndarray, window: int, period: int) -> np.ndarray:
    """Places at most period - 1 before a marked one, from which window bytes of the same document follow."""
    total = int(begin[-1])
    if not len(marked):
        return np.zeros(0, dtype=np.int64)
    text = np.searchsorted(begin, marked, side="right") - 1
    first = np.maximum(marked - (period - 1), begin[text])
    last = np.minimum(marked, begin[text + 1] - window)
    ok = last >= first
    edge = np.zeros(total + 1, dtype=np.int32)
    np.add.at(edge, first[ok], 1)
    np.subtract.at(edge, last[ok] + 1, 1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def fixed(rows: np.ndarray) -> pa.Array:
    """The rows of a byte matrix as an array of byte strings."""
    return pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])


def firsts(rows: np.ndarray) -> np.ndarray:
    """For each row of a byte matrix the number of the first row that equals it."""
    codes = fixed(rows).dictionary_encode().indices.to_numpy()
    head = np.empty(int(codes.max(initial=-1)) + 1, dtype=np.int64)
    head[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return head[codes]


def in_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of a byte matrix's rows, and of each in that order how many bytes it shares with the one before (-1: the first)."""
    order = pc.sort_indices(fixed(rows)).to_numpy()
    shared = np.full(len(rows), -1, dtype=np.int64)
    for i in range(1, len(rows), 1 << 16):
        a, b = rows[order[i - 1 : i - 1 + (1 << 16)]], rows[order[i : i + (1 << 16)]]
        other = a[: len(b)] != b
        shared[i : i + len(b)] = np.where(other.any(axis=1), other.argmax(axis=1), rows.shape[1])
    return order, shared


def padded(raw: bytes, slack: int) -> np.ndarray:
    """The bytes with slack zeros on both sides."""
    wide = np.zeros(len(raw) + 2 * slack, dtype=np.uint8)
    wide[slack : slack + len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return wide


def surroundings(wide: np.ndarray, begin: np.ndarray, places: np.ndarray, depth: int, slack: int) -> np.ndarray:
    """A row of bytes for each place: slack before it, depth + slack from it on, then how many of the slacks are of its document; others are 0."""
    text = np.searchsorted(begin, places, side="right") - 1
    left = np.minimum(places - begin[text], slack)
    right = np.minimum(begin[text + 1] - places - depth, slack)
    width = depth + 2 * slack
    rows = np.empty((len(places), width + 2), dtype=np.uint8)
    rows[:, :width] = np.lib.stride_tricks.sliding_window_view(wide, width)[places]
    rows[:, width], rows[:, width + 1] = left, right
    at = np.arange(slack)
    for edge in np.flatnonzero((left < slack) | (right < slack)):
        rows[edge, :slack][at < slack - left[edge]] = 0
        rows[edge, slack + depth : width][at >= right[edge]] = 0
    return rows


def shifts(rows: np.ndarray, slack: int) -> np.ndarray:
    """By entry, a bit for each shift at which a window that lies in the document starts before the mark."""
    left, right = rows[:, -2].astype(np.uint64), rows[:, -1].astype(np.uint64)
    one = np.uint64(1)
    low = np.uint64(slack) - right
    return np.where(low <= left, ((one << (left + one)) - one) & ~((one << low) - one), np.uint64(0))


def seen_earlier(rows: np.ndarray, depth: int, slack: int) -> np.ndarray:
    """A bucket's entries, in document order: a bit for each shift whose window equals that of an earlier entry."""
    every = shifts(rows, slack)
    head = firsts(rows)
    found = every.copy()  # an entry that equals an earlier one throughout
    own = np.flatnonzero(head == np.arange(len(head)))
    found[own] = 0
    width = depth + 2 * slack
    order, shared = in_order(np.ascontiguousarray(rows[own, slack:width]))
    tie = np.cumsum(shared < depth)
    several = np.bincount(tie)[tie] > 1
    own, tie = own[order[several]], tie[several]
    if not len(own):
        return found
    at = np.argsort(own)  # document order again
    own, tie = own[at], tie[at]
    ahead = rows[own, slack:width]
    order_a, shared_a = in_order(np.ascontiguousarray(ahead))
    behind = np.concatenate([tie.astype(">u4").view(np.uint8).reshape(-1, 4), rows[own, :slack][:, ::-1]], axis=1)
    order_b, shared_b = in_order(np.ascontiguousarray(behind))
    left, right, bits = rows[own, -2], rows[own, -1], np.zeros(len(own), dtype=np.uint64)
    rank_a, rank_b = np.empty(len(own), dtype=np.uint64), np.empty(len(own), dtype=np.uint64)
    for shift in range(slack + 1):
        rank_a[order_a] = np.cumsum(shared_a < depth + slack - shift)
        rank_b[order_b] = np.cumsum(shared_b < 4 + shift)
        ok = np.flatnonzero((left >= shift) & (right >= slack - shift))
        # a pair that is new has the next number
        pairs = pa.array(rank_b[ok] << np.uint64(32) | rank_a[ok]).dictionary_encode().indices.to_numpy()
        new = np.ones(len(pairs), dtype=bool)
        new[1:] = pairs[1:] > np.maximum.accumulate(pairs)[:-1]
        bits[ok[~new]] |= np.uint64(1 << shift)
    found[own] = bits
    return found


class Entries:
    """What a block asks about its tied marks: the distinct entries of each bucket, in order of their places."""

    def __init__(self, raw: bytes, begin: np.ndarray, places: np.ndarray, prints: np.ndarray, bounds: np.ndarray, depth: int, slack: int):
        self.wide, self.begin, self.depth, self.slack = padded(raw, slack), begin, depth, slack
        bucket = np.searchsorted(bounds, prints, side="right")
        order = np.argsort(bucket, kind="stable")
        self.places, self.bucket = places[order], bucket[order]

    def rows(self, places: np.ndarray) -> np.ndarray:
        return surroundings(self.wide, self.begin, places, self.depth, self.slack)

    def heads(self, places: np.ndarray) -> np.ndarray:
        """For each place the first one with the same entry; not more than GATHERED entries are at hand unless they differ."""
        if len(places) <= GATHERED:
            return firsts(self.rows(places)) if len(places) else np.zeros(0, dtype=np.int64)
        head = np.concatenate([i + self.heads(places[i : i + GATHERED]) for i in range(0, len(places), GATHERED)])
        own = np.flatnonzero(head == np.arange(len(head)))
        again = self.heads(places[own]) if len(own) <= len(places) // 2 else firsts(self.rows(places[own]))
        to = np.empty(len(head), dtype=np.int64)
        to[own] = own[again]
        return to[head]

    def of(self, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        """(bucket, its places, number of the first place with the same entry, rows if they are at hand) of the buckets from low up to high."""
        at, last = np.searchsorted(self.bucket, [low, high]).tolist()
        while at < last:
            # some whole buckets at a time: entries of different ones are never equal
            end = min(at + GATHERED, last)
            if end < last:
                edge = int(np.searchsorted(self.bucket, self.bucket[end]))
                end = edge if edge > at else int(np.searchsorted(self.bucket, self.bucket[at], side="right"))
            places = self.places[at:end]
            rows = self.rows(places) if len(places) <= GATHERED else None
            head = self.heads(places) if rows is None else firsts(rows)
            own = self.bucket[at:end]
            cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])).tolist()
            for a, b in zip(cut, [*cut[1:], len(own)], strict=True):
                yield int(own[a]), places[a:b], head[a:b] - a, None if rows is None else rows[a:b]
            at = end


def remove_seen(docs: DataFrame, window: int = WINDOW, prints: Callable = byte_prints, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: bytes in a window-byte string that also starts earlier are removed.

    prints: fingerprints of byte strings, see byte_prints(). The result doesn't depend on them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    depth, slack = window - PERIOD + 1, PERIOD - 1
    if depth < 8:
        raise ValueError(f"window must be at least {PERIOD + 7} bytes")
    d = own_names(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    of = B.layout(d)
    bounds = B.edges(B.buckets_for(spark, of.bytes * len(COVER) / PERIOD))

    def read(texts):
        raws = [t.encode() if t else b"" for t in texts]
        return raws, b"".join(raws), W.starts(np.array([len(x) for x in raws], dtype=np.int64))

    def mark(batches):
        for batch in batches:
            for block, at in B.by_block(of, batch):
                _, raw, begin = read(batch.column(1).take(pa.array(at)).to_pylist())
                yield B.question_batch(B.questions(block, B.flagged(prints(raw, cover_places(begin, depth), depth)), bounds))

    def ties(flags, first, times):
        tied = (times > 1) | ((flags[first] & B.OFTEN) > 0)
        return np.repeat(np.where(tied, np.where(times > hot_blocks, HOT, TIED), 0), times)

    tied = B.answered(d.mapInArrow(mark, B.QUESTION), ties, "cover", named=True)
    # entries are as many as tied strings in blocks, and more where those have several surroundings
    buckets = PASSES * B.buckets_for(spark, (tied.agg(F.sum("n")).first()[0] or 0) / PASSES, BUCKET)
    ranges = B.edges(buckets)

    def sample(raw, begin, answers) -> tuple[Entries, Entries]:
        """The entries of a block's tied marks, and of the windows around hot ones."""
        marked = cover_places(begin, depth)
        own = prints(raw, marked, depth) & ~B.FLAGS
        code = B.named_codes(own, answers)
        places = reachable(marked[code == HOT], begin, window, PERIOD)
        return (
            Entries(raw, begin, marked[code == TIED], own[code == TIED], ranges, depth, slack),
            Entries(raw, begin, places, prints(raw, places, window), ranges, window, 0),
        )

    def ask(share):
        def one(batches):
            for block, answers, table in B.blocks_of(batches):
                _, raw, begin = read(table.column(1).to_pylist())
                for k, entries in enumerate(sample(raw, begin, answers.get(COVERED, {}))):
                    rows = []
                    for bucket, places, head, at_hand in entries.of(share * buckets // PASSES, (share + 1) * buckets // PASSES):
                        own = head == np.arange(len(head))
                        rows.append((bucket + k * buckets, block, B.squeeze(entries.rows(places[own]) if at_hand is None else at_hand[own])))
                    if rows:
                        yield B.question_batch(rows)

        return one

    def decide(batches):
        width = window + slack + 2
        current, seen = None, set()
        plain = []

        def close():
            if plain:
                tables = [B.unsqueeze(b, np.uint8).reshape(-1, width) for _, b in plain]
                bits = seen_earlier(np.concatenate(tables), depth, slack)
                out = [(block, current, int(np.count_nonzero(x)), B.squeeze(x)) for (block, _), x in zip(plain, np.split(bits, np.cumsum([len(t) for t in tables])[:-1]), strict=True)]
                plain.clear()
                pa.default_memory_pool().release_unused()
                if out := [x for x in out if x[2]]:
                    yield B.answer_batch(out)

        for batch in batches:
            for part, block, blob in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist(), batch.column("blob"), strict=True):
                if part != current:
                    yield from close()
                    current, seen = part, set()
                if part < buckets:
                    plain.append((block, blob.as_buffer()))
                    continue
                rows = B.unsqueeze(blob.as_buffer(), np.uint8).reshape(-1, window + 2)
                strings = fixed(rows).to_pylist()
                old = np.array([x in seen for x in strings], dtype=np.uint64)
                seen.update(strings)
                if old.any():
                    yield B.answer_batch([(block, part, int(old.sum()), B.squeeze(old))])
        yield from close()

    def starts(raw, begin, answers) -> np.ndarray:
        """Where the windows start that have been seen earlier."""
        gone = np.zeros(len(raw), dtype=bool)
        for k, entries in enumerate(sample(raw, begin, answers.get(COVERED, {}))):
            verdict = answers.get(SEEN, {})
            for bucket, places, head, at_hand in entries.of(0, buckets):
                own = head == np.arange(len(head))
                bits = np.zeros(len(places), dtype=np.uint64)
                if bucket + k * buckets in verdict:
                    bits[own] = B.unsqueeze(verdict[bucket + k * buckets][0], np.uint64)
                if not own.all():  # an entry again, in the same block
                    bits[~own] = shifts(entries.rows(places[~own]) if at_hand is None else at_hand[~own], entries.slack)
                some = np.bitwise_or.reduce(bits) if len(bits) else 0
                for shift in range(entries.slack + 1):
                    if int(some) >> shift & 1:
                        gone[places[(bits >> np.uint64(shift)) & np.uint64(1) > 0] - shift] = True
        return np.flatnonzero(gone)

    def remove(batches):
        for _, answers, table in B.blocks_of(batches):
            raws, raw, begin = read(table.column(1).to_pylist())
            at = starts(raw, begin, answers)
            gone = W.covered(at, window, len(raw)) if len(at) else np.zeros(len(raw), dtype=bool)
            removed, spans, shas = [], [], []
            for i, x in enumerate(raws):
                own = gone[begin[i] : begin[i + 1]]
                removed.append(int(own.sum()))
                if removed[-1]:
                    spans.append(int(own[0]) + int((own[1:] & ~own[:-1]).sum()))
                    x = np.frombuffer(x, dtype=np.uint8)[~own].tobytes()
                else:
                    spans.append(0)
                shas.append(hashlib.sha256(x).hexdigest())
            ids = table.column(0).combine_chunks()
            columns = [pa.array([len(x) for x in raws], pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    texts = B.together(d, of, (COVERED, tied))
    passes = [B.stored(B.dealt(texts.mapInArrow(ask(k), B.QUESTION)).mapInArrow(decide, B.ANSWER), "suffixes") for k in range(PASSES)]
    verdict = reduce(DataFrame.unionByName, passes)
    return B.together(d, of, (COVERED, tied), (SEEN, verdict)).mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
