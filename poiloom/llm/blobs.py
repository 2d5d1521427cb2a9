"""Blocks of documents, and the exchange of what they ask about, in packed form.

Documents belong to blocks by their id, so blocks stand in id order (Layout). A block asks
about its distinct fingerprints: sorted, cut into buckets (ranges of fingerprints), each
bucket packed as differences in byte planes, which Spark's shuffle compression shrinks to
the few bytes that differ. A task takes up one bucket at a time, with what all blocks ask in
it; the number of buckets follows from the input, so a bucket's memory is bounded however
many tasks there are. However frequent a fingerprint is, a block sends it once.

Answers meet the texts of their block in together() and blocks_of(). As long as a block's
documents lie in several partitions, it asks in parts, and an answer names the fingerprints
(named). A block that is together gets a code for each fingerprint in the order of its
question, without any fingerprints (codes_of).

Two low bits of a fingerprint are flags, so 62 bits tell fingerprints apart.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiloom.llm.common import own_names, shuffle_partitions, small_batches, stored

#: Bytes of text that a block should have, and the most documents.
BLOCK_BYTES, BLOCK_ROWS = 2 << 20, 4096
#: Bytes of text in a task that works on whole blocks.
TASK_BYTES = 64 << 20
#: Fingerprints that a bucket should have.
BUCKET = 1 << 20
FLAGS = np.uint64(3)
#: Flag bits of a question: it occurs more than once in its block; it wants an answer.
OFTEN, WANTED = np.uint64(1), np.uint64(2)
TEXT = 9


@dataclass(frozen=True)
class Layout:
    """Blocks of ids: block = (id - least) >> bits; documents without id are dealt out to blocks below by their text."""

    least: int
    bits: int
    null_blocks: int
    bytes: int

    def blocks(self, ids: pa.Array, texts: pa.Array) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        n = ids.cast(pa.int64()).fill_null(self.least).to_numpy(zero_copy_only=False)
        # differences are taken modulo 2 ** 64, as ids may lie that far apart
        found = ((n.astype(np.uint64) - np.uint64(self.least % (1 << 64))) >> np.uint64(self.bits)).astype(np.int64)
        if ids.null_count:
            for i in np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)):
                found[i] = -1 - xxh3_64_intdigest((texts[int(i)].as_py() or "").encode()) % self.null_blocks
        return found


def layout(docs: DataFrame, key: str = "doc_id") -> Layout:
    """Blocks of some BLOCK_BYTES, if ids lie evenly; one look at ids and lengths."""
    id_ = F.col(key).cast("long")
    r = docs.agg(F.min(id_).alias("low"), F.max(id_).alias("high"), F.count(id_).alias("n"), F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    size = r["bytes"] or 0
    each = min(max(BLOCK_BYTES * r["rows"] / max(size, 1), 1.0), BLOCK_ROWS)
    span = (r["high"] - r["low"] + 1) / r["n"] if r["n"] else 1
    return Layout(r["low"] or 0, min(max(int(math.log2(max(each * span, 1))), 0), 63), max(1, int((r["rows"] - r["n"]) / each)), size)


def buckets_for(spark, entries: float, each: int = BUCKET) -> int:
    return max(shuffle_partitions(spark), math.ceil(entries / each))


def squeeze(a: np.ndarray) -> bytes:
    """An array's bytes, compressed."""
    return struct.pack("<q", a.nbytes) + pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True)


def unsqueeze(blob: pa.Buffer | bytes, kind) -> np.ndarray:
    raw = memoryview(blob)
    return np.frombuffer(pa.decompress(raw[8:], decompressed_size=struct.unpack("<q", raw[:8])[0], codec="zstd", asbytes=True), dtype=kind)


def pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as byte planes of their differences."""
    d = values.copy()
    d[1:] -= values[:-1]
    return d.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    d = np.ascontiguousarray(np.frombuffer(blob, dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(d, dtype=np.uint64)


def flagged(prints: np.ndarray, wanted: np.ndarray | bool = True) -> np.ndarray:
    """Distinct fingerprints, ascending, flags in the low bits: OFTEN, and WANTED if any occurrence wants an answer."""
    if not len(prints):
        return prints
    v = np.sort((prints & ~FLAGS) | (np.where(wanted, WANTED, np.uint64(0)) if isinstance(wanted, np.ndarray) else WANTED))
    own = v & ~FLAGS
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    times = np.diff(np.concatenate([first, [len(v)]]))
    return own[first] | (v[first + times - 1] & WANTED) | np.where(times > 1, OFTEN, np.uint64(0))


def edges(buckets: int) -> np.ndarray:
    """The lowest fingerprint of each bucket but the first."""
    return np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)


def cuts(values: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of each bucket that ascending values have a part in."""
    if not len(values):
        return
    at = np.searchsorted(bounds, values, side="right")
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    yield from zip(at[first].tolist(), first.tolist(), [*first[1:].tolist(), len(values)], strict=True)


def questions(block: int, values: np.ndarray, bounds: np.ndarray, second: np.ndarray | None = None) -> list[tuple[int, int, bytes]]:
    """(bucket, block, packed range) for each bucket that values has a part in. second: 64 more bits of each."""
    return [(k, block, pack(values[a:b]) + (b"" if second is None else second[a:b].astype("<u8").tobytes())) for k, a, b in cuts(values, bounds)]


def question_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["part", "block", "blob"])


QUESTION = "part int, block long, blob binary"
PIECE = "block long, kind int, part int, blob binary"
ANSWER = "block long, part int, n long, blob binary"


def answer_batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["block", "part", "n", "blob"])


def dealt(asked: DataFrame) -> DataFrame:
    """Questions dealt out to tasks by bucket, bucket by bucket, each in order of blocks. Spark sorts, and spills if it must."""
    return asked.repartitionById(shuffle_partitions(asked.sparkSession), F.col("part")).sortWithinPartitions("part", "block")


def by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[pa.Buffer]]]:
    """(bucket, blocks, blobs) of a task's dealt questions."""
    current, blocks, blobs = None, [], []
    for batch in batches:
        for part, block, blob in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist(), batch.column("blob"), strict=True):
            if part != current and blobs:
                yield current, blocks, blobs
                blocks, blobs = [], []
            current = part
            blocks.append(block)
            blobs.append(blob.as_buffer())
    if blobs:
        yield current, blocks, blobs


def answered(asked: DataFrame, decide: Callable, what: str, named: bool = False, second: bool = False) -> DataFrame:
    """Stored answers: codes in the order of each question; n of them aren't 0. Questions whose codes are all 0 get none.

    decide: (flags, starts of equal ones, how many there are of each), entries sorted by
    fingerprint, then block, to their codes (0 to 3). named: only fingerprints whose code isn't 0, the code as
    flags. second: see questions().
    """

    def meet(batches):
        for part, blocks, blobs in by_bucket(batches):
            sizes = [len(b) // (16 if second else 8) for b in blobs]
            v = np.concatenate([unpack(memoryview(b)[: 8 * n]) for b, n in zip(blobs, sizes, strict=True)])
            own, flags = v & ~FLAGS, v & FLAGS
            if second:
                w = np.concatenate([np.frombuffer(b, dtype="<u8", offset=8 * n) for b, n in zip(blobs, sizes, strict=True)])
                order = np.lexsort((w, own))
                new = (own[order][1:] != own[order][:-1]) | (w[order][1:] != w[order][:-1])
            else:
                order = np.argsort(own, kind="stable")
                new = own[order][1:] != own[order][:-1]
            first = np.flatnonzero(np.concatenate([[True], new]))
            codes = np.empty(len(v), dtype=np.uint8)
            codes[order] = decide(flags[order], first, np.diff(np.append(first, len(v))))
            out = []
            ends = np.cumsum(sizes)[:-1]
            for block, c, mine in zip(blocks, np.split(codes, ends), np.split(own, ends), strict=True):
                if n := int(np.count_nonzero(c)):
                    out.append((block, part, n, pack(mine[c > 0] | c[c > 0]) if named else squeeze(c)))
            if out:
                yield answer_batch(out)
            pa.default_memory_pool().release_unused()

    return stored(dealt(asked).mapInArrow(meet, ANSWER), what)


def codes_of(values: np.ndarray, bounds: np.ndarray, answers: dict[int, list[pa.Buffer]]) -> np.ndarray:
    """The code of each of the distinct fingerprints that a block asked about, ascending."""
    found = np.zeros(len(values), dtype=np.uint8)
    for k, a, b in cuts(values, bounds):
        if k in answers:
            found[a:b] = unsqueeze(answers[k][0], np.uint8)
    return found


def named_codes(values: np.ndarray, answers: dict[int, list[pa.Buffer]]) -> np.ndarray:
    """The code of each fingerprint, from answers that name them."""
    found = np.zeros(len(values), dtype=np.uint8)
    if answers and len(values):
        known = np.sort(np.concatenate([unpack(b) for blobs in answers.values() for b in blobs]))
        own = values & ~FLAGS
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        hit = (known[at] & ~FLAGS) == own
        found[hit] = (known[at] & FLAGS)[hit]
    return found


def by_block(of: Layout, batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
    """The blocks of a batch (ids and texts first), and the rows of each."""
    n = of.blocks(batch.column(0), batch.column(1))
    if not len(n):
        return []
    order = np.argsort(n, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], n[order][1:] != n[order][:-1]]))
    return [(int(n[order[s]]), np.sort(order[s:e])) for s, e in zip(cut, [*cut[1:], len(n)], strict=True)]


def packed_rows(part: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(part)
    return sink.getvalue().to_pybytes()


def piece_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """(block, kind, blob)"""
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([0] * len(rows), pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["block", "kind", "part", "blob"])


def pieces(docs: DataFrame, of: Layout, key: str = "doc_id") -> DataFrame:
    """The texts, packed by block: rows (block, TEXT, 0, compressed ids and texts)."""
    small_batches(docs.sparkSession)

    def bundle(batches):
        for batch in batches:
            yield piece_batch([(block, TEXT, packed_rows(batch.take(pa.array(at)))) for block, at in by_block(of, batch)])

    return own_names(docs, key, "text").mapInArrow(bundle, PIECE)


def met(rows: DataFrame, of: Layout) -> DataFrame:
    """Pieces dealt out by block, in order of kind: for blocks_of()."""
    spark = rows.sparkSession
    return rows.repartition(max(shuffle_partitions(spark), of.bytes // TASK_BYTES), "block").sortWithinPartitions("block", "kind", "part")


def together(docs: DataFrame, of: Layout, *answers: tuple[int, DataFrame]) -> DataFrame:
    """Texts and the answers of their blocks, each with its kind."""
    all_ = pieces(docs, of)
    for kind, a in answers:
        all_ = all_.unionByName(a.select("block", F.lit(kind).alias("kind"), "part", "blob"))
    return met(all_, of)


def blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, dict[int, list[pa.Buffer]]], pa.Table]]:
    """Each block with its answers (by kind, then bucket) and its rows, by id (nulls first, stable)."""
    current, answers, texts = None, {}, []

    def close():
        if texts:
            pa.default_memory_pool().release_unused()
            table = pa.concat_tables(texts)
            yield current, answers, table.take(pc.sort_indices(table.column(0), null_placement="at_start")).combine_chunks()

    for batch in batches:
        for block, kind, part, blob in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "part")), batch.column("blob"), strict=True):
            if block != current:
                yield from close()
                current, answers, texts = block, {}, []
            if kind == TEXT:
                texts.append(pa.ipc.open_stream(blob.as_buffer()).read_all())
            else:
                answers.setdefault(kind, {}).setdefault(part, []).append(blob.as_buffer())
    yield from close()

