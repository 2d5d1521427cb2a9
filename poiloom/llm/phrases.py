"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, the phrases' names into phrases, and so on:

- Equal neighbours are first put together to one symbol, named by symbol and number.
- Deterministic coin tossing then gives each symbol a small label: twice the lowest bit in
  which it differs from the symbol before it, plus that bit's value. Three rounds bring any
  64-bit symbols to 8 labels, neighbours always different.
- A phrase starts where a label is a local minimum. That depends on a few symbols around,
  so equal substrings are cut at the same places inside, wherever they stand.
- A phrase's name is a hash of its symbols in order.

The fingerprint keeps, of each of three levels, the smallest of the hashed distinct names
(a bottom sketch). Likeness of two fingerprints is the Jaccard similarity estimated from
the highest level that has enough names in both.

The edited text of a document needs the next document by id. Texts are dealt out by blocks
of ids; within a block the next one is at hand, and each block gets the first document of
the block after it.

Defined cases: a null text is an empty one, its fingerprint has no names; two fingerprints
without names are alike (1.0), with and without are not (0.0); rows with equal ids stand
in order of their texts; rows without id stand first, in order of blocks by a hash of their
texts, then of texts; a text of any length is one row of one block; the next of the last document is the first
one, of a single document itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiloom.llm import blobs as B
from poiloom.llm import words as W
from poiloom.llm.common import own_names, ranked, small_batches, stored

#: Names kept of each level, lowest first.
KEPT = (16, 24, 48)
#: A level is used for likeness if both have so many names.
ENOUGH = 12
#: Share of a text that the edit replaces: 1 / EDIT of its code points.
EDIT = 4
#: Kind of the row that hands a block's first document over.
HANDED = 1
#: Bytes parsed at a time; single texts may be longer.
CHUNK = 1 << 20


def labels(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Coin tossing's labels below 8 of symbols that differ from their left neighbours; start: first symbol of a text."""
    for _ in range(3):
        before = np.empty_like(x)
        before[1:] = x[:-1]
        before[0] = 0
        # a text's first symbol has no neighbour: it is compared with its own complement
        before[start] = ~x[start]
        d = x ^ before
        low = d & (~d + x.dtype.type(1))
        x = (np.bitwise_count(low - x.dtype.type(1)).astype(np.uint8) << 1) | ((x & low) != 0)
    return x


def parse(x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: names of the phrases of x, and where each text's phrases begin. Empty texts are not among them."""
    n = len(x)
    new = np.ones(n, dtype=bool)
    new[1:] = x[1:] != x[:-1]
    new[start] = True
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, n))
    x = x[at].astype(np.uint64)
    long = run > 1
    x[long] = W.mixed(x[long] + run[long].astype(np.uint64) * W.ODD)
    start = np.searchsorted(at, start)
    own = labels(x, start)
    cut = np.zeros(len(x), dtype=bool)
    cut[1:-1] = (own[1:-1] < own[:-2]) & (own[1:-1] < own[2:])
    cut[start[start > 0] - 1] = False  # the last symbol of a text has no right neighbour
    cut[start] = True
    at = np.flatnonzero(cut)
    place = np.arange(len(x)) - np.repeat(at, np.diff(np.append(at, len(x))))
    names = W.mixed(np.add.reduceat(W.mixed(x + (place.astype(np.uint64) + np.uint64(1)) * W.ODD), at))
    return names, np.searchsorted(at, start)


def smallest(names: np.ndarray, begin: np.ndarray, keep: int, total: int) -> list[np.ndarray]:
    """Of each text the keep smallest distinct hashed names, ascending, cut to 32 bits."""
    h = W.mixed(names + W.ODD)
    ends = np.append(begin[1:], total)
    found = []
    for b, e in zip(begin.tolist(), ends.tolist(), strict=True):
        own = h[b:e]
        if len(own) > 8 * keep:
            own = own[own <= np.partition(own, 4 * keep)[4 * keep]] if len(np.unique(own[: 2 * keep])) > keep else own
        own = np.unique(own)
        if len(own) < keep and e - b > 8 * keep:
            own = np.unique(h[b:e])
        found.append((own[:keep] >> np.uint64(32)).astype(np.uint32))
    return found


def sketches(raws: list[bytes]) -> list[tuple[np.ndarray, ...]]:
    """The fingerprint of each text, one array of each level."""
    none = np.zeros(0, dtype=np.uint32)
    found = [[none] * len(KEPT) for _ in raws]
    own = [i for i, r in enumerate(raws) if r]
    for group in chunks(own, raws):
        x = np.frombuffer(b"".join(raws[i] for i in group), dtype=np.uint8)
        start = W.starts(np.array([len(raws[i]) for i in group]))[:-1]
        for level, keep in enumerate(KEPT):
            x, start = parse(x, start)
            for i, s in zip(group, smallest(x, start, keep, len(x)), strict=True):
                found[i][level] = s
    return [tuple(f) for f in found]


def chunks(at: list[int], raws: list[bytes]) -> Iterator[list[int]]:
    group, size = [], 0
    for i in at:
        group.append(i)
        size += len(raws[i])
        if size >= CHUNK:
            yield group
            group, size = [], 0
    if group:
        yield group


def shown(sketch: tuple[np.ndarray, ...]) -> str:
    """A fingerprint as text: levels in hexadecimal, split by points."""
    return ".".join(s.astype(">u4").tobytes().hex() for s in sketch)


def likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    """Estimated share of common phrases, 0 to 1."""
    levels = [k for k in range(len(KEPT)) if len(a[k]) and len(b[k])]
    if not levels:
        return float(all(not len(x) for x in (*a, *b)))
    k = next((k for k in reversed(levels) if min(len(a[k]), len(b[k])) >= ENOUGH), levels[0])
    own, other = set(a[k].tolist()), set(b[k].tolist())
    union = own | other
    if len(own) == KEPT[k] or len(other) == KEPT[k]:  # what lies beyond a full sketch's end is unknown
        size = min(KEPT[k], len(union))
        union = set(sorted(union)[:size])
    return len(union & own & other) / len(union)


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as many characters of the start of the following text, or all of it."""
    n = len(text) // EDIT
    return text[: len(text) - n] + following[:n]


def place_of(doc_id: int | None, text: str) -> tuple:
    """What documents are ordered by within a block."""
    return (doc_id is not None, doc_id or 0, text)


def handed_over(docs: DataFrame, of: B.Layout) -> DataFrame:
    """Pieces (block, HANDED, one packed document): the first document of the block after it, the last block's from the first."""

    def firsts(batches):
        for batch in batches:
            rows = []
            for block, at in B.by_block(of, batch):
                part = batch.take(pa.array(at))
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                best = min(range(len(ids)), key=lambda i: place_of(ids[i], texts[i] or ""))
                rows.append((block, HANDED, B.packed_rows(part.slice(best, 1))))
            yield B.piece_batch(rows)

    own = stored(docs.mapInArrow(firsts, B.PIECE), "firsts")
    blocks = stored(ranked(own.select("block").distinct().withColumn("_all", F.lit(0)), "_all", ["block"], "blocks").select("block", "group_rank"), "block-ranks")
    previous = blocks.select(F.col("block").alias("to"), F.pmod(F.col("group_rank") + 1, F.lit(max(blocks.count(), 1))).alias("group_rank"))
    after = previous.join(blocks, "group_rank").select("block", "to")
    return own.join(after, "block").select(F.col("to").alias("block"), "kind", "part", "blob")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    d = own_names(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    of = B.layout(d)
    all_ = B.met(B.pieces(d, of).unionByName(handed_over(d, of)), of)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def in_order(tables: list[pa.Table]) -> tuple[list, list[str]]:
        table = pa.concat_tables(tables)
        ids = table.column(0).to_pylist()
        texts = [t or "" for t in table.column(1).to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: place_of(ids[i], texts[i]))
        return [ids[i] for i in order], [texts[i] for i in order]

    def block_rows(own: list[pa.Table], handed: list[pa.Table], id_type):
        ids, texts = in_order(own)
        following = [*texts[1:], in_order(handed)[1][0]]
        changed = [edited(a, b).encode() for a, b in zip(texts, following, strict=True)]
        raws = [t.encode() for t in texts]
        prints = sketches([*raws, following[-1].encode()])
        new = sketches(changed)
        columns = [
            pa.array(ids, id_type),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
            pa.array(map(shown, prints[:-1]), pa.string()),
            pa.array(map(shown, new), pa.string()),
            pa.array([likeness(a, b) for a, b in zip(prints[:-1], new, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(prints[:-1], prints[1:], strict=True)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def read(batches):
        current, own, handed = None, [], []
        for batch in batches:
            for block, what, blob in zip(batch.column("block").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
                if block != current:
                    if own:
                        yield block_rows(own, handed, own[0].schema.field(0).type)
                    current, own, handed = block, [], []
                (own if what == B.TEXT else handed).append(pa.ipc.open_stream(blob.as_buffer()).read_all())
        if own:
            yield block_rows(own, handed, own[0].schema.field(0).type)

    return all_.mapInArrow(read, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
