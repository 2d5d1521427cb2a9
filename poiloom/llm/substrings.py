"""Repeated passages of words, found by fixed-block anchors.

Every text is cut into reference blocks of ANCHOR words, side by side. All windows of
ANCHOR words at every place probe the index of blocks. A repeated passage of WINDOW >=
2 * ANCHOR - 1 words holds a whole reference block of its own document, and that block's
words stand in the other passage too, at whatever offset: so a window that repeats has a
block that a probe hit elsewhere. Only windows around such blocks are looked at again, as
whole windows; those that occur more than once grow together to maximal repeats.

The index is dealt out by fingerprint (blobs.py), a frequent passage counts once for each
block of documents, and no pairs are formed. Blocks are found by fingerprints of 62 bits: one
that two passages share only brings more windows to be looked at. Whole windows are compared
by 126 bits, two fingerprints made of independent hashes of the words; of 10 ** 14 windows,
some 100 TB, any two would be taken for each other wrongly once in 10 ** 10 runs.

Defined cases: a null text has no words; a text of fewer than WINDOW words keeps all; a text
of any length is one row of one block, worked on with some 20 times its size in memory;
repeated rows are copies of each other, so their long passages go; ids must be whole
numbers, rows without id are dealt out by their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiloom.llm import blobs as B
from poiloom.llm import words as W
from poiloom.llm.common import own_names, small_batches

WINDOW = 35
#: Bytes that a word and its blank have at least, by which the index is cut into buckets.
WORD_BYTES = 4
#: Kinds of answers.
ANCHORS, PASSAGES = 0, 1


def anchor_of(window: int) -> int:
    """The longest block that lies whole in every window."""
    return (window + 1) // 2


def block_places(begin: np.ndarray, anchor: int) -> np.ndarray:
    """Where the reference blocks start, texts laid end to end."""
    found = [np.arange(b, e - anchor + 1, anchor) for b, e in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True) if e - b >= anchor]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def at_places(h: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """W.windows(h, width)[places], without the others."""
    return W.windows(h[places[:, None] + np.arange(width)], width)[:, 0] if len(places) else np.zeros(0, dtype=np.uint64)


def near(places: np.ndarray, anchor: int, window: int, begin: np.ndarray) -> np.ndarray:
    """Starts of the windows whose own block is one of places: ascending, within their texts."""
    starts = (places[:, None] - np.arange(anchor - 1, -1, -1)).ravel()
    text = np.repeat(np.searchsorted(begin, places, side="right") - 1, anchor)
    return starts[(starts >= begin[text]) & (starts + window <= begin[text + 1])]


def remove_repeats(docs: DataFrame, window: int = WINDOW, hashes: Callable = W.wide_hashes) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: words in a window that also starts anywhere else are removed.

    hashes: two hashes of each word, see words.wide_hashes().
    """
    spark = docs.sparkSession
    small_batches(spark)
    anchor = anchor_of(window)
    d = own_names(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    of = B.layout(d)
    bounds = B.edges(B.buckets_for(spark, of.bytes / WORD_BYTES))

    def read(texts):
        lists = [W.split(t) for t in texts]
        return lists, W.starts(np.array([len(x) for x in lists], dtype=np.int64)), hashes(w for x in lists for w in x)

    def probe(batches):
        for batch in batches:
            for block, at in B.by_block(of, batch):
                _, begin, (h, _) = read(batch.column(1).take(pa.array(at)).to_pylist())
                whole = W.inside(begin, anchor)
                wanted = np.zeros(len(whole), dtype=bool)
                wanted[block_places(begin, anchor)] = True
                yield B.question_batch(B.questions(block, B.flagged(W.windows(h, anchor)[whole], wanted[whole]), bounds))

    def elsewhere(flags, first, times):
        # an entry is a fingerprint in a block of documents; more than one occurrence in all
        often = np.repeat((times > 1) | ((flags[first] & B.OFTEN) > 0), times)
        return often & ((flags & B.WANTED) > 0)

    def candidates(h, begin, answers):
        """Starts of the windows around hit blocks, and which of the distinct ones, ascending, each is."""
        places = block_places(begin, anchor)
        places = places[B.named_codes(at_places(h[0], places, anchor), answers) > 0]
        starts = near(places, anchor, window, begin)
        prints = np.stack([W.windows(h[0], window)[starts] & ~B.FLAGS, W.windows(h[1], window)[starts]])
        order = np.lexsort(prints[::-1])
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (np.diff(prints[:, order]) != 0).any(axis=0)
        which = np.empty(len(starts), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        return starts, which, prints[:, order[new]]

    def again(batches):
        for block, answers, table in B.blocks_of(batches):
            _, begin, h = read(table.column(1).to_pylist())
            _, which, (first, second) = candidates(h, begin, answers.get(ANCHORS, {}))
            often = np.where(np.bincount(which, minlength=len(first)) > 1, B.OFTEN, np.uint64(0))
            yield B.question_batch(B.questions(block, first | B.WANTED | often, ranges, second))

    def remove(batches):
        for _, answers, table in B.blocks_of(batches):
            lists, begin, h = read(table.column(1).to_pylist())
            starts, which, (first, _) = candidates(h, begin, answers.get(ANCHORS, {}))
            starts = np.unique(starts[B.codes_of(first, ranges, answers.get(PASSAGES, {}))[which] > 0])
            gone = W.covered(starts, window, h.shape[1]) if h.shape[1] else np.zeros(0, dtype=bool)
            removed, shas = [], []
            for i, ws in enumerate(lists):
                own = gone[begin[i] : begin[i + 1]]
                removed.append(int(own.sum()))
                kept = ws if not removed[-1] else [w for w, g in zip(ws, own.tolist(), strict=True) if not g]
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            ids = table.column(0).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(x) for x in lists], pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    hits = B.answered(d.mapInArrow(probe, B.QUESTION), elsewhere, "anchors", named=True)
    # a hit block lies in so many windows
    ranges = B.edges(B.buckets_for(spark, (hits.agg(F.sum("n")).first()[0] or 0) * anchor))
    asked = B.together(d, of, (ANCHORS, hits)).mapInArrow(again, B.QUESTION)
    verdict = B.answered(asked, elsewhere, "passages", second=True)
    return B.together(d, of, (ANCHORS, hits), (PASSAGES, verdict)).mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
