"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents become ids, longer ones are cut into pieces, the histogram of piece lengths (at
most `capacity` counts) goes to the driver, which solves the configuration linear program
(config_lp.py). What comes back is a table of slots per length; a piece takes the slot of
its rank among the pieces of its length. Texts never move between executors.

Defined cases: a null text is an empty one and gives one piece, the closing id alone;
repeated rows each give their pieces; an empty table gives no piece.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poiloom.llm.common import own_names, process_cache, ranked, small_batches, stored
from poiloom.llm.config_lp import Plan, pack

#: Longest sequence, in ids, and the id that closes a document.
CAPACITY = 4096
CLOSE = 1
#: Words whose ids a worker remembers; it forgets all of them when there are more.
REMEMBERED = 400_000


#: Words that the tokenizer's rules take as letters, then symbols: Latin letters that normalize to themselves.
SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordIds(dict):
    """Ids of a word between blanks, as little-endian unsigned 32-bit numbers.

    Letters with symbols behind them go straight to the model, which is some times faster;
    all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {"": b""}
        self.names = byte_names()
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        # the direct way holds for the rules it was written for: lower case, split into letters and symbols, byte level
        self.direct = "Lowercase" in json.dumps(rules["normalizer"]) and r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in json.dumps(rules["pre_tokenizer"])

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            if len(self.parts) >= REMEMBERED:
                self.parts = {"": b""}
            ids = [t.id for t in self.model.tokenize(text if text.isascii() else "".join(map(self.names.__getitem__, text.encode())))]
            found = self.parts[text] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if self.direct and (m := SIMPLE.fullmatch(text)):
            found = self.part(m[1].lower()) + self.part(m[2])
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece.

    tokenizer: path of a tokenizers file that drops white space, on every executor.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        ids_of = process_cache(f"word_ids:{tokenizer}", lambda: WordIds(tokenizer)).__getitem__
        close = struct.pack("<I", CLOSE)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                text = text.as_py()
                ids = b"".join([*map(ids_of, text.encode().split()), close]) if text else close
                for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[s : s + 4 * capacity]
                    at.append(row)
                    piece.append(k)
                    start.append(s // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return own_names(docs, "doc_id", "text").mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def slots(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: where each run of slots begins, its first sequence, copies in a sequence, and place of the first copy."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, parts in zip(plan.times, plan.contents, strict=True):
        place = 0
        for length, copies in parts:
            runs.setdefault(length, []).append((used.get(length, 0), sequence, copies, place))
            used[length] = used.get(length, 0) + times * copies
            place += length * copies
        sequence += times
    return {k: tuple(np.array(x, dtype=np.int64) for x in zip(*v, strict=True)) for k, v in runs.items()}


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset: no sequence is longer than capacity, none has gaps."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = pieces.columns
    shared = spark.sparkContext.broadcast(slots(pack(counts, capacity)))
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    found = ranked(pieces, "length", ["doc_id", "piece"], "packed").select(*kept, "group_rank")

    def put(batches):
        table = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("group_rank").to_numpy()
            sequence, place = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for one in np.unique(length):
                here = length == one
                begin, first, copies, base = table[int(one)]
                run = np.searchsorted(begin, rank[here], side="right") - 1
                nth = rank[here] - begin[run]
                sequence[here] = first[run] + nth // copies[run]
                place[here] = base[run] + nth % copies[run] * one
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(place)], names=[*kept, "sequence_id", "offset"])

    return found.mapInArrow(put, out)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs."""
    return place_pieces(stored(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)
