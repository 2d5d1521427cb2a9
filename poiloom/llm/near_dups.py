"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the bag of its runs of WIDTH words; how often a run occurs is its weight.

1. Every run sends points of a Poisson process with its weight as rate, at times that only
   the run and the point's number determine, each to a random register; the earliest point
   in a register names its run. Two documents agree in a register with the probability
   Jaccard similarity of their bags. Points are made up to a time by which all registers
   should be filled; runs go on later only in documents where one is still empty. So most
   runs of a long document stop at their first point.
2. Documents of equal words are one class from the start, its smallest id stands for it.
   Registers are cut into bands; documents that share a band's registers are candidates.
3. Candidates are verified on whole texts: probability Jaccard, or that of plain sets, of
   ALIKE or more. In each bucket all are first compared with two leaders; the links make
   classes. Links between classes that meet in a bucket are then looked for by rare runs
   (untried_pairs). So a class of n copies costs some n comparisons, and no link between
   classes is lost.
4. Classes are connected components of links.

A node is an id together with a hash of its text, so rows with equal ids and different texts
are documents of their own. No key's rows are gathered in one task: a bucket that many
documents share, a leader of many and a node of many links get their one row to where the
others are (common.spread_join), and a leader's text goes once to each chunk of its partners.

Defined cases: a null text has no words; texts of 1 to WIDTH - 1 words are one run; texts
without words are equal; a text of any length is compared as a whole, in one task; ids are of
any type that has an order; rows with equal ids and texts are one document; a null id is left
without class (null); an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poiloom.llm import words as W
from poiloom.llm.common import own_names, small_batches, spread_join, stored
from poiloom.llm.components import components

WIDTH, ALIKE = 5, 0.8
#: 1 - (1 - 0.8 ** ROWS) ** BANDS: one pair of 20,000 with probability Jaccard 0.8 shares no band; for set Jaccard that doesn't hold.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Bits of a run's name that make room for the document's number within a batch.
DOC_BITS = 16
#: Points are first made up to the time REGISTERS * (ln REGISTERS + SPARE) / weight: one register in
#: exp(SPARE) documents is still empty then.
SPARE = 3.0
#: Partners in a chunk that gets its leader's text once, and the most chunks of a leader.
CHUNK, MOST_CHUNKS = 256, 4096
#: Bits of the fixed-size filter that keeps unneeded texts out of the verification's shuffle.
FILTER_BITS = 23


def bags(lists: list[list[bytes]], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, run and weight of each distinct run; documents in order."""
    n = np.array([len(x) for x in lists], dtype=np.int64)
    begin = W.starts(n)
    h = W.hashes(w for x in lists for w in x)
    doc = np.repeat(np.arange(len(n)), n)
    whole = W.inside(begin, width)
    runs, of = W.windows(h, width)[whole], doc[: len(whole)][whole]
    for i in np.flatnonzero((n > 0) & (n < width)):
        runs = np.append(runs, W.windows(h[begin[i] : begin[i + 1]], int(n[i])))
        of = np.append(of, i)
    bits = DOC_BITS  # fixed: a run's name must not depend on the batch
    if len(n) > 1 << bits:
        raise ValueError(f"more than {1 << bits} documents at once")
    keys = np.sort((of.astype(np.uint64) << np.uint64(64 - bits)) | (runs >> np.uint64(bits)))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    weight = np.diff(np.concatenate([first, [len(keys)]]))
    keys = keys[first]
    return (keys >> np.uint64(64 - bits)).astype(np.int64), keys << np.uint64(bits), weight


def signatures(doc: np.ndarray, run: np.ndarray, weight: np.ndarray, total: int, registers: int = REGISTERS) -> np.ndarray:
    """The run that holds each register of each of total documents; 0 throughout for one without runs."""
    held = np.full(total * registers, np.inf)
    points: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    mass = np.bincount(doc, weights=weight, minlength=total)
    until = registers * (math.log(registers) + SPARE) / np.maximum(mass, 1)
    run, rate = W.mixed(run + W.ODD), weight.astype(float)
    time = np.zeros(len(run))
    nth = np.zeros(len(run), dtype=np.uint64)

    def next_time(r, k, w):
        u = (W.mixed(r + (np.uint64(2) * k + np.uint64(1)) * W.ODD) >> np.uint64(11)).astype(float) + 0.5
        return -np.log(u / 9007199254740992.0) / w

    time += next_time(run, nth, rate)
    waiting = (doc, run, rate, time, nth)
    while True:
        at, late = waiting, []
        while True:
            d, r, w, t, k = at
            on = t < until[d]
            late.append(tuple(x[~on] for x in at))
            if not on.any():
                break
            d, r, w, t, k = (x[on] for x in at)
            slot = d * registers + (W.mixed(r + (np.uint64(2) * k + np.uint64(2)) * W.ODD) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(held, slot, t)
            points.append((slot, t, r))
            k = k + np.uint64(1)
            at = (d, r, w, t + next_time(r, k, w), k)
        open_ = np.isinf(held.reshape(total, registers)).any(axis=1) & (mass > 0)
        if not open_.any():
            break
        until[open_] *= 1.5
        waiting = tuple(np.concatenate(x) for x in zip(*late, strict=True))
        on = open_[waiting[0]]
        waiting = tuple(x[on] for x in waiting)
    found = np.zeros(total * registers, dtype=np.uint64)
    for slot, t, r in points:
        won = held[slot] == t
        found[slot[won]] = r[won]
    return found.reshape(total, registers)


def band_keys(found: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each document."""
    cut = found.reshape(len(found), BANDS, ROWS)
    return W.mixed(W.windows(cut, ROWS)[..., 0] + np.arange(BANDS, dtype=np.uint64) * W.ODD).view(np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of probability Jaccard and set Jaccard of two bags (runs ascending, weights)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    every = len(a[0]) + len(b[0]) - len(both)
    if not every:
        return 1.0
    plain = len(both) / every
    if not len(both) or ((a[1] == 1).all() and (b[1] == 1).all()):
        return plain
    wa, wb = np.concatenate([a[1], np.zeros(len(b[0]) - len(both))]), np.zeros(every)
    wb[i] = b[1][j]
    wb[len(a[0]) :] = np.delete(b[1], j)
    total = 0.0
    pairs, times = np.unique(np.stack([wa[i], wb[i]]), axis=1, return_counts=True)
    for x, y, n in zip(*pairs, times, strict=True):
        total += n / np.maximum(wa / x, wb / y).sum()
    return max(plain, total)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    _, run, weight = bags([W.split(text)])
    return run, weight


def with_node(docs: DataFrame) -> DataFrame:
    """node (id and hash of the text) and text of the documents that have an id."""
    return own_names(docs, "doc_id", "text").where("doc_id is not null").select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash")).alias("node"), "text")


def signed(docs: DataFrame) -> DataFrame:
    """node, h1, h2 (of its words in order), keys (of its bands) of every document."""
    small_batches(docs.sparkSession)
    d = with_node(docs)

    def sign(batches):
        from xxhash import xxh3_128_digest

        for batch in batches:
            lists = [W.split(t) for t in batch.column(1).to_pylist()]
            same = np.frombuffer(b"".join(xxh3_128_digest(b" ".join(x)) for x in lists), dtype="<i8").reshape(-1, 2)
            keys = band_keys(signatures(*bags(lists), len(lists))) if lists else np.zeros((0, BANDS), dtype=np.int64)
            some = np.array([len(x) > 0 for x in lists], dtype=bool)
            ends = np.concatenate([[0], np.cumsum(some * BANDS)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(same[:, 0].copy()), pa.array(same[:, 1].copy()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[some].ravel()))], names=["node", "h1", "h2", "keys"]
            )

    return d.mapInArrow(sign, f"node {d.schema['node'].dataType.simpleString()}, h1 long, h2 long, keys array<long>")


def needed_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of the documents in nodes (node). Most others are kept out before the shuffle, by a filter of fixed size."""
    place = F.xxhash64("node").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = nodes.select(F.shiftright(place, 6).alias("w"), F.expr("shiftleft(1L, cast(xxhash64(node) & 63 as int))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    # at most 2 ** (FILTER_BITS - 6) rows
    maybe = with_node(docs).withColumn("w", F.shiftright(place, 6)).join(F.broadcast(words), "w").where("(bits & shiftleft(1L, cast(xxhash64(node) & 63 as int))) <> 0")
    return maybe.join(nodes, "node", "left_semi").select("node", "text").dropDuplicates(["node"])


def verified(docs: DataFrame, pairs: DataFrame, alike: float = ALIKE) -> DataFrame:
    """pairs (u, v) with linked: whether their texts are alike.

    Of a pair the document with more partners is the leader, the other one its partner.
    Partners are dealt out in chunks; a chunk gets its leader's text once, and a partner's
    text as often as it has leaders.
    """
    both = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node")))
    needed = stored(both.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "needed")
    texts = stored(needed_texts(docs, needed.select("node")), "texts")
    total = needed.agg(F.sum("n")).first()[0] or 0
    of_u = spread_join(pairs.select("u", "v"), needed.select(F.col("node").alias("u"), "n", F.col("n").alias("n_u")), ["u"], "n", total)
    of_both = spread_join(of_u, needed.select(F.col("node").alias("v"), "n", F.col("n").alias("n_v")), ["v"], "n", total)
    u_leads = (F.col("n_u") > F.col("n_v")) | ((F.col("n_u") == F.col("n_v")) & (F.col("u") < F.col("v")))
    most = F.greatest("n_u", "n_v")
    chunks = F.least(F.ceil(most / CHUNK), F.lit(MOST_CHUNKS))
    dealt = of_both.select(F.when(u_leads, F.col("u")).otherwise(F.col("v")).alias("leader"), F.when(u_leads, F.col("v")).otherwise(F.col("u")).alias("node"), chunks.alias("chunks"))
    dealt = stored(dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int")).drop("chunks"), "dealt")
    partners = dealt.join(texts, "node").select("leader", "chunk", F.lit(1).alias("kind"), "node", "text")
    leaders = dealt.select(F.col("leader").alias("node"), "chunk").distinct().join(texts, "node").select(F.col("node").alias("leader"), "chunk", F.lit(0).alias("kind"), "node", "text")
    rows = leaders.unionByName(partners).repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", "kind")
    kind = pairs.schema["u"].dataType.simpleString()

    def compare(batches):
        own = None
        for batch in batches:
            out, at = [], []
            for i, (what, text) in enumerate(zip(batch.column("kind").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if not what:
                    own = bag(text)  # a leader comes before its chunk's partners
                else:
                    at.append(i)
                    out.append(likeness(bag(text), own) >= alike - 1e-12)
            part = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("leader"), part.column("node"), pa.array(out, pa.bool_())], names=["a", "b", "linked"])

    found = rows.mapInArrow(compare, f"a {kind}, b {kind}, linked boolean")
    return stored(found.select(*ordered("a", "b"), "linked"), "verified")


def ordered(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def band_members(own: DataFrame) -> DataFrame:
    """key, node, n (members of the key's bucket) and the bucket's leaders a (smallest node) and b.

    b is the member with most companions in all its buckets: of an original and its edited
    copies that is the original, near which most others are.
    """
    sizes = stored(own.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").withColumn("n", F.col("rows")), "buckets")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    shared = stored(spread_join(own, sizes, ["key"], "rows", total).where("n is not null"), "shared-bands")
    companions = shared.groupBy("node").agg(F.sum("n").alias("companions"))
    most = F.min(F.struct((-F.col("companions")).alias("c"), "node"))["node"]
    lead = shared.join(companions, "node").groupBy("key").agg(F.min("node").alias("a"), most.alias("b"), F.count(F.lit(1)).alias("rows"))
    return stored(spread_join(shared, stored(lead, "leaders"), ["key"], "rows", total), "members")


def untried_pairs(docs: DataFrame, members: DataFrame, classes: DataFrame, alike: float) -> DataFrame:
    """Pairs (u, v) of different classes among which every link between classes that share a bucket is.

    Only buckets of three or more can hold a pair that no leader was in: in one of three the
    smallest id may be both leaders. Of two linked documents that of the smaller class looks for the other one: at most a certain number of
    its runs is missing in the other, so among one more of them, whichever, there is a common
    one. It takes those that are rarest outside its class. What makes an edited copy too
    unlike its original is its own runs, and they are rare: few pairs come of it, however
    many copies meet in a bucket.
    """
    placed = members.where("n >= 3").join(classes, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "placed")
    mixed = stored(placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("rows")).where("low <> high").select("key", "rows", F.lit(True).alias("mixed")), "mixed")
    open_ = stored(spread_join(placed, mixed, ["key"], "rows", mixed.agg(F.sum("rows")).first()[0] or 0).where("mixed").select(F.col("node").alias("id"), "root").distinct(), "open")
    texts = needed_texts(docs, open_.select(F.col("id").alias("node"))).withColumnRenamed("node", "id")
    span = open_.groupBy("root").agg(F.count(F.lit(1)).alias("span"))
    kind = open_.schema["id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            doc, run, weight = bags([W.split(t) for t in batch.column("text").to_pylist()])
            size = np.bincount(doc, minlength=batch.num_rows)
            mass = np.bincount(doc, weights=weight, minlength=batch.num_rows).astype(np.int64)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), pa.array(run.view(np.int64)), pa.array(weight.astype(np.int64)), pa.array(size[doc].astype(np.int64)), pa.array(mass[doc])], names=["id", "run", "w", "size", "mass"])

    runs = stored(texts.mapInArrow(cut, f"id {kind}, run long, w long, size long, mass long").join(open_, "id").join(span, "root"), "runs")
    within = runs.groupBy("run", "root").agg(F.count(F.lit(1)).alias("inside"))
    whole = within.groupBy("run").agg(F.sum("inside").alias("all"), F.count(F.lit(1)).alias("roots"))
    outside = within.join(whole, "run").select("run", "root", (F.col("all") - F.col("inside")).alias("outside"))
    rare = Window.partitionBy("id").orderBy("outside", "run")
    ranked = runs.join(outside, ["run", "root"]).withColumns({"before": F.row_number().over(rare) - 1, "mass_before": F.sum("w").over(rare.rowsBetween(Window.unboundedPreceding, -1))})
    # common runs of x and y are at least alike / (1 + alike) of both sizes together
    share = alike / (1 + alike)
    longest = ((1 - share) * F.col("size") - F.col("before")) / share + 1e-6
    by_mass = F.coalesce("mass_before", F.lit(0)) <= (1 - alike) * F.col("mass") + 1e-6
    asks = ranked.where("outside > 0").select("run", F.col("id").alias("x"), F.struct("span", "root").alias("of_x"), longest.alias("longest"), by_mass.alias("by_mass"), (F.col("mass") > F.col("size")).alias("heavy_x"))
    asks = asks.where(F.col("by_mass") | (F.col("longest") >= 1))
    others = runs.select("run", F.col("id").alias("y"), F.struct("span", "root").alias("of_y"), F.col("size").alias("size_y"), (F.col("mass") > F.col("size")).alias("heavy_y"))
    near = (F.col("of_x") < F.col("of_y")) & ((F.col("size_y") <= F.col("longest")) | (F.col("by_mass") & (F.col("heavy_x") | F.col("heavy_y"))))
    return asks.join(others, (asks["run"] == others["run"]) & near).select(*ordered("x", "y")).distinct()


def node_classes(docs: DataFrame, alike: float = ALIKE) -> DataFrame:
    """node, copy_of (smallest node with the same words), root (smallest node of its class) for every row of docs that has an id."""
    sigs = stored(signed(docs), "signatures")
    copies = stored(sigs.groupBy("h1", "h2").agg(F.min("node").alias("copy_of"), F.count(F.lit(1)).alias("rows")), "copies")
    heads = sigs.join(copies.select(F.col("copy_of").alias("node")), "node", "left_semi")
    own = heads.select("node", F.explode("keys").alias("key")).distinct()
    members = band_members(own)
    first = members.select(*ordered("node", "a")).unionByName(members.select(*ordered("node", "b"))).where("u <> v").distinct()
    tried = verified(docs, stored(first, "first-pairs"), alike)
    classes = components(tried.where("linked").select("u", "v"))
    rest = stored(untried_pairs(docs, members, classes, alike).join(tried.select("u", "v"), ["u", "v"], "left_anti"), "pairs")
    if not rest.isEmpty():
        classes = components(tried.unionByName(verified(docs, rest, alike)).where("linked").select("u", "v"))
    # one row for each set of copies gets its class, then each copy gets that row
    rooted = copies.join(classes, F.col("copy_of") == F.col("node"), "left").select("h1", "h2", "rows", "copy_of", F.coalesce("root", "copy_of").alias("root"))
    return spread_join(sigs.select("node", "h1", "h2"), stored(rooted, "rooted"), ["h1", "h2"], "rows", copies.agg(F.sum("rows")).first()[0] or 0).select("node", "copy_of", "root")


def near_classes(docs: DataFrame, alike: float = ALIKE) -> DataFrame:
    """doc_id, copy_of (smallest id with the same words), class_id (smallest id of its class) of every document that has an id."""
    return node_classes(docs, alike).select(F.col("node.id").alias("doc_id"), F.col("copy_of.id").alias("copy_of"), F.col("root.id").alias("class_id"))


def first_of_class(docs: DataFrame) -> DataFrame:
    """One row of docs for each class, that of its smallest id; rows with a null id stay.

    Of rows with the same id and text one stays, whichever comes first.
    """
    nodes = stored(node_classes(docs), "classes")
    # rows that are to go, and the few documents that have several rows: most rows need neither
    gone = nodes.where("node <> root").select(F.col("node").alias("_node")).distinct()
    several = stored(nodes.where("node = root").groupBy("node").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select(F.col("node").alias("_node")), "several")
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    node = F.when(docs["doc_id"].isNotNull(), F.struct(docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("text_hash")))
    kept = docs.select(*[docs[c].alias(v) for c, v in own.items()], node.alias("_node")).join(gone, "_node", "left_anti")
    single = kept.join(several, "_node", "left_anti").select(*own.values())
    again = kept.join(several, "_node", "left_semi").groupBy("_node").agg(*[F.first(v).alias(v) for v in own.values()]).select(*own.values())
    return single.unionByName(again).select(*[F.col(v).alias(c) for c, v in own.items()])
