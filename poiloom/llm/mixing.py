"""Mixing sources to target weights by systematic sampling.

Each source gets a target in words. A document's expected copies are its source's target
over its source's size; the documents of a source stand in order of size, their expected
copies are summed up along that order, one random offset per source is added, and a
document is emitted once for each integer that its stretch of the sum crosses. Standing in
order of size makes the words taken come near the target, as each stretch of the order
gives its share. The offset is a hash of the seed and the source's name, so reruns agree
and other seeds give other samples.

Sources may be many (hosts, say): their sizes stay in tables, targets come from rounds of
sums over them, of which the driver sees two numbers.

Defined cases: a null text has size 0; a null source is a source of its own, the last one;
a source of size 0 has target 0 and takes nothing; repeated rows count each; an empty table
gives an empty result; a text of any length is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poiloom.llm.common import n_words, own_names, ranked, spread_join, stored

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: No source's target, and no document's words taken, exceed so many times its own size.
MOST = 3
#: Hexadecimal digits of a hash that make an offset: a sum of whole numbers and such an offset is exact.
OFFSET_DIGITS = 5
SEED = 20240229


def offset(source: Column, seed: int) -> Column:
    """The random offset of a source in [0, 1), a multiple of 16 ** -OFFSET_DIGITS."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, OFFSET_DIGITS), 16, 10).cast("double") / float(16**OFFSET_DIGITS)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes (name, source_size, rows) with target: the total shared by weight, none above most times its size.

    What is cut off is shared again by weight among the others until none is above: a round
    finds the sources that are above, and sums up what they get and weigh. A share only
    grows from round to round, so a source that was above once stays so.
    """
    place = F.array(*map(F.lit, weights))
    weighed = ranked(sizes.withColumn("_last", F.col("name").isNull().cast("int")).withColumn("_all", F.lit(0)), "_all", ["_last", "name"], "sources")
    weighed = stored(weighed.select("name", "source_size", "rows", F.get(place, F.pmod("group_rank", F.lit(len(weights))).cast("int")).cast("long").alias("weight")), "weights")
    size, weight = F.col("source_size").cast("decimal(38,0)"), F.col("weight").cast("decimal(38,0)")
    total, weight_sum = (int(x or 0) for x in weighed.agg(F.sum(size), F.sum(weight)).first())
    left, shared, above = total, weight_sum, F.lit(False)
    while shared:
        # left * weight / shared > most * size
        above = F.lit(left).cast("decimal(38,0)") * F.col("weight") > size * F.lit(most) * F.lit(shared)
        got, gone = (int(x or 0) for x in weighed.where(above).agg(F.sum(size) * most, F.sum(weight)).first())
        if (total - got, weight_sum - gone) == (left, shared):
            break
        left, shared = total - got, weight_sum - gone
    goal = F.when(above, F.col("source_size") * F.lit(float(most))).otherwise(F.lit(float(left)) * F.col("weight") / F.lit(float(max(shared, 1))))
    return weighed.select("name", "source_size", "rows", goal.alias("target"))


def mix(df: DataFrame, source: str = "source", size: str = "size", order: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """df with source_size, target (of its source, double) and copies (long, 0 to MOST).

    Three steps: sizes by source; the rows dealt out by range of (source, size, order), which
    gives each its rank within its source; copies from rank, rate and offset. The same rows
    and seed give the same copies, however they are partitioned.
    """
    sums = df.groupBy(F.col(source).alias("name")).agg(F.coalesce(F.sum(size), F.lit(0)).alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goals = stored(targets(stored(sums, "source-sizes"), weights).withColumn("_offset", offset(F.col("name"), seed)).withColumnRenamed("name", source), "targets")
    found = spread_join(ranked(df, source, [size, *order], "mix"), goals, [source], "rows", goals.agg(F.sum("rows")).first()[0] or 0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))

    def crossed(rank):
        return F.floor(rank.cast("double") * rate + F.col("_offset"))

    rank = F.col("group_rank")
    return found.withColumn("copies", crossed(rank + 1) - crossed(rank)).drop("_offset", "group_rank")


def mix_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document; sizes in words."""
    d = own_names(docs, "doc_id", "source", "text")
    sized = stored(d.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, with docs' columns: each as often as it is emitted, some not at all.

    Only ids, sizes and hashes of whole rows are ranked; the numbers of copies then go back to
    the rows by hash. Rows that are equal in all columns share one number: of these one
    stands for all.
    """
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    whole = F.struct(*[docs[c] for c in docs.columns])
    keyed = docs.select(*[docs[c].alias(v) for c, v in own.items()], F.xxhash64(F.lit(1), whole).alias("_k1"), F.xxhash64(F.lit(2), whole).alias("_k2"))
    sized = keyed.select(F.col(own["doc_id"]).alias("doc_id"), F.col(own["source"]).alias("source"), n_words(F.col(own["text"])).alias("size"), "_k1", "_k2")
    rows = F.count(F.lit(1))
    copies = stored(mix(stored(sized, "mix-rows"), order=("doc_id", "_k1", "_k2")).groupBy("_k1", "_k2").agg(F.sum("copies").alias("_copies"), rows.alias("_rows"), rows.alias("_times")), "mix-copies")
    found = spread_join(keyed, copies, ["_k1", "_k2"], "_rows", copies.agg(F.sum("_rows")).first()[0] or 0).where("_copies > 0")
    single = found.where("_times = 1")
    # equal rows: the first that comes is as good as any
    kept = [F.first(v).alias(v) for v in own.values()]
    again = found.where("_times > 1").groupBy("_k1", "_k2").agg(*kept, F.first("_copies").alias("_copies"))
    both = single.select(*own.values(), "_copies").unionByName(again.select(*own.values(), "_copies"))
    return both.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*[F.col(v).alias(c) for c, v in own.items()])
