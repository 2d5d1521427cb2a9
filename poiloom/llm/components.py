"""Connected components of an edge table, by rounds of large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from poiloom.llm.common import spread_join, stored

#: Edges that one task joins by itself, in some 100 MB; more are joined by rounds.
LOCAL_EDGES = 1 << 18


def _local(e: DataFrame) -> DataFrame:
    """Rows (node, root) of at most LOCAL_EDGES edges, in one task."""
    kind, arrow = e.schema["u"].dataType.simpleString(), to_arrow_type(e.schema["u"].dataType)

    def join(batches):
        root: dict = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        names, struct = [], pa.types.is_struct(arrow)
        for batch in batches:
            for pair in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                if struct:
                    names = list(pair[0])
                    pair = tuple(tuple(x.values()) for x in pair)
                a, b = sorted(map(find, pair))
                root[b] = a
        nodes = sorted(root)
        found = [nodes, [find(x) for x in nodes]]
        if struct:
            found = [[dict(zip(names, x, strict=True)) for x in xs] for xs in found]
        yield pa.RecordBatch.from_arrays([pa.array(xs, arrow) for xs in found], names=["node", "root"])

    return e.coalesce(1).mapInArrow(join, f"node {kind}, root {kind}")


def _large(e: DataFrame, total: int) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest node around it."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    return spread_join(both, least, ["u"], "n", 2 * total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame, total: int) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    least = stored(e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    tied = spread_join(e, least, ["u"], "n", total).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Stored rows (node, root) for every node of edges (u, v); root is the component's smallest node.

    Nodes are of any type that has an order. At most LOCAL_EDGES edges are joined in one task,
    without rounds. Rounds grow with the logarithm of a component's longest path. A node with very many edges is a hot key of small rows: those are not
    gathered, the node's one row goes to them.
    """
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if e.count() <= LOCAL_EDGES:
        return stored(_local(e), "components")
    before = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
        e = stored(_small(stored(_large(e, now[0]).distinct(), "large"), now[0]), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stored(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "components")
