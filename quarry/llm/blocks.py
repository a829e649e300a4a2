"""Candidate clusters and exact block-wise verification, shared by the two similarity joins.

Items that share a bucket key are joined into candidate clusters (a star per bucket, then connected
components), so pairs are never emitted.  A cluster is cut into chunks of bounded size, each pair of
chunks is one group of a shuffle, and the pairs inside are compared as a matrix in the task; it returns
one row per item and group: how many rows it links to there and the smallest linked item.

``placed`` compares a cluster of several chunks bucket by bucket where that moves fewer rows: a long chain
of buckets (each text near the next, none near all) then costs its buckets and not its length squared.
A pair that shares several buckets counts in the first of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, staged

VERIFIED = "a long, b long, links long"


def candidate_clusters(keys: DataFrame, label: str) -> DataFrame:
    """``keys(node, key)`` -> ``(node, root)`` for the nodes that share a key with another one."""
    hot = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    stars = keys.join(hot.select("key", "lo"), "key").select(F.col("node").alias("a"), F.col("lo").alias("b"))
    return components(stars, label)


def chunk_pairs(items: DataFrame, sizes: DataFrame, max_items: int, max_size: int) -> DataFrame:
    """Add group (root, i, j) and ``mine`` (the row's own chunk) to ``items(root, node, ...)``.

    ``sizes(root, node, size)`` is the slim table of the same items (so that they are built once).

    A chunk holds about ``max_items`` items or ``max_size`` size units; an item goes to every pair of
    chunks that contains its own.
    """
    per = sizes.groupBy("root").agg(F.count(F.lit(1)).alias("_m"), F.sum("size").alias("_s"))
    per = per.select(F.col("root").alias("_root"), F.ceil(F.greatest(F.col("_m") / max_items, F.col("_s") / max_size))
                     .cast("int").alias("chunks"))
    c = items.join(per, items["root"] == per["_root"]).drop("_root")
    c = c.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")).cast("int"))
    c = c.withColumn("_o", F.explode(F.sequence(F.lit(0), F.greatest(F.col("chunks"), F.lit(1)) - 1)))
    return (c.withColumn("i", F.least("mine", "_o")).withColumn("j", F.greatest("mine", "_o")).drop("_o", "chunks"))


def placed(members: DataFrame, max_items: int, max_size: int, label: str) -> DataFrame:
    """Add ``spots`` (the groups that compare a row: root, mine, chunks) and ``split`` to ``members(root, node, size, keys)``.

    A cluster of one chunk is one group.  A larger one is ``split`` into its buckets when all their chunk pairs
    together hold fewer rows than its own; both figures are plain sums over the slim table.  Chunks of buckets
    count down from -1, so a bucket's key that equals some cluster's id is no part of that cluster.
    """
    chunks = F.greatest(F.ceil(F.greatest(F.count(F.lit(1)) / max_items, F.sum("size") / max_size)), F.lit(1)).cast("long")
    slim = members.select("root", "node", "size", "keys")
    per = staged(slim.groupBy("root").agg(F.count(F.lit(1)).alias("m"), chunks.alias("chunks")), f"{label}-clusters")
    by_key = slim.join(per.where("chunks > 1").select("root"), "root").select(
        "root", "node", "size", F.explode(F.array_distinct("keys")).alias("key"))
    per_key = staged(by_key.groupBy("root", "key").agg(F.count(F.lit(1)).alias("m"), chunks.alias("chunks")).where("m > 1"),
                     f"{label}-buckets")
    cost = per_key.groupBy("root").agg(F.sum(F.col("m") * F.col("chunks")).alias("by_key"))
    mode = staged(per.join(cost, "root", "left").select(
        "root", "chunks", F.coalesce(F.col("by_key") < F.col("m") * F.col("chunks"), F.lit(False)).alias("split")), f"{label}-mode")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks"))
    spot = lambda mine: F.struct("root", mine.alias("mine"), "chunks")
    one = slim.join(mode.where("not split"), "root").select("node", F.array(spot(own)).alias("spots"), "split")
    buckets = per_key.join(mode.where("split").select("root"), "root").select("key", "chunks")
    many = (by_key.select("node", "key").join(buckets, "key").withColumnRenamed("key", "root")
            .groupBy("node").agg(F.collect_list(spot(-1 - own)).alias("spots")).withColumn("split", F.lit(True)))   # one a bucket of the row
    return members.join(one.unionByName(many), "node")


def spread(items: DataFrame) -> DataFrame:
    """Rows with ``spots`` -> a row per chunk pair: (root, i, j, mine, ...)."""
    rest = [c for c in items.columns if c != "spots"]
    c = items.select(*rest, F.explode("spots").alias("_s")).select(
        *rest, F.col("_s.root").alias("root"), F.col("_s.mine").alias("mine"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_s.chunks") - 1)).alias("_o"))
    c = c.withColumn("_o", F.when(F.col("mine") < 0, -1 - F.col("_o")).otherwise(F.col("_o")))
    return c.withColumn("i", F.least("mine", "_o")).withColumn("j", F.greatest("mine", "_o")).drop("_o")


def first_shared(keys: np.ndarray, key: int) -> np.ndarray:
    """Pairs of rows of the bucket ``key`` that share no earlier bucket (``keys``: a row's buckets in band order)."""
    band = int(np.flatnonzero((keys == key).any(axis=0))[0])
    new = np.ones((len(keys), len(keys)), dtype=bool)
    for k in range(band):
        new &= keys[:, k, None] != keys[None, :, k]
    return new


def verify(groups: DataFrame, linked) -> DataFrame:
    """Rows (root, i, j, mine, node, weight, data, and keys where a group is a bucket) -> ``VERIFIED``.

    ``linked(list of data)`` gives the boolean matrix of links between the items.
    """
    def one(rows: list[tuple]) -> list[tuple]:
        rows = list({r[4]: r for r in rows}.values())              # repeated rows of one item
        if len(rows) < 2:
            return []
        node = np.array([r[4] for r in rows], dtype=np.int64)
        weight = np.array([r[5] for r in rows], dtype=np.int64)
        link = linked([r[6] for r in rows])
        np.fill_diagonal(link, False)
        if len(rows[0]) > 7 and rows[0][7] is not None:            # a bucket of a split cluster
            link &= first_shared(np.array([r[7] for r in rows], dtype=np.int64), rows[0][0])
        if rows[0][1] != rows[0][2]:                               # two chunks: only pairs across them
            mine = np.array([r[3] for r in rows])
            link &= mine[:, None] != mine[None, :]
        least = node.copy()
        while True:                                                # smallest node reachable in the block
            new = np.minimum(least, np.where(link, least[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (new == least).all():
                break
            least = new
        total = link @ weight
        return [(int(n), int(b), int(t)) for n, b, t, any_ in zip(node, least, total, link.any(axis=1)) if any_]

    def run(batches):
        out, held, key = [], [], None
        for b in batches:
            for lo in range(0, b.num_rows, 128):
                for row in zip(*[c.to_pylist() for c in b.slice(lo, 128).columns]):
                    if row[:3] != key:
                        out += one(held)
                        held, key = [], row[:3]
                    held.append(row)
            if len(out) > 5000:
                yield _batch(out)
                out = []
        out += one(held)
        if out:
            yield _batch(out)

    g = groups.select("root", "i", "j", "mine", "node", "weight", "data", *[c for c in groups.columns if c == "keys"])
    g = g.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return g.mapInArrow(run, VERIFIED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["a", "b", "links"])


def summarise(nodes: DataFrame, verified: DataFrame, label: str) -> DataFrame:
    """``nodes(node, first_id, n_copies, alone)`` + verified links -> (node, component, n_links).

    ``component`` is the smallest first_id of the linked nodes (NULL where ``alone``: such rows link to
    nothing, not even to their copies); n_links counts rows, the other copies of a node included.
    """
    v = staged(verified, f"{label}-links")
    tree = components(v.where("a <> b").select("a", "b").distinct(), f"{label}-parts")
    links = v.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    n = (nodes.join(links, "node", "left").join(tree, "node", "left")
         .withColumn("root", F.coalesce("root", "node")))
    n = staged(n, f"{label}-nodes")
    first = n.where("not alone").groupBy("root").agg(F.min("first_id").alias("component"))
    return staged(n.join(first, "root", "left").select(
        "node", F.when(~F.col("alone"), F.col("component")).alias("component"),
        F.when(F.col("alone"), F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links")),
        f"{label}-result")
