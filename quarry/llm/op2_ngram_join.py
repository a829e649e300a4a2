"""Operator 2: n-gram Jaccard join by MinHash banding.

Whole texts are lower-cased and split at ASCII white space into words; the set of their five-word
shingles (all words, when there are fewer) is compared by Jaccard similarity, 0.8 or more is a link.
Rows and bands follow from the wanted recall at the threshold.  Equal texts form one class first, so
copies are compared once; band hashes are shuffled, texts sharing one become candidates, and every
candidate cluster, or each of its buckets where that moves fewer rows, is verified exactly on full shingle
sets (see ``blocks``).

Edge cases: NULL, empty or blank text has no shingles and links to nothing; repeated rows count as
copies; NULL doc_ids take part and sort first as class ids only if all members are NULL; ties cannot
occur (class ids are minima); a very long text is shingled whole, in one task;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import candidate_clusters, placed, spread, summarise, verify
from .common import fresh, hash_family, hash_words, member_filter, min_hash, mix, read, shingles, staged, text_chunks, text_or_empty

THRESHOLD, WORDS = 0.8, 5


def choose_bands(threshold: float = THRESHOLD, recall: float = 0.999, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands reach ``recall`` at ``threshold`` within the hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("recall is out of reach with so few hashes")
    return best


def _shingled(texts: pa.Array, n: int, rows: int = 256):
    for lo in range(0, len(texts), rows):              # lower-cased in small slices to keep memory flat
        for first, data, off in text_chunks(pc.utf8_lower(texts.slice(lo, rows))):
            yield lo + first, *shingles(*hash_words(data, off), n)
    pa.default_memory_pool().release_unused()


def _signed(docs: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    mults = hash_family(bands * rows, seed=2)

    def run(batches):
        weights = hash_family(rows, seed=3)
        for b in batches:
            size, keys = [], []
            for _, h, off in _shingled(b.column(2), n):
                sig = min_hash(h, off, mults).astype(np.uint64).reshape(len(off) - 1, bands, rows)
                keys.append(mix((sig * weights).sum(axis=2, dtype=np.uint64)
                                + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
                size.append(np.diff(off))
            num = np.concatenate(size) if size else np.zeros(0, np.int64)
            flat = np.concatenate(keys).reshape(-1) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(num) + 1) * bands, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(num, pa.int64()), lists],
                                             names=["doc_id", "node", "n", "bands"])

    return docs.mapInArrow(run, "doc_id long, node long, n long, bands array<long>")


def _sets(rows: DataFrame, n: int) -> DataFrame:
    """Rows ending in a text -> the same with the text's sorted distinct shingle hashes as bytes (``data``)."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 128):               # sets are larger than texts: few at once
                part = b.slice(lo, 128)
                data = []
                for _, h, off in _shingled(part.column(part.num_columns - 1), n):
                    data += [np.unique(h[s:e]).tobytes() for s, e in zip(off, off[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(data, pa.binary())], names=names)

    names = [*rows.columns[:-1], "data"]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("data", T.BinaryType())]))


def jaccard_links(threshold: float):
    """Exact link matrix of shingle sets given as bytes."""
    def linked(data: list[bytes]) -> np.ndarray:
        sets = [np.frombuffer(d, dtype=np.uint64) for d in data]
        size = np.array([len(s) for s in sets], dtype=np.float64)
        m = len(sets)
        value, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(m), size.astype(int))
        shared = np.flatnonzero(count > 1)                     # others meet in no pair
        new = np.full(len(value), -1)
        new[shared] = np.arange(len(shared))
        col = new[at]
        row, col = row[col >= 0], col[col >= 0]
        both, step = np.zeros((m, m), dtype=np.float64), 4096
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        for lo in range(0, len(shared), step):
            s, e = np.searchsorted(col, [lo, lo + step])
            x = np.zeros((m, min(step, len(shared) - lo)), dtype=np.float32)
            x[row[s:e], col[s:e] - lo] = 1
            both += x @ x.T
        union = size[:, None] + size[None, :] - both
        return (both >= threshold * union) & (both > 0)
    return linked


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, recall: float = 0.999,
                 max_items: int = 512) -> DataFrame:
    """One row per document: doc_id, node (its text's class), n_copies, component_id, n_links, kept.

    ``max_items`` texts (or 1024 shingles for each of them) make a chunk of a comparison.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    d = d.select("doc_id", F.xxhash64("text").alias("node"), "text")
    signed = staged(_signed(d, *choose_bands(threshold, recall), n), "jac-signed")
    nodes = staged(signed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"),
                                              F.first("n").alias("n"), F.first("bands").alias("bands")), "jac-nodes")
    clusters = candidate_clusters(nodes.where("n > 0").select("node", F.explode("bands").alias("key")), "jac-cand")
    members = staged(clusters.join(nodes, "node").select(
        "root", "node", F.col("first_id").alias("doc_id"), F.col("n").alias("size"), F.col("n_copies").alias("weight"),
        F.col("bands").alias("keys")), "jac-members")
    spots = staged(placed(members, max_items, max_items << 10, "jac").select(
        "node", "doc_id", "weight", F.when(F.col("split"), F.col("keys")).alias("keys"), "spots"), "jac-spots")
    near = member_filter(members)
    # a text's first id picks its row; repeated rows go by the join's own keys, before their sets are made
    plain = lambda df, *more: df.select("node", F.coalesce("doc_id", F.lit(0)).alias("id"),
                                        F.col("doc_id").isNull().alias("none"), *more)
    texts = plain(d.where(near("node")), "text").join(plain(spots, "weight", "keys", "spots"), ["node", "id", "none"])
    texts = texts.dropDuplicates(["node", "id", "none"]).select("node", "weight", "keys", "spots", "text")
    links = verify(spread(_sets(texts, n)), jaccard_links(threshold))
    per_node = summarise(nodes.select("node", "first_id", "n_copies", (F.col("n") == 0).alias("alone")), links, "jac")
    res = per_node.join(nodes.select("node", "n_copies"), "node")
    out = signed.select("doc_id", "node").join(res, "node")
    comp = F.coalesce("component", "doc_id")
    return out.select("doc_id", "node", "n_copies", comp.alias("component_id"), "n_links",
                      F.col("doc_id").eqNullSafe(comp).alias("kept"))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """``docs`` with one document of each group of linked texts; repeated rows of it stay once.

    The join and the removal of repeated rows use the same plain keys, so whole texts are shuffled once.
    """
    keys = fresh(docs.columns, "jac_id", "jac_null", "jac_h")
    num = F.col("doc_id").cast("long")

    def keyed(df: DataFrame, h) -> DataFrame:
        return df.withColumns(dict(zip(keys, [F.coalesce(num, F.lit(0).cast("long")), num.isNull(), h])))

    kept = staged(keyed(jaccard_join(docs, threshold, n).where("kept"), F.col("node")).select(*keys).distinct(), "jac-kept")
    d = keyed(docs, F.xxhash64(text_or_empty())).join(kept, keys, "left_semi")
    return d.dropDuplicates(keys).select(*docs.columns)


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("component_id").alias("class_id"), "n_copies", "n_links", "kept")
