"""Operator 8: near-duplicate vectors by E8 lattice hashing.

Unit vectors are projected at random to blocks of eight dimensions and decoded to the nearest E8 lattice
point; the label, the table and the points of all blocks make a bucket key.  Several tables are used,
and in each one a vector also enters the nearest neighbouring cells.  Vectors sharing a key become
candidates; each candidate cluster is verified exactly by cosine in double precision (see ``blocks``).

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components, and vectors with
a NULL label, link to nothing; vectors of different lengths are never compared; equal vectors of a
label are compared once and linked to each other; repeated rows count as copies; rows that share a vec_id but
not the vector have their own results; labels that are no integers are compared by a 64-bit hash of their text; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import candidate_clusters, chunk_pairs, summarise, verify
from .common import mix, read, staged

THRESHOLD = 0.98
TABLES, BLOCKS, PROBES, SCALE = 8, 2, 2, 0.6


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors: two entries +-1, or all +-1/2 with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i + 1, 8):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        s = np.array([-1 if bits >> k & 1 else 1 for k in range(8)])
        if (s < 0).sum() % 2 == 0:
            out.append(s / 2)
    return np.array(out)


_ROOTS = e8_roots()


def _d8(y: np.ndarray) -> np.ndarray:
    """Nearest point of D8 (integer vectors with an even sum)."""
    r = np.rint(y)
    odd = np.flatnonzero(r.sum(axis=1) % 2)
    k = np.argmax(np.abs(y - r)[odd], axis=1)
    r[odd, k] += np.where(y[odd, k] >= r[odd, k], 1, -1)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point of each row: the better of D8 and D8 + 1/2."""
    a, b = _d8(y), _d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def _cells(y: np.ndarray, probes: int) -> np.ndarray:
    """(rows, 1 + probes, 8): the own cell and the nearest neighbouring ones, doubled to integers."""
    own = nearest_e8(y)
    near = np.argpartition(-((y - own) @ _ROOTS.T), probes, axis=1)[:, :probes] if probes else np.zeros((len(y), 0), int)
    return np.rint(2 * np.concatenate([own[:, None], own[:, None] + _ROOTS[near]], axis=1)).astype(np.int64)


def lattice_keys(x: np.ndarray, label: np.ndarray, tables: int = TABLES, blocks: int = BLOCKS,
                 probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """(rows, tables * (1 + blocks * probes)) bucket keys of unit vectors."""
    rows, dim = x.shape
    mult = np.random.default_rng(88).integers(1, 1 << 62, size=8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for t in range(tables):
        y = x @ (np.random.default_rng([t, dim]).standard_normal((dim, 8 * blocks)) * scale)
        code = []
        for b in range(blocks):
            c = _cells(y[:, 8 * b:8 * b + 8], probes).astype(np.uint64)
            code.append(mix((c * mult).sum(axis=2, dtype=np.uint64) + np.uint64(b + 1)))
        seed = mix(label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t * 4096 + dim))
        own = sum((c[:, 0] for c in code), seed)
        keys = [own]
        for c in code:                                   # one block moves to a neighbouring cell
            keys += [own - c[:, 0] + c[:, k] for k in range(1, 1 + probes)]
        out += keys
    return mix(np.stack(out, axis=1)).view(np.int64)


def _keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, node (class of equal vectors in a label), size, data (float64 bytes), keys; NULL but for the id in rows
    that link with nothing."""
    schema = "vec_id long, node long, size long, data binary, keys array<long>"
    names = ["vec_id", "node", "size", "data", "keys"]

    def run(batches):
        for b in batches:
            lab = b.column(2)
            vec = b.column(1).cast(pa.large_list(pa.float64()))
            ids, labels, lists = b.column(0).to_pylist(), lab.to_pylist(), vec.to_pylist()
            by_dim: dict[int, list] = {}
            usable: set[int] = set()
            for i, v in enumerate(lists):
                if v and labels[i] is not None and not any(z is None for z in v):
                    by_dim.setdefault(len(v), []).append(i)
            for dim, rows in by_dim.items():
                x = np.array([lists[i] for i in rows], dtype=np.float64)
                ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                rows, x = [r for r, o in zip(rows, ok) if o], x[ok] + 0.0        # -0.0 becomes 0.0
                if not rows:
                    continue
                usable.update(rows)
                # by its largest component first, so that very large or small vectors keep their direction
                unit = x / np.abs(x).max(axis=1, keepdims=True)
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                label = np.array([labels[i] for i in rows], dtype=np.int64)
                bits = x.view(np.uint64)
                powers = np.cumprod(np.full(dim, 0xD6E8FEB86659FD93, dtype=np.uint64))
                node = mix((mix(bits) * powers).sum(axis=1, dtype=np.uint64)
                           + mix(label.astype(np.uint64) + np.uint64(dim << 40))).view(np.int64)
                keys = lattice_keys(unit, label)
                k = keys.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in rows], pa.int64()), pa.array(node),
                     pa.array(np.full(len(rows), dim), pa.int64()), pa.array([u.tobytes() for u in unit], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(keys.reshape(-1)))],
                    names=names)
            rest = [ids[i] for i in range(len(ids)) if i not in usable]
            yield pa.RecordBatch.from_arrays([pa.array(rest, pa.int64()), *[pa.nulls(len(rest), t) for t in (
                pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))]], names=names)

    return vectors.mapInArrow(run, schema)


def cosine_links(threshold: float):
    def linked(data: list[bytes]) -> np.ndarray:
        width = [len(d) for d in data]
        out = np.zeros((len(data), len(data)), dtype=bool)
        for w in set(width):
            at = np.flatnonzero(np.array(width) == w)
            x = np.stack([np.frombuffer(data[i], dtype=np.float64) for i in at])
            out[np.ix_(at, at)] = x @ x.T >= threshold
        return out
    return linked


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors(vec_id, embedding, label)``."""
    whole = isinstance(vectors.schema["label"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    label = F.col("label").cast("long") if whole else F.when(F.col("label").isNotNull(), F.xxhash64(F.col("label").cast("string")))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                       label.alias("label"))
    keyed = staged(_keyed(v), "e8-keyed")
    nodes = staged(keyed.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("size").alias("size"),
        F.first("data").alias("data"), F.first("keys").alias("keys")), "e8-nodes")
    clusters = candidate_clusters(nodes.select("node", F.explode("keys").alias("key")), "e8-cand")
    items = staged(clusters.join(nodes, "node").select("root", "node", "size", F.col("n_copies").alias("weight"), "data"),
                   "e8-items")
    links = verify(chunk_pairs(items, items.select("root", "size"), 1024, 1 << 20), cosine_links(threshold))
    per_node = summarise(nodes.select("node", "first_id", "n_copies", F.lit(False).alias("alone")), links, "e8")
    out = keyed.select("vec_id", "node").join(per_node, "node", "left")
    comp = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.alias("component_id"), F.col("vec_id").eqNullSafe(comp).alias("kept"))


def op8_lattice(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))
