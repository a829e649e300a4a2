"""Shared Spark helpers of the training-data operators.

* ``staged``      -- cut lineage: write a table to the cluster's shared checkpoint folder and reread it
* ``global_rank`` -- exact 0-based ranks inside each group without sorting a group in one task
* ``components``  -- connected components of an edge table (min-label hooking + pointer jumping)
* ``hash_words``, ``shingles``, ``min_hash`` -- vectorised text hashing on Arrow buffers
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CHUNK_BYTES = 1 << 19          # text bytes hashed at once inside a task (a longer text goes alone)
INDEX_BITS = 33                # monotonically_increasing_id: partition number above, row number below


# ---- tables ---------------------------------------------------------------------------------

def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Keep Arrow batches of whole texts small; a value the session was given stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and return it reread.

    The files are shared by all executors, so losing one replays nothing that was written.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names``, each with underscores added until no column of ``taken`` is called so (in any case)."""
    used, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def global_rank(df: DataFrame, order: list[Column], group: list[str], name: str = "rank") -> DataFrame:
    """Add ``name``: the 0-based rank of each row among the rows of its ``group`` in ``order``.

    Rows are range-partitioned by (group, order), so a group holding any share of the rows is
    spread over many tasks; the only per-group work is a running sum over its *partitions*.
    NULL group values form one group.
    """
    keys = [F.col(g).asc_nulls_last() for g in group] + order
    m = f"_{name}_m"
    srt = staged(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn(m, F.monotonically_increasing_id()), name)
    srt = srt.withColumn("_pid", F.shiftright(m, INDEX_BITS)).withColumn(
        "_idx", F.col(m).bitwiseAND(F.lit((1 << INDEX_BITS) - 1)))
    part = srt.groupBy("_pid", *group).agg(F.min("_idx").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    part = part.withColumn("_off", F.sum("_n").over(w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    part = part.select("_pid", *[F.col(g).alias(f"_g_{g}") for g in group], "_lo", "_off")
    cond = srt["_pid"] == part["_pid"]
    for g in group:
        cond = cond & srt[g].eqNullSafe(part[f"_g_{g}"])
    return (srt.join(part, cond).withColumn(name, F.col("_idx") - F.col("_lo") + F.coalesce("_off", F.lit(0)))
            .select(*df.columns, name))


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components of ``edges(a, b)`` -> ``(node, root)``, root = smallest node id.

    Each round takes the smallest label among a node's neighbours (a map-side combined ``min``,
    so a hub of any degree is reduced inside the tasks) and then jumps to the label's own label.
    Every round is written to the shared folder; it ends when no label changes.
    """
    e = edges.where("a <> b").select("a", "b")
    e = staged(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), label)
    lab = staged(e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                 .select("node", F.least("node", "m").alias("root")), label)
    while True:
        near = (e.join(lab, e["b"] == lab["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m")))
        hook = lab.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "m").alias("r"))
        hook = staged(hook, label)
        up = hook.select(F.col("node").alias("r"), F.col("r").alias("rr"))
        new = staged(hook.join(up, "r").select("node", F.least("r", "rr").alias("root"),
                                               (F.least("r", "rr") != F.col("was")).alias("moved")), label)
        if new.where("moved").limit(1).count() == 0:
            return new.select("node", "root")
        lab = new.select("node", "root")


# ---- vectorised hashing on Arrow buffers ----------------------------------------------------

_B = np.uint64(0x9E3779B97F4A7C15)                       # odd, so it has an inverse mod 2^64
_BINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i mod 2^64 for i < n (kept between calls)."""
    have = _POW.get("p")
    if have is None or len(have) < n:
        m = max(n, CHUNK_BYTES * 2)
        for k, base in (("p", _B), ("q", _BINV)):
            a = np.full(m, base, dtype=np.uint64)
            a[0] = 1
            _POW[k] = np.cumprod(a)
    return _POW["p"], _POW["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = sum of (data[k] + 1) * B^k over i <= k < j."""
    p, _ = _powers(len(data) + 1)
    c = np.empty(len(data) + 1, dtype=np.uint64)
    c[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:len(data)], out=c[1:])
    return c


def range_hash(c: np.ndarray, s, e) -> np.ndarray:
    """Hash of data[s:e]: the same bytes give the same value wherever they stand."""
    _, q = _powers(len(c))
    return mix((c[e] - c[s]) * q[s])


def text_chunks(arr: pa.Array, limit: int = CHUNK_BYTES):
    """Slices of a string array as (first row, byte array, row offsets), about ``limit`` bytes each."""
    arr = pc.fill_null(arr, "")
    arr = arr.cast(pa.large_binary()) if not pa.types.is_large_binary(arr.type) else arr
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i, n = 0, len(arr)
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


LONG_WORD = 512                # bytes; from 1024 on, regular words can share a polynomial hash modulo 2^64
HASH_BLOCK = 1 << 16           # bytes of a chunk whose words are hashed in one step


def _block_end(data: np.ndarray, lo: int) -> int:
    """End of the block from ``lo``: after its last white space, or the next one where it has none."""
    hi = lo + HASH_BLOCK
    if hi >= len(data):
        return len(data)
    at = np.flatnonzero(_SPACE[data[lo:hi]])
    if len(at):
        return lo + int(at[-1]) + 1
    while hi < len(data):
        at = np.flatnonzero(_SPACE[data[hi:hi + HASH_BLOCK]])
        if len(at):
            return hi + int(at[0]) + 1
        hi += HASH_BLOCK
    return len(data)


def hash_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes other than ASCII white space) and word offsets by row.

    The bytes are taken in blocks that end at white space, so scratch memory stays small for a text of
    any length.
    """
    hashes, starts, lo = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while lo < len(data):
        hi = _block_end(data, lo)
        part = data[lo:hi]
        word = ~_SPACE[part]
        edge = np.zeros(hi - lo + 1, dtype=bool)
        edge[off[np.searchsorted(off, lo):np.searchsorted(off, hi)] - lo] = True
        edge[-1] = True
        s = np.flatnonzero(word & (np.append(True, ~word[:-1]) | edge[:-1]))
        e = np.flatnonzero(word & (np.append(~word[1:], True) | edge[1:])) + 1
        h = range_hash(prefix_hash(part), s, e)
        for i in np.flatnonzero(e - s >= LONG_WORD):
            h[i] = int.from_bytes(hashlib.blake2b(part[s[i]:e[i]].tobytes(), digest_size=8).digest(), "little")
        hashes.append(h)
        starts.append(s + lo)
        lo = hi
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), off)


def shingles(words: np.ndarray, off: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles and their offsets by row; 1 to n-1 words make one shingle."""
    rows = len(off) - 1
    cnt = off[1:] - off[:-1]
    mult = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(n)]
    m = len(words)
    acc = np.zeros(m, dtype=np.uint64)
    for k in range(min(n, m)):
        acc[:m - k] += words[k:] * mult[k]
    num = np.where(cnt >= n, cnt - n + 1, (cnt > 0).astype(np.int64))
    out_off = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(num, out=out_off[1:])
    row = np.repeat(np.arange(rows), num)
    at = off[:-1][row] + np.arange(out_off[-1]) - out_off[:-1][row]
    h = acc[at]
    for r in np.flatnonzero((cnt > 0) & (cnt < n)):       # short rows: all their words, no neighbour's
        own = words[off[r]:off[r + 1]] * np.array(mult[:cnt[r]], dtype=np.uint64)
        h[out_off[r]] = np.append(own, np.uint64(cnt[r])).sum(dtype=np.uint64)
    return mix(h), out_off


def hash_family(k: int, seed: int = 1) -> np.ndarray:
    """k odd 64-bit multipliers."""
    r = np.random.default_rng(seed)
    return r.integers(1, 1 << 63, size=k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_hash(h: np.ndarray, off: np.ndarray, mults: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """(rows, len(mults)) uint32 minima of multiply-shift hashes; rows without items get all ones."""
    rows = len(off) - 1
    sig = np.full((rows, len(mults)), 0xFFFFFFFF, dtype=np.uint32)
    i = 0
    while i < rows:
        j = min(max(int(np.searchsorted(off, off[i] + block, side="right")) - 1, i + 1), rows)
        full = np.flatnonzero(off[i + 1:j + 1] > off[i:j])
        if len(full):
            x, st = h[off[i]:off[j]], (off[i:j] - off[i])[full]
            for k, a in enumerate(mults):
                sig[i + full, k] = (np.minimum.reduceat(x * a, st) >> np.uint64(32)).astype(np.uint32)
        i = j
    return sig


# ---- a size-bounded filter for large joins --------------------------------------------------

FILTER_BITS = 26               # 8 MiB whatever the table size


def member_filter(nodes: DataFrame, col: str = "node"):
    """A test "may be in ``nodes``" as a column function: a bitmap of fixed size, made by native
    bitmap aggregates and broadcast.  It only thins out the large side before an exact join; with a
    very large ``nodes`` it lets more rows through and the join's result stays the same."""
    slot = F.pmod(F.col(col), F.lit(1 << FILTER_BITS))
    parts = (nodes.select(slot.alias("s")).groupBy(F.expr("bitmap_bucket_number(s)").alias("k"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s))").alias("bits")).collect())  # 8 MiB at most
    bits = np.zeros((1 << FILTER_BITS) // 8 + 8192, dtype=np.uint8)
    for r in parts:                                  # bucket k holds the values (k - 1) * 32768 + 1 and on
        at = (r["k"] - 1) * 4096
        if at >= 0:
            bits[at:at + 4096] |= np.frombuffer(r["bits"], dtype=np.uint8)[:4096]
    zero = any(r["k"] == 0 for r in parts)           # value 0 has a bucket of its own
    held = nodes.sparkSession.sparkContext.broadcast((bits, zero))

    @F.pandas_udf("boolean")
    def may_hold(node: pd.Series) -> pd.Series:
        b, z = held.value
        s = np.mod(node.to_numpy(dtype=np.int64), np.int64(1 << FILTER_BITS))
        p = np.maximum(s - 1, 0)
        hit = (b[p >> 3] >> (p & 7).astype(np.uint8)) & 1
        return pd.Series(np.where(s == 0, z, hit == 1))

    return may_hold
