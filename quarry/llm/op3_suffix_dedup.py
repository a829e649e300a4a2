"""Operator 3: repeated passages by suffix order and longest-previous-factor arrays.

A byte is removed when a string of ``length`` bytes covering it also starts anywhere else in the corpus.

1. Every window of ``length`` bytes is led by its k-gram of smallest hash (leftmost on ties), so equal
   windows have the same leader at the same place.  The windows of one leader share a *core* around it;
   they are split in a left and a right half, whose cores are longer, and the core's hash is the key.
2. Keys that occur once cannot hold repeats.  For the others the bytes of the windows (*pieces*) are
   shuffled by key; equal pieces are combined before and counted.
3. A task sorts the suffixes of many pieces (prefix doubling up to ``length``), takes their common
   prefixes, and finds the previous and next smaller positions in suffix order: the longer common prefix
   with one of them is the longest previous factor.  Reversed positions give the longest next factor.
   A window repeats when one of the two reaches ``length``.  (``keep_first`` uses the first only.)
4. A key with more pieces than ``max_pieces`` is not gathered: its windows are spread by their own hash
   and counted, which gives the same windows.

Texts that are equal are processed once; a text with copies is repeated as a whole.

Edge cases: NULL text counts as empty; a text shorter than ``length`` keeps everything; repeated rows
are copies of each other; NULL doc_ids are kept; a text repeating within itself loses those passages; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import member_filter, mix, prefix_hash, range_hash, read, staged, text_chunks, text_or_empty

LENGTH, GRAM = 200, 32
MAX_PIECES = 2000
BATCH_BYTES = 1 << 20


def window_leaders(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one leader: (row, leader position, first and last window start)."""
    n, width = len(data), length - gram + 1
    size = np.diff(off)
    empty = (np.zeros(0, np.int64),) * 4
    if n < length or not (size >= length).any():
        return empty, None
    c = prefix_hash(data)
    pos = np.arange(n - gram + 1)
    h = range_hash(c, pos, pos + gram)
    v = (h & np.uint64(0xFFFFFFFF00000000)) | pos.astype(np.uint64)      # smallest hash, then leftmost
    # minima over sliding windows of ``width`` from block prefixes and suffixes
    pad = (-len(v)) % width
    g = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
    left = np.minimum.accumulate(g, axis=1).reshape(-1)
    right = np.minimum.accumulate(g[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    m = len(v) - width + 1
    lead = (np.minimum(right[:m], left[width - 1:width - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ok = np.zeros(m + 1, dtype=np.int64)                                  # windows inside one row
    rows = np.flatnonzero(size >= length)
    np.add.at(ok, off[rows], 1)
    np.add.at(ok, off[rows] + size[rows] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(ok[:m]) > 0)
    if not len(start):
        return empty, c
    ld = lead[start]
    row = np.searchsorted(off, start, side="right") - 1
    new = np.concatenate([[True], (ld[1:] != ld[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return (row[first], ld[first], start[first], start[last]), c


def keyed_runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, key, first, last) of half runs; first and last are window starts inside the row."""
    (row, lead, a, b), c = window_leaders(data, off, length, gram)
    if not len(row):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    back = (length - gram) // 2                     # right half: windows starting at most so far before
    mid = lead - back
    ra, lb = np.maximum(a, mid), np.minimum(b, mid - 1)
    r, l = ra <= b, a <= lb
    right = range_hash(c, lead[r], lead[r] + length - back) ^ np.uint64(0x5555)
    left = range_hash(c, mid[l], lead[l] + gram)
    out_row = np.concatenate([row[r], row[l]])
    key = np.concatenate([right, left]).view(np.int64)
    s, e = np.concatenate([ra[r], a[l]]), np.concatenate([b[r], lb[l]])
    return out_row, key, s - off[out_row], e - off[out_row]


# ---- suffix order inside a task -------------------------------------------------------------

def suffix_ranks(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, ... and ``length`` bytes (prefix doubling)."""
    n = len(data)
    x = np.zeros(n, dtype=np.uint64)
    pad = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for k in range(8):
        x = (x << np.uint64(8)) | pad[k:k + n]
    ranks, size = {}, 8
    ranks[8] = np.unique(x, return_inverse=True)[1]
    while size < length:
        step = min(size, length - size)
        nxt = np.zeros(n, dtype=np.int64)
        nxt[:n - step] = ranks[size][step:] + 1
        ranks[size + step] = np.unique(ranks[size].astype(np.int64) * (n + 2) + nxt, return_inverse=True)[1]
        size += step
    return ranks


def common_prefix(ranks: dict[int, np.ndarray], data: np.ndarray, p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of the suffixes at p and q, at most ``length`` bytes."""
    out = np.where(ranks[length][p] == ranks[length][q], length, 0)
    todo = np.flatnonzero(out == 0)
    n = len(data)
    at = np.zeros(len(todo), dtype=np.int64)
    for size in sorted((s for s in ranks if s < length), reverse=True):
        i, j = p[todo] + at, q[todo] + at
        ok = (np.maximum(i, j) + size <= n)
        ok[ok] = ranks[size][i[ok]] == ranks[size][j[ok]]
        at += np.where(ok, size, 0)
    for _ in range(8):
        i, j = p[todo] + at, q[todo] + at
        ok = np.maximum(i, j) < n
        ok[ok] = data[i[ok]] == data[j[ok]]
        at += ok & (at < length)
        if not ok.any():
            break
    out[todo] = np.minimum(at, length - 1)
    return out


def _nearest_smaller(pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Common prefix with the nearest earlier entry of smaller position (pointer jumping)."""
    n = len(pos)
    to, low = np.arange(-1, n - 1), lcp.copy()          # lcp[i]: entries i-1 and i
    while True:
        bad = np.flatnonzero((to >= 0) & (pos[to] > pos))
        bad = bad[low[bad] > 0]
        if not len(bad):
            break
        t = to[bad]
        low[bad] = np.minimum(low[bad], low[t])
        to[bad] = to[t]
    return np.where(to >= 0, low, 0)


def longest_previous_factor(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start: the longest common prefix (at most ``length``) with an earlier start."""
    ranks = suffix_ranks(data, length)
    order = starts[np.argsort(ranks[length][starts], kind="stable")]
    lcp = np.zeros(len(order), dtype=np.int64)
    lcp[1:] = common_prefix(ranks, data, order[:-1], order[1:], length)
    prev = _nearest_smaller(order, lcp)
    nxt = _nearest_smaller(order[::-1], np.concatenate([[0], lcp[:0:-1]]))[::-1]
    out = np.zeros(len(data), dtype=np.int64)
    out[order] = np.maximum(prev, nxt)
    return out[starts]


def repeated_starts(data: np.ndarray, starts: np.ndarray, length: int, keep_first: bool = False) -> np.ndarray:
    """Which of the window starts repeat (with ``keep_first``: only the later copies)."""
    if not len(starts):
        return np.zeros(0, dtype=bool)
    ranks = suffix_ranks(data, length)
    order = np.argsort(ranks[length][starts], kind="stable")
    p = starts[order]
    lcp = np.zeros(len(p), dtype=np.int64)
    lcp[1:] = common_prefix(ranks, data, p[:-1], p[1:], length)
    back = np.concatenate([[0], lcp[:0:-1]])

    def factor(pos):                                   # longest factor at a smaller position
        return np.maximum(_nearest_smaller(pos, lcp), _nearest_smaller(pos[::-1], back)[::-1])

    hit = factor(p) >= length
    if not keep_first:
        hit |= factor(-p) >= length
    out = np.zeros(len(p), dtype=bool)
    out[order] = hit
    return out


def _spans(hit: np.ndarray, base: int, length: int) -> list[tuple[int, int]]:
    """Covered [start, end) ranges of consecutive repeated windows."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(base + int(s), base + int(e) - 1 + length) for s, e in zip(edge[::2], edge[1::2])]


# ---- Spark side -----------------------------------------------------------------------------

def _runs(docs: DataFrame) -> DataFrame:
    """Per row: its window runs as arrays."""
    schema = "node long, keys array<long>, a array<int>, b array<int>"

    def run(batches):
        for b in batches:
            for first, data, off in text_chunks(b.column(1)):
                row, key, s, e = keyed_runs(data, off)
                order = np.argsort(row, kind="stable")
                cut = pa.array(np.searchsorted(row[order], np.arange(len(off))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(off) - 1), pa.ListArray.from_arrays(cut, pa.array(key[order])),
                     pa.ListArray.from_arrays(cut, pa.array(s[order].astype(np.int32))),
                     pa.ListArray.from_arrays(cut, pa.array(e[order].astype(np.int32)))],
                    names=["node", "keys", "a", "b"])

    return docs.select("node", "text").mapInArrow(run, schema)


def _pieces(texts: DataFrame) -> DataFrame:
    """(node, text, runs) -> a row per run: (key, node, a, piece)."""
    def run(batches):
        for b in batches:
            for node, text, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = text.encode("utf-8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["key"] for r in runs], pa.int64()), pa.array([node] * len(runs), pa.int64()),
                     pa.array([r["a"] for r in runs], pa.int32()),
                     pa.array([raw[r["a"]:r["b"] + LENGTH] for r in runs], pa.binary())], names=["key", "node", "a", "piece"])

    return texts.select("node", "text", "runs").mapInArrow(run, "key long, node long, a int, piece binary")


def _suffix_task(batches):
    """(key, ph, n, piece) sorted by key -> (key, ph, spans) by suffix order of many pieces at once."""
    def solve(rows):
        size = np.array([len(r[3]) for r in rows], dtype=np.int64)
        base = np.cumsum(size) - size
        data = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8)
        num = size - LENGTH + 1
        at = np.concatenate([[0], np.cumsum(num)])
        starts = np.arange(at[-1]) - np.repeat(at[:-1], num) + np.repeat(base, num)
        hit = repeated_starts(data, starts, LENGTH)
        out = ([], [], [])
        for k, r in enumerate(rows):
            spans = [(0, int(size[k]))] if r[2] > 1 else _spans(hit[at[k]:at[k + 1]], 0, LENGTH)
            if spans:
                out[0].append(r[0])
                out[1].append(r[1])
                out[2].append([{"s": s, "e": e} for s, e in spans])
        t = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], t)],
                                          names=["key", "ph", "spans"])

    held, total = [], 0
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if total >= BATCH_BYTES and row[0] != held[-1][0]:
                yield solve(held)
                held, total = [], 0
            held.append(row)
            total += len(row[3])
    if held:
        yield solve(held)


def _window_hashes(batches):
    """(key, ph, n, piece) -> a row per window: (key, ph, s, n, wh)."""
    for b in batches:
        for key, ph, n, piece in zip(*[c.to_pylist() for c in b.columns]):
            data = np.frombuffer(piece, dtype=np.uint8)
            s = np.arange(len(data) - LENGTH + 1)
            wh = range_hash(prefix_hash(data), s, s + LENGTH)
            wh = mix(wh ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)).view(np.int64)
            k = len(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * k, pa.int64()), pa.array([ph] * k, pa.int64()), pa.array(s, pa.int32()),
                 pa.array([n] * k, pa.int64()), pa.array(wh)], names=["key", "ph", "s", "n", "wh"])


def _cut(batches):
    """(node, text, spans) -> (node, n_removed, n_spans, kept_sha256, kept)."""
    for b in batches:
        out = ([], [], [], [], [])
        for node, text, spans in zip(*[c.to_pylist() for c in b.columns]):
            raw, kept, end, removed, n = text.encode("utf-8"), [], 0, 0, 0
            last = -1
            for s, e in sorted((x["s"], x["e"]) for x in spans):
                if s > last:                           # a new maximal run (touching runs are one)
                    n += 1
                if e > end:
                    kept.append(raw[end:max(s, end)])
                    removed += e - max(s, end)
                    end = e
                last = max(last, e)
            kept.append(raw[end:])
            rest = b"".join(kept)
            for col, v in zip(out, (node, removed, n, hashlib.sha256(rest).hexdigest(), rest)):
                col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()),
                                          pa.array(out[4], pa.binary())],
                                         names=["node", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, max_pieces: int = MAX_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; NULL: the whole text)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    d = d.withColumn("node", F.xxhash64("text"))
    slim = staged(d.select("doc_id", "node", F.octet_length("text").cast("long").alias("n_bytes"),
                           F.sha2("text", 256).alias("sha")), "lpf-slim")
    nodes = staged(slim.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "lpf-nodes")
    runs = staged(_runs(d).groupBy("node").agg(F.first(F.struct("keys", "a", "b")).alias("r")), "lpf-runs")
    flat = runs.select("node", F.explode(F.arrays_zip("r.keys", "r.a", "r.b")).alias("x")).select(
        "node", F.col("x.keys").alias("key"), F.col("x.a").alias("a"), F.col("x.b").alias("b"))
    # written, so that the join deals out both sides itself and the rows of a very common key can be split
    again = staged(flat.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "lpf-again")
    cand = flat.join(again, "key").groupBy("node").agg(F.collect_list(F.struct("key", "a", "b")).alias("runs"))
    cand = staged(cand.join(nodes.select("node", "first_id"), "node"), "lpf-cand")
    may = member_filter(cand)
    c = cand.select(F.col("node").alias("_node"), "first_id", "runs")
    texts = staged(d.where(may("node")).join(
        c, (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("node", "text", "runs"), "lpf-texts")
    texts = texts.dropDuplicates(["node"])             # repeated rows of one document
    pieces = staged(_pieces(texts).withColumn("ph", F.xxhash64("piece")), "lpf-pieces")
    distinct = staged(pieces.groupBy("key", "ph").agg(F.count(F.lit(1)).alias("n"), F.first("piece").alias("piece")),
                      "lpf-distinct")
    many = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    big = staged(many.where(F.col("m") > max_pieces).select("key"), "lpf-big")
    cols = ["key", "ph", "n", "piece"]
    few = distinct.join(many.where((F.col("m") > 1) & (F.col("m") <= max_pieces)).select("key"), "key").select(*cols)
    span = "key long, ph long, spans array<struct<s:int,e:int>>"
    found = few.repartition("key").sortWithinPartitions("key").mapInArrow(_suffix_task, span)
    single = distinct.join(many.where("m = 1").select("key"), "key").where("n > 1").select(
        "key", "ph", F.array(F.struct(F.lit(0).alias("s"), F.octet_length("piece").alias("e"))).alias("spans"))
    win = staged(distinct.join(big, "key").select(*cols).mapInArrow(
        _window_hashes, "key long, ph long, s int, n long, wh long"), "lpf-windows")
    hot = win.groupBy("wh").agg(F.sum("n").alias("c")).where("c > 1").select("wh")
    wide = win.join(hot, "wh").groupBy("key", "ph").agg(
        F.collect_list(F.struct("s", (F.col("s") + LENGTH).alias("e"))).alias("spans"))
    found = staged(found.unionByName(single).unionByName(wide), "lpf-found")
    spans = (pieces.select("key", "ph", "node", "a").join(found, ["key", "ph"])
             .select("node", "a", F.explode("spans").alias("x"))
             .select("node", F.struct((F.col("a") + F.col("x.s")).alias("s"), (F.col("a") + F.col("x.e")).alias("e")).alias("x"))
             .groupBy("node").agg(F.collect_list("x").alias("spans")))
    cut = staged(texts.select("node", "text").join(spans, "node").select("node", "text", "spans").mapInArrow(
        _cut, "node long, n_removed long, n_spans long, kept_sha256 string, kept binary"), "lpf-cut")
    r = slim.join(nodes.select("node", "copies"), "node").join(cut, "node", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)       # every window of a copied text repeats
    return r.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")
