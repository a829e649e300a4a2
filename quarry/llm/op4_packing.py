"""Operator 4: packing token sequences into windows by best-fit decreasing.

Documents are tokenised once and cut into full windows plus one rest.  Best-fit decreasing depends
only on how many pieces there are of each length, so the plan is made from that histogram (at most
``window`` rows, whatever the corpus size): lengths are taken from long to short, a segment tree over
remaining capacity finds the tightest open window, and equal pieces are placed in runs.  A piece then
finds its run from its rank among the pieces of its length; ranks come from per-task counts, so no
length, however common, is sorted or gathered in one task.

Edge cases: NULL or empty text is one piece with the end id only; ties and repeated rows are separate
documents; NULL doc_ids are packed like others; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, staged, text_or_empty
from .tokens import encode_column, encoder

WINDOW = 4096
PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()), T.StructField("task", T.IntegerType()),
    T.StructField("nth", T.LongType()),
])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW,
                 keep_space: bool = False) -> DataFrame:
    """Pieces of every document: ids as little-endian uint32, and the running number per (task, length)."""

    def run(batches):
        enc, task = encoder(tokenizer, keep_space), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for first, ids, at in encode_column(enc, b.column(1)):
                rows = {f.name: [] for f in PIECES.fields}
                for r in range(len(at) - 1):
                    all_ids = np.append(ids[at[r]:at[r + 1]], np.uint32(end_id)).astype("<u4")
                    n = len(all_ids)
                    for s in range(0, n, window):
                        part = all_ids[s:s + window]
                        rows["doc_id"].append(doc_ids[first + r])
                        rows["start"].append(s)
                        rows["length"].append(len(part))
                        rows["doc_tokens"].append(n)
                        rows["ids"].append(part.tobytes())
                        rows["task"].append(task)
                        rows["nth"].append(int(seen[len(part)]))
                        seen[len(part)] += 1
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)],
                                                 names=list(rows))

    return docs.select(F.col("doc_id").cast("long"), text_or_empty()).mapInArrow(run, PIECES)


class CapacityTree:
    """Segment tree over remaining capacity: which capacities have open windows."""

    def __init__(self, top: int):
        self.size = 1 << (top + 1).bit_length()
        self.any = bytearray(2 * self.size)
        self.open: dict[int, list[tuple[int, int]]] = {}     # capacity -> runs of windows (first, count)

    def _mark(self, cap: int, on: int) -> None:
        i = self.size + cap
        self.any[i] = on
        while i > 1:
            i >>= 1
            now = self.any[2 * i] | self.any[2 * i + 1]
            if self.any[i] == now and not on:
                break
            self.any[i] = now

    def push(self, cap: int, first: int, count: int) -> None:
        if count and cap:
            runs = self.open.setdefault(cap, [])
            runs.append((first, count))
            if len(runs) == 1:
                self._mark(cap, 1)

    def pop(self, cap: int) -> tuple[int, int]:
        run = self.open[cap].pop()
        if not self.open[cap]:
            self._mark(cap, 0)
        return run

    def tightest(self, need: int) -> int | None:
        """The smallest capacity >= need with an open window."""
        i = self.size + need
        if self.any[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Runs (length, first rank, pieces, first window, offset, pieces per window) of the packing."""
    tree, runs, windows = CapacityTree(window), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            cap = tree.tightest(length)
            if cap is None:
                cap, first = window, windows
                count = math.ceil(left / (window // length))
                windows += count
            else:
                first, count = tree.pop(cap)
            per = cap // length
            used = min(count, math.ceil(left / per))
            tree.push(cap, first + used, count - used)
            full = min(used, left // per)
            if full:
                runs.append((length, rank, full * per, first, window - cap, per))
                tree.push(cap - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if used > full:      # the last window takes the remaining pieces, fewer than ``per``
                runs.append((length, rank, left, first + full, window - cap, left))
                tree.push(cap - left * length, first + full, 1)
                left = 0
    return np.array(runs, dtype=np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to staged ``pieces`` (length, task, nth)."""
    counts = staged(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offs = staged(counts.select(F.col("length").alias("_l"), F.col("task").alias("_t"),
                                F.coalesce(before, F.lit(0)).alias("_before")), "pack-offsets")
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= window rows
    runs = best_fit_decreasing(hist, window)
    key = (runs[:, 0] << 44) + runs[:, 1]
    order = np.argsort(key)
    plan = pieces.sparkSession.sparkContext.broadcast((key[order], runs[order]))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, rows = plan.value
        r = rows[np.searchsorted(keys, (length.to_numpy() << 44) + rank.to_numpy(), side="right") - 1]
        j = rank.to_numpy() - r[:, 1]
        return pd.DataFrame({"sequence_id": r[:, 3] + j // r[:, 5],
                             "offset": r[:, 4] + (j % r[:, 5]) * length.to_numpy()})

    j = pieces.join(offs, (F.col("length") == F.col("_l")) & (F.col("task") == F.col("_t")))
    return (j.withColumn("_at", place(F.col("length"), F.col("nth") + F.col("_before")))
            .select("doc_id", "start", "length", "ids", "doc_tokens",
                    F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset")))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, n_ids, ids as little-endian uint32)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))      # at most ``window`` ids together
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("p"))
            .select("sequence_id", "n_ids", F.expr("unhex(array_join(transform(p, x -> hex(x.ids)), ''))").alias("ids")))


def word_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    return pack(staged(token_pieces(docs, tokenizer or word_bpe_path(), end_id, window), "pack-pieces"), window)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    packed = pack_documents(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
