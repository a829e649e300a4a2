"""Operator 7: token-ID output, entropy-coded with a static range asymmetric numeral system (rANS).

Documents are range-partitioned and sorted by doc_id; a task is a *file*, written as Parquet rows of
*segments*.  A segment holds whole documents (about a million ids), one frequency table shared by all
of its blocks, and blocks that decode independently: ids are dealt to interleaved lanes, the lane
states are kept at checkpoints inside a block so that parts of it decode side by side, and a checksum
of the block's ids is verified when it is read.

Coder: 64-bit states in [2^32, 2^64), 32-bit words, frequencies scaled to 2^20.

Edge cases: NULL or empty text is the end id alone; ties in doc_id are ordered by text hash; NULL
doc_ids come first; an empty table writes no segment; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, staged, text_or_empty
from .tokens import encode_column, encoder

SCALE = 20
LANES, STEPS, CHECKPOINT = 256, 256, 64
SEGMENT_IDS = 1 << 20
_LOW = np.uint64(1 << 32)
_HEAD = struct.Struct("<IHHHI")          # ids, steps, lanes, checkpoints, crc32

SEGMENT = T.StructType([
    T.StructField("file", T.IntegerType()), T.StructField("segment", T.IntegerType()),
    T.StructField("first_id", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("table", T.BinaryType()), T.StructField("blocks", T.ArrayType(T.BinaryType())),
])


def scaled_frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and frequencies (each >= 1, sum <= 2^20) of a non-empty id array."""
    sym, cnt = np.unique(ids, return_counts=True)
    total = 1 << SCALE
    if len(sym) == 1:
        return sym, np.array([total - 1], dtype=np.int64)
    f = np.maximum(1, cnt * total // cnt.sum())
    over, order = int(f.sum()) - total, np.argsort(-f, kind="stable")
    while over > 0:                       # taken from the most frequent symbols, half of each at most
        for i in order:
            cut = min(over, int(f[i]) // 2)
            f[i] -= cut
            over -= cut
            if not over:
                break
    return sym, f


def pack_table(sym: np.ndarray, f: np.ndarray) -> bytes:
    return zlib.compress(np.concatenate([np.diff(sym.astype("<i4"), prepend=0), f]).astype("<i4").tobytes(), 6)


def unpack_table(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(zlib.decompress(raw), dtype="<i4").astype(np.int64)
    return np.cumsum(a[:len(a) // 2]), a[len(a) // 2:]


def _encode_grid(grid: np.ndarray, freq: np.ndarray, cum: np.ndarray):
    """grid (blocks, steps, lanes) of symbol numbers -> per block words and checkpoint states."""
    blocks, steps, lanes = grid.shape
    x = np.full((blocks, lanes), _LOW, dtype=np.uint64)
    emit = np.zeros((blocks, steps, lanes), dtype=bool)
    low = np.zeros((blocks, steps, lanes), dtype=np.uint32)
    marks = {}
    for t in range(steps - 1, -1, -1):
        f, c = freq[grid[:, t]], cum[grid[:, t]]
        m = x >= (f << np.uint64(64 - SCALE))
        emit[:, t], low[:, t] = m, x.astype(np.uint32)
        x = np.where(m, x >> np.uint64(32), x)
        q = x // f
        x = (q << np.uint64(SCALE)) + (x - q * f) + c
        if t % CHECKPOINT == 0:
            marks[t] = x.copy()
    out = []
    per_step = emit.sum(axis=2)
    for b in range(blocks):
        at = np.concatenate([[0], np.cumsum(per_step[b])])
        ck = b"".join(struct.pack("<I", at[t]) + marks[t][b].astype("<u8").tobytes() for t in sorted(marks))
        out.append((ck, low[b][emit[b]].astype("<u4").tobytes()))
    return out


def encode_ids(ids: np.ndarray) -> tuple[bytes, list[bytes]]:
    """Frequency table and blocks of a non-empty id array."""
    sym, f = scaled_frequencies(ids)
    freq, cum = f.astype(np.uint64), (np.cumsum(f) - f).astype(np.uint64)
    num, pad = np.searchsorted(sym, ids), int(np.argmax(f))
    size, blocks = LANES * STEPS, []
    whole = len(ids) // size * size
    for lo, hi, steps in ((0, whole, STEPS), (whole, len(ids), -(-(len(ids) - whole) // LANES))):
        if hi == lo:
            continue
        part = num[lo:hi]
        width = steps * LANES
        part = np.concatenate([part, np.full(-len(part) % width, pad)])
        for k, (ck, words) in enumerate(_encode_grid(part.reshape(-1, steps, LANES), freq, cum)):
            own = ids[lo + k * width:min(lo + (k + 1) * width, hi)].astype("<u4")
            head = _HEAD.pack(len(own), steps, LANES, -(-steps // CHECKPOINT), zlib.crc32(own.tobytes()))
            blocks.append(head + ck + words)
    return pack_table(sym, f), blocks


def decode_ids(table: bytes, blocks: list[bytes]) -> np.ndarray:
    """All ids; the parts between checkpoints of all blocks are decoded side by side."""
    sym, f = unpack_table(table)
    freq, cum = f.astype(np.uint64), (np.cumsum(f) - f).astype(np.uint64)
    slots = np.repeat(np.arange(len(sym), dtype=np.int32), f)
    result = [None] * len(blocks)
    heads = [_HEAD.unpack_from(b) for b in blocks]
    for steps in sorted({h[1] for h in heads}):
        of = [i for i, h in enumerate(heads) if h[1] == steps]
        marks = heads[of[0]][3]
        width = 4 + 8 * LANES
        state, ptr, words, base = [], [], [], 0
        for i in of:
            body = _HEAD.size + marks * width
            w = np.frombuffer(blocks[i], dtype="<u4", offset=body)
            for k in range(marks):
                at = _HEAD.size + k * width
                ptr.append(base + struct.unpack_from("<I", blocks[i], at)[0])
                state.append(np.frombuffer(blocks[i], dtype="<u8", count=LANES, offset=at + 4))
            words.append(w)
            base += len(w)
        x, ptr = np.array(state, dtype=np.uint64), np.array(ptr, dtype=np.int64)
        w = np.concatenate([*words, np.zeros(LANES, dtype="<u4")]).astype(np.uint64)
        got = np.zeros((len(x), CHECKPOINT, LANES), dtype=np.int32)
        last = steps - (marks - 1) * CHECKPOINT          # steps after the last checkpoint
        live = np.arange(len(x))
        for t in range(min(CHECKPOINT, steps)):
            if t == last:                                # the short parts are done
                live = np.flatnonzero((np.arange(len(x)) + 1) % marks != 0)
            xs = x[live]
            slot = xs & np.uint64((1 << SCALE) - 1)
            k = slots[slot.astype(np.int64)]
            got[live, t] = k
            xs = freq[k] * (xs >> np.uint64(SCALE)) + slot - cum[k]
            m = xs < _LOW
            rank = np.cumsum(m, axis=1)
            word = w[np.minimum(ptr[live][:, None] + rank - 1, len(w) - 1)]
            x[live] = np.where(m, (xs << np.uint64(32)) | word, xs)
            ptr[live] += rank[:, -1]
        for j, i in enumerate(of):
            flat = got[j * marks:(j + 1) * marks].reshape(-1, LANES)[:steps].reshape(-1)
            own = sym[flat[:heads[i][0]]].astype("<u4")
            if zlib.crc32(own.tobytes()) != heads[i][4]:
                raise ValueError("block checksum differs")
            result[i] = own
    return np.concatenate(result)


def write_files(docs: DataFrame, tokenizer: str, end_id: int, keep_space: bool = True) -> DataFrame:
    """Encode ``docs(doc_id, text)`` in ascending doc_id order; the written segments, reread."""

    def run(batches):
        enc, file = encoder(tokenizer, keep_space), TaskContext.get().partitionId()
        held, doc_ids, lengths, n, first, seg = [], [], [], 0, 0, 0

        def close():
            table, blocks = encode_ids(np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([seg], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([n], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([table], pa.binary()),
                 pa.array([blocks], pa.list_(pa.binary()))], names=[f.name for f in SEGMENT.fields])

        for b in batches:
            keys = b.column(0).to_pylist()
            for at0, ids, at in encode_column(enc, b.column(1)):
                size = np.diff(at) + 1
                full = np.insert(ids, at[1:], end_id).astype(np.uint32)
                end = np.cumsum(size)
                r = 0
                while r < len(size):           # whole documents up to a segment's size
                    done = end[r] - size[r]
                    k = max(int(np.searchsorted(end, done + max(SEGMENT_IDS - n, 1), side="right")), r + 1)
                    held.append(full[done:end[k - 1]])
                    doc_ids += keys[at0 + r:at0 + k]
                    lengths += size[r:k].tolist()
                    n += int(end[k - 1] - done)
                    r = k
                    if n >= SEGMENT_IDS * 3 // 4:
                        yield close()
                        first, seg = first + n, seg + 1
                        held, doc_ids, lengths, n = [], [], [], 0
        if n:
            yield close()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    h = F.xxhash64("text")
    d = d.repartitionByRange(F.col("doc_id"), h).sortWithinPartitions("doc_id", h)
    return staged(d.mapInArrow(run, SEGMENT), "rans-files")


def read_files(files: DataFrame) -> DataFrame:
    """Decode written segments -> (doc_id, start, n_tokens, ids_crc32) per document."""
    schema = "file int, doc_id long, at long, n_tokens long, ids_crc32 long"

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = decode_ids(r["table"], r["blocks"])
                end = np.cumsum(r["lengths"])
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for n, e in zip(r["lengths"], end.tolist())]
                k = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["file"]] * k, pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                     pa.array(r["first_id"] + end - r["lengths"], pa.int64()), pa.array(r["lengths"], pa.int64()),
                     pa.array(crc, pa.int64())], names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])

    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    offs = (files.groupBy("file").agg(F.sum("n_ids").alias("n"))          # a row per file
            .select(F.col("file").alias("_f"), F.coalesce(before, F.lit(0)).alias("_before")))
    d = files.select("file", "first_id", "doc_ids", "lengths", "table", "blocks").mapInArrow(run, schema)
    return d.join(offs, d["file"] == offs["_f"]).select(
        "doc_id", (F.col("at") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")


def byte_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op7_rans(spark, sf_dir: str) -> DataFrame:
    return read_files(write_files(read(spark, sf_dir, "documents"), byte_bpe_path(), 0))
