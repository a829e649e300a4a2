"""Operator 10: Lempel-Ziv phrase fingerprints of documents.

A text is parsed into LZ78 phrases (each the longest known phrase plus one code point); the phrase set
is hashed and reduced to a minimum-hash signature.  The share of equal positions of two signatures
estimates the likeness of the phrase sets, a stand-in for how well one text compresses the other.

The query also fingerprints an edited text built from the next document in descending doc_id order.
Rows are range-partitioned by doc_id, hash of the text and row number, so neither one doc_id nor one
repeated row, however common, is a task's whole work.  Each task compares its rows in order and writes
its first and last text beside its results; the last row of a task then meets the first of the next.

Edge cases: NULL text counts as empty; an empty phrase set has its own constant fingerprint; documents
that share a doc_id are ordered by the hash of their text, repeated rows follow each other; a NULL doc_id
comes last; a single document is its own successor; a very long text is parsed whole, in one task; an empty
table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_family, min_hash, prefix_hash, range_hash, read, staged, text_or_empty

HASHES = 128
GROUP_CHARS = 1 << 20
_MULTS = hash_family(HASHES, seed=10)


def lz_phrases(text: str, ends: list[int] | None = None) -> list[int]:
    """Ends of the LZ78 phrases; ``ends`` resumes after phrases already parsed.

    The dictionary holds every prefix of a phrase, so the longest match is searched up or down from
    the last phrase's length.  An unfinished last phrase is a known one and adds nothing.
    """
    ends = list(ends or [])
    seen = {text[a:b] for a, b in zip([0, *ends], ends)}
    i, n, m = (ends[-1] if ends else 0), len(text), 1
    add, put = seen.add, ends.append
    while i < n:
        j = min(i + m, n)
        if text[i:j] in seen:
            j += 1
            while j <= n and text[i:j] in seen:
                j += 1
        else:
            j -= 1
            while j > i and text[i:j] not in seen:
                j -= 1
            j += 1
        if j > n:
            break
        add(text[i:j])
        put(j)
        m, i = j - i, j
    return ends


def signatures(texts: list[str], ends: list[list[int]]) -> np.ndarray:
    """Minimum-hash signatures (16 bit a position) of the phrase sets."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(size)])
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    num = np.array([len(e) for e in ends], dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(num)])
    e = np.concatenate([np.array(x, dtype=np.int64) + b for x, b in zip(ends, base)] or [np.zeros(0, np.int64)])
    e = e.astype(np.int64)
    s = np.empty_like(e)
    s[1:] = e[:-1]
    s[off[:-1][num > 0]] = base[:-1][num > 0]
    h = range_hash(prefix_hash(code), s, e) if len(e) else np.zeros(0, np.uint64)
    return (min_hash(h, off, _MULTS) & np.uint32(0xFFFF)).astype(">u2")


def fingerprint(text: str) -> str:
    return signatures([text], [lz_phrases(text)])[0].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


RESULT = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double")
STAGED = RESULT + ", part int, is_last boolean, text string"       # results, and the border texts of each task
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(),
          pa.string()]


def _batch(columns: list[list]) -> pa.RecordBatch:
    names = [c.split()[0] for c in STAGED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, _TYPES)], names=names[:len(columns)])


def _compare(rows: list[tuple[int | None, str]]) -> list[list]:
    """(doc_id, text) in order -> columns of ``RESULT`` for all but the last."""
    texts, ends, at = [], [], []
    for k, (_, t) in enumerate(rows):
        own = lz_phrases(t)
        at.append(len(texts))
        texts.append(t)
        ends.append(own)
        if k + 1 < len(rows):
            cut = len(t) - len(t) // 3
            edited = t[:cut] + rows[k + 1][1][:len(t) // 3]
            texts.append(edited)
            ends.append(lz_phrases(edited, own[:int(np.searchsorted(own, cut, side="right"))]))
    sig = signatures(texts, ends)
    out: list[list] = [[] for _ in range(7)]
    for k, (doc_id, t) in enumerate(rows[:-1]):
        i, j = at[k], at[k + 1]
        values = (doc_id, len(t), hashlib.sha256(texts[i + 1].encode("utf-8", "surrogatepass")).digest(),
                  sig[i].tobytes(), sig[i + 1].tobytes(), likeness(sig[i], sig[i + 1]), likeness(sig[i], sig[j]))
        for col, v in zip(out, values):
            col.append(v)
    return out


def _in_order(batches):
    """Sorted (doc_id, text) -> results of all rows but the task's last one, and its first and last row."""
    part = TaskContext.get().partitionId()

    def border(row, is_last):
        return _batch([[row[0]], *[[None]] * 6, [part], [is_last], [row[1]]])

    held: list[tuple] = []
    chars = 0
    for b in batches:
        for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not held:
                yield border(row, False)
            held.append(row)
            chars += len(row[1])
            if chars >= GROUP_CHARS and len(held) > 1:
                done = _compare(held)
                yield _batch([*done, *[[None] * (len(held) - 1)] * 3])
                held, chars = held[-1:], len(row[1])
    if len(held) > 1:
        yield _batch([*_compare(held), *[[None] * (len(held) - 1)] * 3])
    if held:
        yield border(held[-1], True)


def _across(batches):
    """(doc_id, text, next text) -> results."""
    for b in batches:
        for doc_id, text, after in zip(*[c.to_pylist() for c in b.columns]):
            yield _batch(_compare([(doc_id, text), (None, after)]))


def compare_with_next(docs: DataFrame, tasks: int | None = None) -> DataFrame:
    """Fingerprints of each document, of its edited text, and the likeness to the next document."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h"), F.col("row")]
    d = d.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    d = d.repartitionByRange(*([tasks] if tasks else []), *order).sortWithinPartitions(*order)
    done = staged(d.select("doc_id", "text").mapInArrow(_in_order, STAGED), "lz-done")
    first = done.where("part is not null and not is_last").select(F.col("part").alias("_to"), F.col("text").alias("after"))
    last = done.where("part is not null and is_last").select("part", "doc_id", "text")
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = last.select("part").select(                            # a number per task; after the last the first
        "part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(every)).alias("to"))
    seams = last.join(follow, "part").join(first, F.col("to") == F.col("_to")).select("doc_id", "text", "after")
    columns = [c.split()[0] for c in RESULT.split(", ")]
    out = done.where("part is null").select(*columns).unionByName(seams.mapInArrow(_across, RESULT))
    return out.select(*[F.lower(F.hex(c)).alias(c) if out.schema[c].dataType.typeName() == "binary" else F.col(c) for c in columns])


def op10_lz(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(read(spark, sf_dir, "documents"))
