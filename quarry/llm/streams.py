"""Ordered hashing of long sequences: SHA-256 over many rows of one key without holding them together."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame


def sorted_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows of a key in one partition, sorted; a task reads them batch by batch."""
    return df.repartition(*key).sortWithinPartitions(*key, *order)


def stream_sha256(df: DataFrame, key: list[str], order: list[str], piece: str, sep: str = "") -> DataFrame:
    """``key`` columns and ``sha256``: lowercase hex of each key's pieces in order, joined by ``sep``.

    A hash is sequential, so a key's pieces pass through one task; that task holds one Arrow batch of them at a
    time.  Callers send pieces that each join many values, so a key has few rows.
    """
    schema = df.select(*key).schema.add("sha256", "string")
    sep_bytes = sep.encode()
    names = [f.name for f in schema]

    def run(batches):
        cur, sha, out = None, None, []
        for b in batches:
            cols = [b.column(b.schema.get_field_index(k)).to_pylist() for k in key]
            for k, p in zip(zip(*cols), b.column(b.schema.get_field_index(piece)).to_pylist()):
                if sha is not None and k == cur:
                    sha.update(sep_bytes)
                else:
                    if sha is not None:
                        out.append((*cur, sha.hexdigest()))
                    cur, sha = k, hashlib.sha256()
                sha.update((p or "").encode())
            if len(out) >= 1000:
                yield _batch(out, names, types)
                out = []
        if sha is not None:
            out.append((*cur, sha.hexdigest()))
        if out:
            yield _batch(out, names, types)

    from pyspark.sql.pandas.types import to_arrow_schema
    types = to_arrow_schema(schema)
    return sorted_rows(df.select(*key, *order, piece), key, order).mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=schema.field(n).type) for i, n in enumerate(names)],
                                      schema=schema)
