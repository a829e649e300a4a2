"""Operator 5: mixing sources to target weights by systematic sampling.

Sources in code-point order (NULL last) weigh 1, 2, 3, repeating, and share 100 % of all words.
A target never exceeds ``max_repeat`` times its source's size; what is over is shared again by
weight until no source is above.  Inside a source the documents are laid out by size, the expected
copies (target / size) are prefix-summed, one offset per source is added and a document is emitted
once for each integer boundary its interval crosses.

Edge cases: NULL or blank text has size 0 and is taken 0 words (its copies still follow the layout);
a source without words has target 0; NULL sources form one source; repeated rows and ties are laid
out side by side; very long texts count like others; an empty table gives an empty result; other columns are passed
through whatever their names (the row travels as one struct).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, global_rank, read, staged, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"


def word_count(col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def offset_of(source: Column, seed: int) -> Column:
    """One fixed pseudo-random number in [0, 1) per source."""
    h = F.md5(F.concat(F.coalesce(source, F.lit("")), F.lit(f"#{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, max_repeat: int = 3) -> DataFrame:
    """``sizes(source, size)`` rows -> one row per source: source, source_size, weight, target."""
    per = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    per = global_rank(per, [F.col("source").asc_nulls_last()], [], "pos")
    per = staged(per.select("source", "source_size", (F.col("pos") % 3 + 1).alias("weight")), "mix-weights")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:     # each round caps more sources, so it ends; one row per round reaches the driver
        over = F.col("source_size") * max_repeat < F.col("weight") * F.lit(level)
        r = per.agg(F.sum(F.when(over, F.col("source_size") * max_repeat)).alias("c"),
                    F.sum(F.when(~over, F.col("weight"))).alias("w"),
                    F.count(F.when(over, 1)).alias("n")).first()
        if r["n"] == capped or not r["w"]:
            break
        capped, level = r["n"], (total - (r["c"] or 0)) / r["w"]
    target = F.least((F.col("source_size") * max_repeat).cast("double"), F.col("weight") * F.lit(float(level)))
    return per.withColumn("target", target)


ADDED = ["size", "source_size", "target", "copies", "taken"]


def mix_rows(docs: DataFrame, size: Column, max_repeat: int = 3, seed: int = 42) -> DataFrame:
    """row (struct of all columns of ``docs``) with size, source_size, target, copies and taken (= size * copies)."""
    d = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("source").alias("source"),
                    F.col("doc_id").alias("doc_id"), size.alias("size"))
    targets = source_targets(d.select("source", "size"), max_repeat)
    order = [F.col("size"), F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")), F.col("doc_id")]
    ranked = global_rank(d, order, ["source"], "place")
    t = targets.select(F.col("source").alias("of"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = offset_of(F.col("source"), seed)
    copies = (F.floor(u + (F.col("place") + 1) * rate) - F.floor(u + F.col("place") * rate)).cast("long")
    return (ranked.join(t, ranked["source"].eqNullSafe(t["of"])).withColumn("copies", copies)
            .withColumn("taken", F.col("size") * F.col("copies")).select("row", *ADDED))


def mix(docs: DataFrame, max_repeat: int = 3, seed: int = 42, size: Column | None = None) -> DataFrame:
    """All rows of ``docs`` plus size, source_size, target, copies and taken (= size * copies).

    ``docs`` needs doc_id and source, and text unless ``size`` gives the words counted before.  Its own columns of
    the added names are kept as ``in_<name>`` (underscores are added where that is taken, too).
    """
    m = mix_rows(docs, word_count() if size is None else size, max_repeat, seed)
    clash = [c for c in docs.columns if c.lower() in ADDED]
    names = dict(zip(clash, fresh(docs.columns + ADDED, *[f"in_{c}" for c in clash])))
    return m.select(*[F.col("row")[c].alias(names.get(c, c)) for c in docs.columns], *ADDED)


def sample(docs: DataFrame, max_repeat: int = 3, seed: int = 42) -> DataFrame:
    """The mixed documents themselves: the columns of ``docs``, a row per taken copy."""
    m = mix_rows(docs, word_count(), max_repeat, seed).where("copies > 0")
    return m.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    slim = staged(docs.select("doc_id", "source", word_count().alias("words")), "mix-slim")
    return mix(slim, size=F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


# source levels: with the sources sorted by size/weight, the first k are capped; the level of the
# right k lies between the k-th and the next ratio
SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST) AS k FROM p),
c AS (SELECT k, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), 0))::DOUBLE / (sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
          3 * source_size::DOUBLE / weight AS ratio FROM o),
l AS (SELECT level FROM c WHERE level <= ratio ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * (SELECT level FROM l)) AS target FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, coalesce(md5(doc_id::VARCHAR), ''), doc_id) - 1 AS i
      FROM d),
j AS (SELECT r.doc_id, r.size, t.source_size, t.target, r.i,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        ('0x' || substr(md5(coalesce(r.source, '') || '#42'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(u + (i + 1) * rate) - floor(u + i * rate)))::BIGINT AS taken FROM j
"""
