"""Operator 13: prefix trie of conversations by whole-sequence collapse.

1. Every turn gets a position in its conversation (``global_rank``: no conversation is sorted in one task) and
   a SHA-256 digest of role and text; the text goes no further.
2. A sequence of turns is named by the sums of four 32-bit parts of SHA-256(position, digest) over its turns, so
   the names of all prefixes of a conversation are running sums.
3. Identical conversations collapse into one weighted sequence with an end list (in ordered chunks); only the
   first conversation of each sequence goes on.
4. Its prefixes are the nodes.  Sequences whose name is the parent of some prefix are proper prefixes; the
   anti-join leaves the leaves.
5. A node belongs to the path of its smallest member.  Along each path the values of its own nodes are summed
   from the end (suffix sums), and a node's subtree sum is the sum of that over the sequences through it, so the
   work grows with the turns, not with turns times depth.

Running sums are taken inside blocks of ``BLOCK`` turns and completed by the block totals, so a conversation of
any length is spread over many tasks.  All aggregates are combined in the tasks first: a first turn that all
conversations share is one row a task.

Edge cases: NULL role or text is empty; turns are ordered NULL first, equal ones by role and digest; rows with a
NULL conv_id belong to no conversation and are left out; repeated rows are repeated turns; very long texts are
hashed whole; an empty table gives no nodes; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import global_rank, read, staged, text_or_empty
from .streams import stream_sha256

BLOCK = 4096                   # turns of one conversation summed together
ENDS = 1024                    # ids of one end list joined into a piece
WORD = r"[^\x20\x09-\x0D]+"
PARTS = ["p1", "p2", "p3", "p4"]
KEY = ["depth", "k1", "k2", "k3", "k4"]
PARENT = ["parent_depth", "q1", "q2", "q3", "q4"]
GROUP = 20                     # the query's rebuild: conversations c - c % 20 give the first turns
HEAD = 4                       # of which fewer than four are taken


def turn_digest(role: Column, text: Column) -> Column:
    """32 bytes that name (role, text)."""
    return F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))


def ordered_turns(convs: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of each conversation, numbered from 0."""
    t = convs.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_or_empty("role").alias("role"),
        turn_digest(text_or_empty("role"), text_or_empty("text")).alias("digest"),
        F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long").alias("words"))
    t = global_rank(t, [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()], ["conv_id"], "pos")
    return staged(t.select("conv_id", F.col("pos").cast("long").alias("pos"), "digest", "words"), "trie-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns after each conversation's first ``h`` are replaced by those of its group's first one, and all ids.

    ``h`` is crc32 of the decimal id modulo 4; the group's first one is ``conv_id - conv_id % 20``.
    """
    h = lambda c: F.crc32(c.cast("string")) % HEAD
    first = F.collect_list(F.when(F.col("pos") < HEAD - 1, F.struct("pos", "digest", "words")))
    conv = staged(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(first).alias("first")), "trie-conv")
    base = conv.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("first").alias("lent"))
    info = (conv.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(base, "base", "left")
            .select("conv_id", "n", F.when(F.col("lent").isNull(), F.expr("filter(first, x -> false)"))
                    .otherwise(F.slice("lent", F.lit(1), h(F.col("conv_id")).cast("int"))).alias("head")))
    head = info.select("conv_id", F.posexplode("head").alias("pos", "t")).select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "t.digest", "t.words")
    blocks = info.select("conv_id", F.size("head").alias("keep"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {BLOCK}"))).alias("block"))
    own = (turns.where(F.col("pos") >= h(F.col("conv_id"))).withColumn("block", F.expr(f"pos div {BLOCK}"))
           .join(blocks, ["conv_id", "block"])
           .select("conv_id", (F.col("pos") - h(F.col("conv_id")) + F.col("keep")).alias("pos"), "digest", "words"))
    return head.unionByName(own), conv.select("conv_id")


def sequences(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Collapse: (turns with name parts, members with their sequence's name, weighted sequences)."""
    s = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.hex("digest")), 256)
    part = [F.conv(F.substring(s, 1 + 8 * i, 8), 16, 10).cast("long").alias(p) for i, p in enumerate(PARTS)]
    t = staged(turns.select("conv_id", F.expr(f"pos div {BLOCK}").alias("block"), "pos", "words", *part), "trie-parts")
    total = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("depth"),
                                     *[F.sum(p).alias(k) for p, k in zip(PARTS, KEY[1:])])
    members = staged(ids.join(total, "conv_id", "left").fillna(0, KEY).select("conv_id", *KEY), "trie-members")
    seqs = members.groupBy(*KEY).agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    return t, members, staged(seqs, "trie-seqs")


def _with_blocks(rows: DataFrame, cols: list[str], back: bool) -> DataFrame:
    """Sums of ``cols`` over the blocks before (``back``: after) each block of conversations of several blocks."""
    w = Window.partitionBy("rep").orderBy(F.col("block").desc() if back else F.col("block")).rowsBetween(
        Window.unboundedPreceding, -1)
    sums = rows.where("many").groupBy("rep", "block").agg(*[F.sum(c).alias(c) for c in cols])
    return sums.select("rep", "block", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_off") for c in cols])


def _running(rows: DataFrame, cols: list[str], back: bool = False) -> DataFrame:
    """Add ``{c}_run``: the sum of ``c`` up to this turn (``back``: from this turn to the end)."""
    w = Window.partitionBy("rep", "block").orderBy(F.col("depth").desc() if back else F.col("depth")).rowsBetween(
        Window.unboundedPreceding, 0)
    out = rows.select("*", *[F.sum(c).over(w).alias(f"{c}_in") for c in cols])
    out = out.join(_with_blocks(rows, cols, back), ["rep", "block"], "left")
    return out.select(*rows.columns, *[(F.col(f"{c}_in") + F.coalesce(f"{c}_off", F.lit(0))).alias(f"{c}_run") for c in cols])


def prefixes(t: DataFrame, seqs: DataFrame) -> DataFrame:
    """A row per prefix of each distinct sequence: rep, block, weight, words, its name and its parent's."""
    blocks = seqs.select("rep", "weight", (F.col("depth") > BLOCK).alias("many"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"greatest(depth - 1, 0) div {BLOCK}"))).alias("block"))
    rows = (t.withColumnRenamed("conv_id", "rep").join(blocks, ["rep", "block"])
            .select("rep", "block", "weight", "many", (F.col("pos") + 1).alias("depth"), "words", *PARTS))
    rows = _running(rows, PARTS).select(
        "rep", "block", "weight", "many", "words", "depth", *[F.col(f"{p}_run").alias(k) for p, k in zip(PARTS, KEY[1:])],
        (F.col("depth") - 1).alias(PARENT[0]), *[(F.col(f"{p}_run") - F.col(p)).alias(q) for p, q in zip(PARTS, PARENT[1:])])
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = seqs.select("rep", zero.alias("block"), "weight", (F.col("depth") > BLOCK).alias("many"), zero.alias("words"),
                       *[zero.alias(k) for k in KEY], *[none.alias(q) for q in PARENT])
    return staged(rows.unionByName(root), "trie-prefixes")


def end_lists(members: DataFrame) -> DataFrame:
    """``KEY`` columns and ``ends_sha256``, the hash of the ids that end there, ascending and joined by commas."""
    m = global_rank(members, [F.col("conv_id").asc()], KEY, "place")
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = m.groupBy(*KEY, F.expr(f"place div {ENDS}").alias("piece_no")).agg(piece.alias("piece"))
    return stream_sha256(pieces, KEY, ["piece_no"], "piece", ",").withColumnRenamed("sha256", "ends_sha256")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, pos, digest, words); ``ids`` holds every conversation, turnless ones too."""
    t, members, seqs = sequences(turns, ids)
    p = prefixes(t, seqs)
    inner = p.where("depth > 0").select(*[F.col(q).alias(k) for q, k in zip(PARENT, KEY)]).distinct()
    leaves = seqs.join(inner, KEY, "left_anti").select("rep", "depth", F.lit(1).cast("long").alias("leaf"))
    # each node's own value stands on its smallest member's path
    own = (p.groupBy(*KEY).agg(F.min("rep").alias("rep"), ((F.sum("weight") - 1) * F.max("words")).alias("saved"))
           .select("rep", "depth", "saved").join(leaves, ["rep", "depth"], "left"))
    p = p.join(own, ["rep", "depth"], "left").fillna(0, ["saved", "leaf"])
    p = _running(p, ["saved", "leaf"], back=True)
    nodes = staged(p.groupBy(*KEY).agg(
        F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf_run").alias("n_leaves"),
        F.sum("saved_run").alias("saved_tokens"), *[F.max(q).alias(q) for q in PARENT]), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(*[F.col(q).alias(k) for q, k in zip(PARENT, KEY)]).agg(
        F.count(F.lit(1)).alias("n_children"))
    full = (nodes.join(children, KEY, "left").join(end_lists(members), KEY, "left")
            .fillna(0, ["n_children"]).fillna({"ends_sha256": EMPTY_SHA}))
    root = nodes.where("depth = 0").select("conv_id").collect()            # one row at most
    above = nodes.select(*[F.col(k).alias(q) for k, q in zip(KEY, PARENT)], F.col("conv_id").alias("above"))
    deep = full.where("depth > 1").join(above, PARENT).withColumnRenamed("above", "parent_conv_id")
    top = full.where("depth <= 1").withColumn("parent_conv_id", F.when(
        F.col("depth") == 1, F.lit(root[0][0] if root else None)).cast("long"))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return top.select(*cols).unionByName(deep.select(*cols))


EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"     # SHA-256 of the empty string


def op13_trie(spark, sf_dir: str) -> DataFrame:
    turns, ids = rebuilt(ordered_turns(read(spark, sf_dir, "conversations")))
    return prefix_trie(turns, ids)
