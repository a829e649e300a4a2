"""Operator 12: repair of conversation structure by Hirschberg's divide and conquer.

A conversation is legal when its role initials read ``(s?(ua)+)?``.  Each of its rows is kept (0), given the role
user or assistant (1) or deleted (2, required for blank and repeated rows); empty user or assistant rows may be
inserted anywhere (5); a truncated row that stays costs 5.  The cheapest edits are wanted, and of those the ones
whose initials (D, I, K, R) come first in ASCII order.

Four states say what the text so far ends with: nothing, ``s``, ``u``, ``a``.  A cost vector holds, for each state,
the cost of the cheapest edits and the rank of their initials among the four.  Inserts stand before the next row's
edit, so two strings for the same rows are never a prefix of each other and ranks can be carried along: the forward
vector ranks by (rank before, edit), the backward vector by (edit, rank after).  ``solve`` lets both meet in the
middle, takes the state with the least (cost, forward rank, backward rank) and recurses: linear space.

Long conversations are cut into blocks of ``BLOCK`` rows that tasks solve independently: each block gives its 4 x 4
costs with ranks, a pass over a conversation's blocks fixes the states at the block borders, then every block is
solved between its two.  Texts meet the edits in one sorted stream per conversation.  That stream holds a batch of
rows and one block's edits; the audit is part of the result and so as long as the conversation.

Edge cases: nulls in conv_id or turn are one space in the damage key, in role and text one space (so such a text is
blank and such a role is no legal one); NULL conv_ids are one conversation; rows are taken by turn, NULL first, ties
by role and text digest; repeated rows are repeated rows; an initial is the role's first character as it stands;
very long texts are streamed; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_rank, read, staged
from .op13_trie import turn_digest
from .streams import sorted_rows

BLOCK = 4096
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}      # states: nothing, s, u, a
FILL = {0: "u", 1: "u", 2: "a", 3: "u"}                                       # the role an edit in a state must give
TAIL = {0: "", 1: "II", 2: "I", 3: ""}                                        # inserts that end a conversation legally
ACCEPT = tuple((5 * len(TAIL[s]), len(TAIL[s])) for s in range(4))            # their (cost, rank) by state
ROLE = {"u": "user", "a": "assistant"}
BLANK, REPEATED, TRUNCATED = 1, 2, 3


# ---- one block: vectors of (cost, rank) or None for the four states -----------------------------------------

@lru_cache(maxsize=None)
def steps(kind: int) -> tuple:
    """(from, to, cost, initials) of one row of a kind: 4 * fault + number of its initial in 'sua' (3: other)."""
    fault, initial = divmod(kind, 4)
    best = {}
    for start in range(4):
        state = start
        for inserts in range(3):                    # a third one only repeats the state after the first
            if inserts:
                state = NEXT[state, FILL[state]]
            edits = [("D", state, 2)]
            if fault not in (BLANK, REPEATED):
                worse = 5 if fault == TRUNCATED else 0
                if initial < 3 and (state, "sua"[initial]) in NEXT:
                    edits.append(("K", NEXT[state, "sua"[initial]], worse))
                edits.append(("R", NEXT[state, FILL[state]], 1 + worse))
            for edit, to, cost in edits:
                x = (5 * inserts + cost, "I" * inserts + edit)
                best[start, to] = min(best.get((start, to), x), x)
    return tuple((s, t, c, e) for (s, t), (c, e) in best.items())


def only(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in range(4))


def _ranked(best: list, low: int) -> tuple:
    order = {x: i for i, x in enumerate(sorted({b[1:] for b in best if b}))}
    return tuple((b[0] - low, order[b[1:]]) if b else None for b in best)


@lru_cache(maxsize=100_000)
def _forward(vec: tuple, kind: int) -> tuple[int, tuple]:
    best = [None] * 4
    for s, t, cost, edit in steps(kind):
        if vec[s]:
            x = (vec[s][0] + cost, vec[s][1], edit)
            best[t] = min(best[t] or x, x)
    low = min(b[0] for b in best if b)
    return low, _ranked(best, low)


@lru_cache(maxsize=100_000)
def _backward(vec: tuple, kind: int) -> tuple[int, tuple]:
    best = [None] * 4
    for s, t, cost, edit in steps(kind):
        if vec[t]:
            x = (cost + vec[t][0], edit, vec[t][1])
            best[s] = min(best[s] or x, x)
    low = min(b[0] for b in best if b)
    return low, _ranked(best, low)


def solve(kinds: bytes, lo: int, hi: int, entry: int, after: tuple) -> tuple[str, int]:
    """Initials of the cheapest, ASCII-least edits of rows lo to hi from state ``entry``, and the state they end in."""
    if hi - lo == 1:
        _, edit, _, t = min((c + after[t][0], e, after[t][1], t) for s, t, c, e in steps(kinds[lo]) if s == entry and after[t])
        return edit, t
    mid = (lo + hi) // 2
    f, b = only(entry), after
    for k in kinds[lo:mid]:
        f = _forward(f, k)[1]
    for k in reversed(kinds[mid:hi]):
        b = _backward(b, k)[1]
    *_, meet = min((f[s][0] + b[s][0], f[s][1], b[s][1], s) for s in range(4) if f[s] and b[s])
    left, _ = solve(kinds, lo, mid, entry, only(meet))
    right, end = solve(kinds, mid, hi, meet, after)
    return left + right, end


def block_costs(kinds: bytes) -> tuple[list, list]:
    """Costs and ranks of a block for all 16 (entry, end) pairs, -1 where there is no way; ranks hold across entries."""
    joint = {(s, s): (0, 0) for s in range(4)}
    for k in kinds:
        best = {}
        for (entry, s), (cost, rank) in joint.items():
            for f, t, c, e in steps(k):
                if f == s:
                    x = (cost + c, rank, e)
                    best[entry, t] = min(best.get((entry, t), x), x)
        order = {x: i for i, x in enumerate(sorted({b[1:] for b in best.values()}))}
        joint = {p: (b[0], order[b[1:]]) for p, b in best.items()}
    pairs = [(i, j) for i in range(4) for j in range(4)]
    return [joint.get(p, (-1, -1))[0] for p in pairs], [joint.get(p, (-1, -1))[1] for p in pairs]


def border_states(costs: list[list], ranks: list[list]) -> list[tuple[int, int]]:
    """(entry, end) of every block of one conversation, from the blocks' costs and ranks."""
    after, choice = ACCEPT, []
    for cost, rank in zip(reversed(costs), reversed(ranks)):
        best = [None] * 4
        for p, c in enumerate(cost):
            s, t = divmod(p, 4)
            if c >= 0 and after[t]:
                x = (c + after[t][0], rank[p], after[t][1], t)
                best[s] = min(best[s] or x, x)
        choice.append([b and b[3] for b in best])
        low = min(b[0] for b in best if b)
        after = _ranked([b and b[:3] for b in best], low)
    out, state = [], 0
    for c in reversed(choice):
        out.append((state, c[state]))
        state = c[state]
    return out


# ---- Spark --------------------------------------------------------------------------------------------------

def _groups(batches, key: list[str], limit: int = 2000):
    """(key values, column lists) of consecutive rows of one key in sorted batches; long keys come in several parts."""
    cur, rows = None, []
    for b in batches:
        names = b.schema.names
        for r in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]):
            k = tuple(r[names.index(x)] for x in key)
            if rows and k != cur:
                yield cur, rows
                rows = []
            cur = k
            rows.append(r)
    if rows:
        yield cur, rows


def _emit(rows, schema: pa.Schema, size: int = 500):
    buf = []
    for r in rows:
        buf.append(r)
        if len(buf) == size:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in buf], f.type) for i, f in enumerate(schema)], schema=schema)
            buf = []
    if buf:
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in buf], f.type) for i, f in enumerate(schema)], schema=schema)


def _map(df: DataFrame, rows, ddl: str) -> DataFrame:
    """mapInArrow with a generator of row tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return df.mapInArrow(lambda batches: _emit(rows(batches), schema), ddl)


def ranked_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, pos): the rows of each conversation numbered by turn; nulls in role and text one space."""
    r = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    r = r.withColumn("digest", turn_digest(F.col("role"), F.col("text")))
    r = global_rank(r, [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()], ["conv_id"], "pos")
    return r.withColumn("block", F.expr(f"pos div {BLOCK}"))


def _kinds(rows: DataFrame) -> DataFrame:
    """(conv_id, block, kinds): one byte a row, for all blocks; repeated rows are found in and across blocks."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    slim = rows.select("conv_id", "block", "pos", "digest", F.instr(F.lit("sua"), F.substring("role", 1, 1)).alias("initial"),
                       (last == "").alias("blank"), last.rlike(r"[^.!?]").alias("cut"), (F.col("role") == "").alias("bare"))
    # a digest of an earlier block of the same conversation; only conversations of several blocks have any
    long = slim.where("block > 0").select(F.col("conv_id").alias("c")).distinct()
    seen = (slim.join(long, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").groupBy("conv_id", "digest")
            .agg(F.min("block").alias("first"), F.max("block").alias("last")).where("first < last")
            .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.explode(F.sequence(F.col("first") + 1, "last")).alias("b")))
    slim = slim.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
                     & (F.col("block") == F.col("b")), "left").withColumn("old", F.col("d").isNotNull()).drop("c", "d", "b")

    def run(batches):
        for (conv, block), part in _groups(batches, ["conv_id", "block"]):
            known, out = set(), bytearray()
            for _, _, _, digest, initial, blank, cut, bare, old in part:
                fault = BLANK if blank else REPEATED if old or digest in known else TRUNCATED if cut else 0
                known.add(digest)
                out.append(4 * fault + (initial - 1 if initial and not bare else 3))
            yield conv, block, bytes(out)

    return staged(_map(sorted_rows(slim, ["conv_id", "block"], ["pos"]), run, "conv_id long, block long, kinds binary"), "repair-kinds")


def _borders(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, entry, end) for conversations of several blocks."""
    long = blocks.where("block > 0").select(F.col("conv_id").alias("c")).distinct()
    many = blocks.join(long, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")

    def costs(batches):
        for b in batches:
            for conv, block, kinds in zip(*[b.column(i).to_pylist() for i in range(3)]):
                yield conv, block, *block_costs(kinds)

    def meet(batches):
        for (conv,), part in _groups(batches, ["conv_id"]):
            for r, (entry, end) in zip(part, border_states([x[2] for x in part], [x[3] for x in part])):
                yield conv, r[1], entry, end

    m = _map(many.select("conv_id", "block", "kinds"), costs, "conv_id long, block long, cost array<long>, rank array<long>")
    return _map(sorted_rows(m, ["conv_id"], ["block"]), meet, "conv_id long, block long, entry int, end int")


def edits(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, kinds, audit): the initials of each block's edits."""
    border = _borders(blocks).select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "entry", "end")
    b = blocks.join(border, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
    last = b.groupBy("conv_id").agg(F.max("block").alias("last")).select(F.col("conv_id").alias("l"), "last")
    b = b.join(last, F.col("conv_id").eqNullSafe(F.col("l"))).select(
        "conv_id", "block", "kinds", F.coalesce("entry", F.lit(0)).alias("entry"), F.when(F.col("block") < F.col("last"), F.col("end")).alias("end"))

    def run(batches):
        for x in batches:
            for conv, block, kinds, entry, end in zip(*[x.column(i).to_pylist() for i in range(5)]):
                audit, state = solve(kinds, 0, len(kinds), entry, ACCEPT if end is None else only(end))
                yield conv, block, kinds, audit + (TAIL[state] if end is None else "")

    return _map(b, run, "conv_id long, block long, kinds binary, audit string")


class _Conversation:
    """What the sorted stream gathers about one conversation."""

    def __init__(self):
        self.sha, self.any, self.state = hashlib.sha256(), False, 0
        self.lo = self.hi = self.last_turn = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.faults, self.audit = [0, 0, 0, 0], []
        self.todo, self.at, self.kinds, self.row = "", 0, b"", 0

    def block(self, kinds: bytes, audit: str) -> None:
        self.finish()
        self.todo, self.at, self.kinds, self.row = audit, 0, kinds, 0
        self.audit.append(audit)

    def write(self, initial: str | None, piece: str) -> None:
        if self.any:
            self.sha.update(b"\n")
        self.any = True
        self.sha.update(piece.encode())
        self.state = NEXT[self.state, initial]

    def inserts(self) -> None:
        while self.at < len(self.todo) and self.todo[self.at] == "I":
            self.at += 1
            self.cost += 5
            self.write(FILL[self.state], ROLE[FILL[self.state]] + ":")

    finish = inserts                                # what is left of a block's audit are inserts

    def take(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        fault = self.kinds[self.row] >> 2
        self.row += 1
        self.faults[fault] += 1
        self.inserts()
        edit = self.todo[self.at]
        self.at += 1
        self.cost += {"K": 0, "R": 1, "D": 2}[edit] + (5 if fault == TRUNCATED and edit != "D" else 0)
        if edit == "K":
            self.write(initial, f"{role}:{text}")
        elif edit == "R":
            self.write(FILL[self.state], f"{ROLE[FILL[self.state]]}:{text}")

    def result(self, conv: int | None) -> tuple:
        self.finish()
        gaps = 0 if self.lo is None else self.hi - self.lo + 1 - self.turns
        return (conv, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The repair of every conversation of ``rows`` (conv_id, turn, role, text); ids without rows give zeros."""
    r = ranked_rows(rows)
    blocks = _kinds(r)
    none = lambda t: F.lit(None).cast(t)
    texts = r.select("conv_id", "block", "pos", "turn", "role", "text", none("binary").alias("kinds"), none("string").alias("audit"))
    plans = edits(blocks).select("conv_id", "block", F.lit(-1).cast("long").alias("pos"), none("long").alias("turn"),
                                 none("string").alias("role"), none("string").alias("text"), "kinds", "audit")
    marks = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(-1).cast("long").alias("block"), F.lit(-2).cast("long").alias("pos"), none("long").alias("turn"),
        none("string").alias("role"), none("string").alias("text"), none("binary").alias("kinds"), none("string").alias("audit"))

    def run(batches):
        conv, at = None, None
        for b in batches:
            for c, _, pos, turn, role, text, kinds, audit in zip(*[b.column(i).to_pylist() for i in range(8)]):
                if at is None or c != conv:
                    if at is not None:
                        yield at.result(conv)
                    conv, at = c, _Conversation()
                if pos == -1:
                    at.block(kinds, audit)
                elif pos >= 0:
                    at.take(turn, role, text)
        if at is not None:
            yield at.result(conv)

    return _map(sorted_rows(marks.unionByName(plans).unionByName(texts), ["conv_id"], ["block", "pos"]), run, RESULT)


def damaged(convs: DataFrame) -> DataFrame:
    """The contract's damage: crc32 of 'conv_id:turn' modulo 20 drops (0), empties (1), unstops (2), repeats (3) or reroles (4) a row."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = convs.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                     (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20).alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return d.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op12_repair(spark, sf_dir: str) -> DataFrame:
    convs = read(spark, sf_dir, "conversations")
    return repair(damaged(convs), convs)
