"""Repair and prefix trie of conversations against plain Python, with the edge cases of the docstrings."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import duckdb
import pytest

from quarry.llm import conversation_sql, op12_repair, op13_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos long, block string, rep int, digest string, _pid long"
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


@pytest.fixture(scope="module")
def table():
    r = random.Random(4)
    says = ["Yes.", "No!", "why?", "cut off", "", "  ", "\t\n", "a b  c.", "long " * 4000 + ".", "é à。", "x?\x0b"]
    rows = []
    for c in [*range(0, 46), 100, 120, 121, 1009, 99999]:
        first = r.choice(["system", "user", "assistant"])
        for t in range(r.randrange(0, 9)):
            role = first if t == 0 else r.choice(["user", "assistant", "user", "assistant", "tool", "system"])
            rows.append((c, t + r.choice([0, 0, 0, 3]), role, r.choice(says)))
    rows += [(7, 1, "user", "same."), (7, 1, "user", "same."), (8, None, None, None), (8, 2, None, "x."), (8, 3, "user", None),
             (9, None, "", ""), (None, 1, "user", "lost."), (None, None, "assistant", "lost.")]
    rows += [(c, t, role, "shared.") for c in range(200, 260) for t, role in enumerate(["user", "assistant", "user"][:c % 3 + 1])]
    return rows


@pytest.fixture(scope="module")
def convs(spark, table):
    return spark.createDataFrame([(*x, 1, "b", 2, "d", 3) for x in table], SCHEMA).repartition(3)


def cheapest(rows):
    """(cost, audit) of rows (initial, fault) by trying edits from the last row on."""
    vec = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}
    for ini, fault in reversed(rows):
        new = {}
        for s in range(4):
            ways, st = [], s
            for k in range(4):
                if k:
                    st = NEXT[st, op12_repair.FILL[st]]
                opts = [(2, "D", st)]
                if fault not in (1, 2):
                    opts += [(5 * (fault == 3), "K", NEXT[st, ini])] if (st, ini) in NEXT else []
                    opts += [(1 + 5 * (fault == 3), "R", NEXT[st, x]) for x in "ua" if (st, x) in NEXT]
                ways += [(5 * k + c + vec[t][0], "I" * k + e + vec[t][1]) for c, e, t in opts]
            new[s] = min(ways)
        vec = new
    return vec[0]


def repaired(table):
    by, out = defaultdict(list), {}
    for c, t, role, text in table:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        by[c]
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            by[c] += [(t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for c, rows in by.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
        seen, kinds = set(), []
        for _, role, text in rows:
            last = text.rstrip(BLANKS)[-1:]
            kinds.append((role[:1], 1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0))
            seen.add((role, text))
        cost, audit = cheapest(kinds)
        state, left, pieces = 0, list(rows), []
        for e in audit:
            row = None if e == "I" else left.pop(0)
            if e != "D":
                fill = op12_repair.FILL[state]
                role = row[1] if e == "K" else op12_repair.ROLE[fill]
                pieces.append(f"{role}:{row[2] if row else ''}")
                state = NEXT[state, role[0]]
        turns = [x[0] for x in rows if x[0] is not None]
        marks = [k[0] for k in kinds]
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(f == k for _, f in kinds) for k in (1, 2, 3)],
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:])), cost, audit,
                  hashlib.sha256("\n".join(pieces).encode()).hexdigest())
    return out


def test_solve_is_cheapest_and_ascii_least():
    r = random.Random(1)
    cases = [list(x) for n in (1, 2, 3) for x in product(product("suax", (0, 1, 3)), repeat=n)][:2000]
    cases += [[(r.choice("suaax"), r.choice([0, 0, 1, 2, 3])) for _ in range(r.randrange(4, 16))] for _ in range(1500)]
    for rows in cases:
        kinds = bytes(4 * f + "suax".index(i) for i, f in rows)
        audit, end = op12_repair.solve(kinds, 0, len(kinds), 0, op12_repair.ACCEPT)
        want = cheapest(rows)[1]
        assert audit + op12_repair.TAIL[end] == want, rows
        size = r.randrange(1, 5)                                   # the same in blocks
        blocks = [kinds[i:i + size] for i in range(0, len(kinds), size)]
        costs, ranks = zip(*[op12_repair.block_costs(b) for b in blocks])
        got = ""
        for i, (b, (entry, end)) in enumerate(zip(blocks, op12_repair.border_states(list(costs), list(ranks)))):
            last = i + 1 == len(blocks)
            part, state = op12_repair.solve(b, 0, len(b), entry, op12_repair.ACCEPT if last else op12_repair.only(end))
            got += part + (op12_repair.TAIL[state] if last else "")
        assert got == want, rows


@pytest.mark.parametrize("block", [4096, 2])
def test_repair(spark, convs, table, block, monkeypatch):
    monkeypatch.setattr(op12_repair, "BLOCK", block)
    got = op12_repair.repair(op12_repair.damaged(convs), convs).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == repaired(table)
    assert len(got) == len({x[0] for x in table})


def test_repair_empty(spark, convs):
    none = convs.limit(0)
    assert op12_repair.repair(op12_repair.damaged(none), none).count() == 0


def trie(table):
    convs, seqs = defaultdict(list), {}
    for c, t, role, text in table:
        if c is not None:
            convs[c].append((t is not None, t or 0, role or "", hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    for c in convs:
        convs[c].sort()
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple((x[2], x[4]) for x in convs.get(c - c % 20, [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, s in sorted(seqs.items()):
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids = {k: [x for x in nodes if len(x) == len(k) + 1 and x[:-1] == k] for k in nodes}
    words = {k: (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0 for k, m in nodes.items()}
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = words[k] + sum(saved[x] for x in kids[k])
    return {(nodes[k][0], len(k), nodes[k[:-1]][0] if k else None, len(m), len(kids[k]), leaves[k], saved[k],
             hashlib.sha256(",".join(str(c) for c in m if seqs[c] == k).encode()).hexdigest()) for k, m in nodes.items()}


@pytest.mark.parametrize("block,ends", [(4096, 1024), (2, 3)])
def test_trie(spark, convs, table, block, ends, monkeypatch):
    monkeypatch.setattr(op13_trie, "BLOCK", block)
    monkeypatch.setattr(op13_trie, "ENDS", ends)
    got = op13_trie.prefix_trie(*op13_trie.rebuilt(op13_trie.ordered_turns(convs))).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == trie(table)


def test_trie_empty(spark, convs):
    assert op13_trie.prefix_trie(*op13_trie.rebuilt(op13_trie.ordered_turns(convs.limit(0)))).count() == 0


def test_sql_agrees(table):
    """The oracle's SQL on rows without ties in turn, which it orders by text."""
    plain = [x for x in {(c, t): (c, t, role, text) for c, t, role, text in table}.values() if x[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", plain)
    assert set(con.sql(conversation_sql.TRIE).fetchall()) == {(c, d, p, n, k, lv, s, e) for c, d, p, n, k, lv, s, e in trie(plain)}
    assert {r[0]: r[1:] for r in con.sql(conversation_sql.REPAIR).fetchall()} == repaired(plain)
