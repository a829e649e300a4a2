"""Personal data: base spans against Python's regular expressions, wider spans on a small corpus, masking."""

import random
import re

import pytest

from quarry.llm import op11_pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]
WIDE = ["call (555) 234-5678", "phone 555-234-5678", "mail john.doe [at] example [dot] com", "write to mary (at) mail.org",
        "server 10[.]1[.]2[.]3", "from 2001:db8:0:1:1:0:0:1", "tel 030 1234 5678", "card 3782 822463 10005"]
OTHER = ["order 123456789012", "at 12:30:45 today", "on 2024-01-15 we", "look at noon.then", "version 20240115123",
         "ISBN 978-0-306-40615-7", "pages 1234 5678 9012", "value 4111111111111112 x"]
BASE = ["a.b@c.de", "+1 (523) 555-1055", "8.8.4.4", "4111 1111 1111 1111", "x@y.z@q.r", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8",
        "999.1.1.1 001.02.3.4", "+12 +1 2-", "4111-1111-1111-1112 4111111111111111", "é@b.c ✉ü.a@b-.-c", "+49 30 1.2.3.4 99", "@a.b", "a@b"]


def luhn(d):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    good = [lambda m: True, lambda m: all(int(x) <= 255 for x in m.split(".")),
            lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)), lambda m: 8 <= len(digits(m)) <= 15]
    return [(k, m.start(), m.end()) for k, rx in enumerate(PATTERNS) for m in re.finditer(rx, text or "") if good[k](m.group())]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    words = "alpha beta gamma delta the of a run to house tree river é".split()
    text = lambda x: " ".join(r.choices(words, k=8)) + f" {x} " + " ".join(r.choices(words, k=6))
    out = [(i, text(r.choice(BASE))) for i in range(200)]
    out += [(1000 + i, text(x)) for i, x in enumerate(WIDE * 5)] + [(2000 + i, text(x)) for i, x in enumerate(OTHER * 20)]
    return out + [(None, None), (None, "a@b.cd"), (5, ""), (5, " "), (6, "x" * 5000), (7, "1" * 3000), (8, "1 " * 2000), (9, "a@b.c " * 900),
                  (10, "+1 " * 2000), (11, "1.2.3.4 " * 700 + "555-234-5678 " * 20), (12, "a@b.cd"), (12, "a@b.cd")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*x, "r", 1) for x in rows], "doc_id long, text string, row string, base int").repartition(3)


def test_spans(spark, docs, rows):
    got = op11_pii.find_spans(docs, ["doc_id", "text"]).select("row.*", "base", "spans").collect()
    assert len(got) == len(rows)
    for x in got:
        assert [(s.kind, s.start, s.end) for s in x.base] == base(x.text), x.text
        assert {(s.kind, s.start) for s in x.base} <= {(s.kind, s.start) for s in x.spans}
        assert not any(a.start < b.end and b.start < a.end for a in x.spans if not a.base for b in x.base)
    more = {x.doc_id: [x.text[s.start:s.end] for s in x.spans if not s.base] for x in got if x.doc_id and x.doc_id >= 1000}
    for i, x in enumerate(WIDE * 5):
        assert len(more[1000 + i]) == 1 and more[1000 + i][0] in x
    assert not any(more[2000 + i] for i in range(len(OTHER) * 20))


def test_redact(spark, docs):
    got = {r.doc_id: r for r in op11_pii.redact(docs.where("doc_id >= 1000 or doc_id = 9")).collect()}
    assert got[9].text == "[email] " * 900
    assert "[email]" in got[1002].text and "john" not in got[1002].text
    assert got[1002].row == "r" and op11_pii.redact(docs).columns == docs.columns


def test_empty(spark, docs):
    assert op11_pii.find_spans(docs.limit(0), ["doc_id"]).count() == 0
    none = op11_pii.find_spans(docs.where("text like 'xxx%'"), ["doc_id"]).collect()
    assert [len(r.spans) for r in none] == [0]


def test_posterior(spark):
    """Expectation-maximisation learns that a labeler which disagrees with the others tells little."""
    from pyspark.sql import functions as F
    r, rows = random.Random(2), {}
    for _ in range(4000):
        y = r.random() < 0.5
        votes = tuple((1 if y else -1) if r.random() < p else (-1 if y else 1) for p in (0.9, 0.85, 0.8, 0.5, 0.8, 0.85))
        rows[votes] = rows.get(votes, 0) + 1
    p = spark.createDataFrame([(3, False, *v, n) for v, n in rows.items()], "kind int, base boolean, " + ", ".join(f"{v} int" for v in op11_pii.VOTES) + ", n long")
    got = p.withColumn("post", op11_pii.posterior(p)).collect()
    by = {tuple(x[v] for v in op11_pii.VOTES): x.post for x in got}
    flips = [abs(by[v] - by[w]) for v in by for w in [(*v[:3], -v[3], *v[4:])] if w in by]
    assert max(flips) < 0.3
    assert all(q > 0.9 for v, q in by.items() if sum(v[:3] + v[4:]) >= 4)
    assert p.select(F.max(op11_pii.luhn(F.lit("4111111111111111")))).first()[0] is True
