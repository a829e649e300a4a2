"""Operators of quarry.llm against brute force on small fixtures, with the edge cases of the docstrings."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import (blocks, op1_secrets, op2_ngram_join, op3_suffix_dedup, op4_packing, op5_mixing, op6_toxicity,
                        op7_rans, op8_lattice, op9_html, op10_lz)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, task string"


def words(r, n):
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]) + str(r.randrange(40))
                    for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    base = [words(r, r.randrange(60, 300)) for _ in range(12)]
    out = [(i, t) for i, t in enumerate(base)]
    out += [(20 + i, base[0]) for i in range(5)]                                 # copies
    out += [(30 + i, base[1].replace("alpha", f"near{i}", 1)) for i in range(4)]  # near copies
    out += [(40, None), (41, ""), (42, "   "), (43, "One two."), (44, "one two."), (45, "é " * 150), (None, "no id here"),
            (46, "long " * 3000), (47, base[2] + " tail"), (48, words(r, 20) + " " + base[3][:260]), (3, base[3])]
    return [(i, t, "en", None if (i or 0) % 7 == 6 else f"s{(i or 0) % 4}", 0, "x") for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_jaccard_join(spark, docs, rows):
    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    sets = [grams(t) for _, t, *_ in rows]
    want = sorted((i if i is not None else -1, sum(1 for b, s in enumerate(sets) if b != a and sets[a] and s
                                                   and len(sets[a] & s) >= 0.8 * len(sets[a] | s)))
                  for a, (i, *_) in enumerate(rows))
    got = op2_ngram_join.jaccard_join(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_links) for r in got) == want
    assert {r.component_id for r in got if r.doc_id in (0, 20, 24)} == {0}
    assert op2_ngram_join.jaccard_join(empty(spark)).count() == 0


def test_jaccard_join_of_long_chains_and_large_clusters(spark):
    r = random.Random(8)
    stream = words(r, 1200).split()
    chain = [" ".join(stream[12 * k:12 * k + 200]) for k in range(60)]            # each is near the next two at most
    base = words(r, 200).split()
    tight = [" ".join(base[:7 * k] + [f"new{k}"] + base[7 * k + 1:]) for k in range(20)]
    texts = chain + tight + chain[:3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(5, chain[5])] * 40, "doc_id long, text string")
    grams = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    near = [[b for b in range(len(texts)) if b != a and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])]
            for a in range(len(texts))]
    want = {a: len(n) + 40 * (a == 5 or 5 in n) for a, n in enumerate(near)}      # 40 repeated rows of document 5
    for size in (2, 512):                          # clusters of many chunks, and of one
        got = op2_ngram_join.jaccard_join(df, max_items=size).collect()
        assert len(got) == len(texts) + 40
        assert {g.doc_id: g.n_links for g in got} == want
        assert {g.component_id for g in got if g.doc_id in range(60) or g.doc_id > 79} == {0}
        assert {g.component_id for g in got if 60 <= g.doc_id < 80} == {60}


def test_chains_are_compared_by_bucket(spark):
    chain = [(1, k, 10, [k, -1 - k, 1000 + k // 2]) for k in range(200)] + [(1, 200 + k, 10, [k + 1, -300 - k, 5000 + k]) for k in range(199)]
    tight = [(2, 1000 + k, 10, [10_000, 10_001, 10_002]) for k in range(100)]
    m = spark.createDataFrame(chain + tight + [(3, 5000, 10, [9]), (3, 5001, 10, [9])],
                              "root long, node long, size long, keys array<long>")
    got = {r.node: r for r in blocks.placed(m, 10, 10_000, "test").collect()}
    assert len(got) == 501
    assert all(r.split == (r.root == 1) for r in got.values())
    assert {s.chunks for r in got.values() if r.root == 1 for s in r.spots} == {1}
    assert {(s.root, s.chunks) for r in got.values() if r.root == 2 for s in r.spots} == {(2, 10)}
    pairs = blocks.spread(blocks.placed(m, 10, 10_000, "test").drop("root")).where("root = 2 and i >= 0")
    assert blocks.spread(blocks.placed(m, 10, 10_000, "test").drop("root")).where("(mine < 0) <> split or (i < 0) <> (j < 0)").count() == 0
    assert pairs.count() == 1000 and pairs.where("i > j or (mine <> i and mine <> j)").count() == 0
    keys = np.array([[1, 5, 9], [1, 6, 9], [2, 5, 9]])
    assert (blocks.first_shared(keys, 9) == np.array([[0, 0, 0], [0, 0, 1], [0, 1, 0]])).all()


def test_suffix_dedup(spark, docs, rows):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = {}
    for _, b in texts:
        for p in range(len(b) - 199):
            seen[b[p:p + 200]] = seen.get(b[p:p + 200], 0) + 1
    want = []
    for i, b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                gone[p:p + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want.append((-1 if i is None else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    for limit in (2000, 0):                    # suffix order, and every key spread by window
        got = op3_suffix_dedup.remove_repeats(docs, limit).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                      for r in got) == sorted(want)
    assert op3_suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_longest_previous_factor():
    data = np.frombuffer(b"abracadabra_abracadabra", np.uint8)
    lpf = op3_suffix_dedup.longest_previous_factor(data, np.arange(len(data)), 16)
    want = [max((next((k for k in range(len(data) - i) if data[j + k] != data[i + k]), len(data) - i) for j in range(i)),
                default=0) for i in range(len(data))]
    assert lpf.tolist() == want


def test_packing(spark, docs, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(op4_packing.word_bpe_path())
    tok.encode_special_tokens = True
    got = op4_packing.pack_documents(docs).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    for i, t, *_ in rows:
        if i == 3:
            continue                            # two rows share this id
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert b"".join(b for _, b in sorted(pieces[i])) == ids.tobytes()
    used = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096
    assert sum(used.values()) > 4096 * (len(used) - 1)
    assert op4_packing.pack_documents(empty(spark)).count() == 0


def test_best_fit_decreasing():
    r = random.Random(1)
    items = [r.randrange(1, 65) for _ in range(500)]
    hist = {k: items.count(k) for k in set(items)}
    fill, plain = {}, []
    for length, rank, n, first, at, per in op4_packing.best_fit_decreasing(hist, 64):
        for j in range(n):
            fill.setdefault(first + j // per, []).append(length)
    for x in sorted(items, reverse=True):       # one by one
        fit = [k for k, c in enumerate(plain) if c >= x]
        k = min(fit, key=lambda k: plain[k]) if fit else len(plain)
        if not fit:
            plain.append(64)
        plain[k] -= x
    assert sorted(64 - sum(v) for v in fill.values()) == sorted(plain)


def test_mixing(spark, docs, rows):
    got = op5_mixing.mix(docs).collect()
    assert len(got) == len(rows)
    per = {}
    for r in got:
        per.setdefault(r.source, [r.source_size, r.target, 0])[2] += r.taken
        assert r.taken <= 3 * r.size
    assert abs(sum(v[1] for v in per.values()) - sum(v[0] for v in per.values())) < 1e-6
    assert all(v[1] <= 3 * v[0] + 1e-9 for v in per.values())
    assert op5_mixing.sample(docs).columns == docs.columns
    assert op5_mixing.sample(docs).count() == sum(r.copies for r in got)
    assert op5_mixing.mix(empty(spark)).count() == 0


def test_toxicity(spark):
    r = random.Random(2)
    rows = [(i, words(r, 40) + (" you utter idiot" if i % 5 == 0 else ""), "en", "s", 0, "x") for i in range(400)]
    docs = spark.createDataFrame(rows + [(900, None, "en", "s", 0, "x"), (901, "", "en", "s", 0, "x")], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    model = op6_toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in op6_toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.7) == (i % 5 == 0) for i in range(400))
    assert 0 <= got[900] == got[901] < 0.7
    assert op6_toxicity.keep_clean(docs, model).count() == 322
    none = op6_toxicity.train(docs, labels.where("false"))
    assert max(r.score for r in op6_toxicity.score(docs, none).collect()) < 0.01
    assert op6_toxicity.score(empty(spark), model).count() == 0


def test_toxicity_from_positives_alone(spark):
    r = random.Random(3)
    rows = [(i, words(r, 40) + (" you utter idiot" if i % 5 == 0 else ""), "en", "s", 0, "x") for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1, 1) for i in range(0, 300, 5)], "doc_id long, quality int, toxic int")
    for prior in (None, 0.2):
        model = op6_toxicity.train(docs, labels, prior=prior)
        got = {x.doc_id: x.score for x in op6_toxicity.score(docs, model).collect()}
        assert all((got[i] >= 0.7) == (i % 5 == 0) for i in got)
    assert {d.doc_id for d in op6_toxicity.keep_clean(docs, model).collect()} == {i for i in range(600) if i % 5}


def test_toxicity_gradient_and_prior():
    g = np.random.default_rng(1)
    data = lambda n, lift: [sorted(np.flatnonzero(g.random(12) < np.where(np.arange(12) < 4, lift, 0.3)).tolist()) for _ in range(n)]
    pos, unl = data(200, 0.7), data(300, 0.1) + data(60, 0.7)
    p, u = op6_toxicity._flat(pos), op6_toxicity._flat(unl)
    w, b = g.normal(size=12) * 0.2, -0.3
    assert op6_toxicity.risk_parts(w, b, p, u, 0.2)[1] > 0
    got = op6_toxicity.risk_gradient(w, b, p, u, 0.2)
    total = lambda x: sum(op6_toxicity.risk_parts(x[:-1], x[-1], p, u, 0.2))
    x0, eps = np.append(w, b), 1e-6
    want = [(total(x0 + eps * e) - total(x0 - eps * e)) / (2 * eps) for e in np.eye(13)]
    assert np.allclose(got, want, atol=1e-7)
    x = x0 * 0 + np.append(np.zeros(12), -30.0)                     # everything called negative: the second part is below zero
    back = op6_toxicity.risk_gradient(x[:-1], x[-1], p, u, 0.9)
    if op6_toxicity.risk_parts(x[:-1], x[-1], p, u, 0.9)[1] < 0:
        part = lambda y: -op6_toxicity.risk_parts(y[:-1], y[-1], p, u, 0.9)[1]
        assert np.allclose(back, [(part(x + eps * e) - part(x - eps * e)) / (2 * eps) for e in np.eye(13)], atol=1e-6)
    assert 0.1 < op6_toxicity.estimate_prior(pos, unl, 12) < 0.3    # 60 of 360


def test_rans(spark, docs, rows):
    r = np.random.default_rng(3)
    for ids in (r.zipf(1.3, 200_001) % 50257, np.zeros(70_000), np.array([7]), np.arange(50257)):
        ids = ids.astype(np.uint32)
        assert (op7_rans.decode_ids(*op7_rans.encode_ids(ids)) == ids).all()
    table, blocks = op7_rans.encode_ids(np.arange(1000, dtype=np.uint32))
    broken = bytearray(blocks[0])
    broken[-1] ^= 1
    with pytest.raises(ValueError):
        op7_rans.decode_ids(table, [bytes(broken)])
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(op7_rans.byte_bpe_path())
    tok.encode_special_tokens = True
    got = op7_rans.read_files(op7_rans.write_files(docs, op7_rans.byte_bpe_path(), 0)).orderBy("start").collect()
    at = 0
    text = {i: t for i, t, *_ in rows}
    for g in got:
        ids = np.array(tok.encode(text[g.doc_id] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert [g.doc_id for g in got] == sorted((i for i, *_ in rows), key=lambda i: -1 if i is None else i)
    files = op7_rans.write_files(empty(spark), op7_rans.byte_bpe_path(), 0)
    assert op7_rans.read_files(files).count() == 0


def test_lattice(spark):
    y = np.random.default_rng(0).normal(size=(200, 8))
    p = op8_lattice.nearest_e8(y)
    best = ((y - p) ** 2).sum(1)
    for v in op8_lattice.e8_roots():
        assert (best <= ((y - p - v) ** 2).sum(1) + 1e-9).all()
    r = np.random.default_rng(1)
    base = r.normal(size=(40, 16))
    x = np.concatenate([base, base[:20] + 0.05 * r.normal(size=(20, 16)), base[:5], 3 * base[5:8]])
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    rows += [(100, None, 1), (101, [0.0] * 16, 1), (102, [float("nan")] * 16, 1), (103, base[0].tolist(), None), (104, [1.0, None], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {g.vec_id: g for g in op8_lattice.near_vectors(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & (np.arange(len(x))[:, None] % 2 == np.arange(len(x))[None] % 2)
    np.fill_diagonal(link, False)
    found = sum(g.n_links for g in got.values())
    assert 0.9 * link.sum() <= found <= link.sum()
    assert len(got) == len(rows) and all(got[i].n_links == 0 and got[i].kept for i in range(100, 105))
    assert op8_lattice.near_vectors(df.where("false")).count() == 0


def test_html(spark):
    page = ("<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><div class='ad'>buy</div><article>"
            "<h1>Head &amp; line</h1><p>First <b>bo</b>ld paragraph that is long enough.<p>Second&nbsp;one, also long."
            "</article><div class=comments><p>reader words</p></div><footer>foot</footer></body></html>")
    assert op9_html.main_text(page) == "Head & line First bold paragraph that is long enough. Second one, also long."
    assert op9_html.main_text(None) == op9_html.main_text("") == ""
    assert op9_html.main_text("<p>" * 5000 + "deep") == "deep"
    assert op9_html.main_text("<div>" * 5000 + "deep text <span") == "deep text"
    df = spark.createDataFrame([(1, "u", page), (2, None, None)], "page_id long, url string, html string")
    assert {r.page_id: r.n_chars for r in op9_html.extract(df).collect()}[2] == 0


def test_lz(spark, docs, rows):
    def phrases(t):
        seen, i = set(), 0
        for j in range(len(t)):
            if t[i:j + 1] not in seen:
                seen.add(t[i:j + 1])
                i = j + 1
        return seen
    for t in ("", "a", "aaaaaaaaaa", "abababab", rows[0][1]):
        ends = op10_lz.lz_phrases(t)
        assert {t[a:b] for a, b in zip([0, *ends], ends)} == phrases(t)
    h = {r.t: r.h for r in docs.selectExpr("coalesce(text, '') as t", "xxhash64(coalesce(text, '')) as h").collect()}
    data = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), h[r[1]]))
    got = op10_lz.compare_with_next(docs, tasks=5).collect()
    want = []
    for k, (i, t) in enumerate(data):
        cut = len(t) // 3
        edited = t[:len(t) - cut] + data[(k + 1) % len(data)][1][:cut]
        want.append((-1 if i is None else i, len(t), hashlib.sha256(edited.encode()).hexdigest(), op10_lz.fingerprint(t),
                     op10_lz.fingerprint(edited)))
    assert sorted((-1 if g.doc_id is None else g.doc_id, g.n_chars, g.edited_sha256, g.fingerprint, g.edited_fingerprint)
                  for g in got) == sorted(want)
    # 128 minimum hashes estimate the likeness of the phrase sets: four standard errors are 0.18
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    near = {}
    for k, (i, t) in enumerate(data):
        cut, after = len(t) // 3, data[(k + 1) % len(data)][1]
        near.setdefault((-1 if i is None else i, op10_lz.fingerprint(t)), []).append(
            (jaccard(phrases(t), phrases(t[:len(t) - cut] + after[:cut])), jaccard(phrases(t), phrases(after))))
    for g in got:
        assert any(abs(g.near_edited - a) < 0.18 and abs(g.near_next - b) < 0.18
                   for a, b in near[-1 if g.doc_id is None else g.doc_id, g.fingerprint]), g.doc_id
    assert op10_lz.compare_with_next(empty(spark)).count() == 0
    one = op10_lz.compare_with_next(docs.where("doc_id = 0")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0                              # its own successor


def test_lz_spreads_a_common_row(spark):
    texts = [(7, "the same words again and again")] * 300 + [(7, f"words {k}") for k in range(30)] + [(9, "first"), (None, "last")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = op10_lz.compare_with_next(df, tasks=8)
    same = got.where("n_chars = 30").groupBy("near_next").count().collect()
    assert sum(r["count"] for r in same) == 300 and {r["count"] for r in same if r.near_next == 1.0} == {299}
    assert got.count() == len(texts)
    h = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) as h").collect()}
    data = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), h[r[1]]))
    want = sorted(hashlib.sha256((t[:len(t) - len(t) // 3] + data[(k + 1) % len(data)][1][:len(t) // 3]).encode()).hexdigest()
                  for k, (_, t) in enumerate(data))
    assert sorted(r.edited_sha256 for r in got.collect()) == want
    order = [df.doc_id.desc_nulls_last(), "h", "row"]
    sizes = [r["count"] for r in df.selectExpr("doc_id", "xxhash64(text) as h", "monotonically_increasing_id() as row")
             .repartitionByRange(8, *order).selectExpr("spark_partition_id() as p").groupBy("p").count().collect()]
    assert max(sizes) < len(texts) / 3


def test_secrets(spark):
    r = random.Random(4)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(30)]
    rows = [(i, f'some words token = "{h}" and more 4929{i:012d} text mail{i}.example-host.com', "en", "s", 0, "x")
            for i, h in enumerate(hexes)]
    rows += [(90, None, "en", "s", None, "x"), (91, "", "en", "s", 0, "x"), (92, "clean text", "en", "s", 10, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = op1_secrets.scan(docs).collect()
    assert {r.candidate for r in found if r.is_secret} == set(hexes)
    for f in found:
        assert rows[f.doc_id][1][f.start:f.start + f.length] == f.candidate
    masked = {r.doc_id: r.text for r in op1_secrets.mask_secrets(docs).collect()}
    assert len(masked) == len(rows) and masked[92] == "clean text" and masked[90] is None
    assert masked[0] == rows[0][1].replace(hexes[0], op1_secrets.MASK)
    assert op1_secrets.scan(empty(spark)).count() == 0


def test_token_chunks():
    from quarry.llm.tokens import ChunkEncoder, encode_column
    odd = ["", " ", "a  b", "a\n\nb", " lead", "tail ", "x\x00y z", "don't we'll <|endoftext|>", "\n", "a\n b", "x  y z", "q ​ r"]
    for path, space in ((op7_rans.byte_bpe_path(), True), (op4_packing.word_bpe_path(), False)):
        enc, got = ChunkEncoder(path, space), []
        for _, ids, at in encode_column(enc, pa.array(odd)):
            got += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
        assert got == [enc.whole(t) for t in odd]


PARAS = "".join(f"<p>Paragraph {k} " + "of plain article text that goes on " * 10 + "</p>" for k in range(5))


def test_html_votes():
    whole = " ".join(op9_html.entities.unescape(PARAS.replace("<p>", " ").replace("</p>", " ")).split())
    menu = "<nav><a href=x>menu</a></nav>"
    for page in (f'<div class="has-sidebar">{PARAS}</div>', f'<div id="page-with-footer">{PARAS}</div>',
                 f'<form id=aspnetForm action="x">{menu}<div>{PARAS}</div></form>',
                 f'<form>{menu}<article>{PARAS}</article></form>', f'<div class="sidebar"><main>{PARAS}</main></div>',
                 f'<div class="layout widget">{menu}<div>{PARAS}</div></div>',
                 f'<article>{PARAS}</article><div class="site-footer">foot</div><div class="cookie-banner">eat them</div>',
                 f'<article>{PARAS}</article><div id=comments>' + "reader words " * 150 + "</div>",
                 f'<article>{PARAS}<div class="ad">buy</div><ul class="share"><li>tell</ul></article>'):
        assert op9_html.main_text(f"<html><body>{page}</body></html>") == whole, page[:60]
    for tag in ('<section id="related-work">', '<p class="notice">', '<div class="alert">', '<div class="ResponsiveHeader">'):
        part = f"{tag}Kept words stand here.</{tag[1:].split()[0]}>"
        for box in ("article", "div"):
            got = op9_html.main_text(f"<body>{menu}<{box}>{PARAS}{part}</{box}></body>")
            assert got == whole + " Kept words stand here.", (tag, box)
    short = "<article><h1>Short.</h1></article><footer>a much longer line at the foot of the page</footer>"
    assert op9_html.main_text(f"<body>{menu}{short}</body>") == "Short."
    assert "# why" in op9_html.main_text(f'<article>{PARAS}<pre>x <span class="comment"># why</span></pre></article>')


def test_html_layouts():
    links = "<ul>" + "".join(f'<li><a href="r{k}">Reference number {k}</a></li>' for k in range(8)) + "</ul>"
    lone = '<p><a href="x">A paragraph that is one link only</a></p>'
    plain = lambda h: " ".join(op9_html.re.sub("<[^>]*>", " ", h).split())
    second = "<div><h2>Second</h2><p>A short second section.</p></div>"
    mixed = "<section><p>" + "More text of the page. " * 6 + "</p></section>"
    for page in (f"<article>{PARAS}{links}</article>", f"<article>{links}{PARAS}</article>", f"<article>{lone}{PARAS}{lone}</article>",
                 f"<div>{PARAS}{links}</div>", f"<div>{PARAS}<div>{links}</div>{PARAS}</div>", f"{PARAS}{links}{PARAS}{lone}",
                 f"<h1>title</h1><div>{PARAS}</div>", f'<h1><a href="x">title</a></h1><div>{PARAS}</div>',
                 f"<div>{PARAS}</div>{second}", f"<h1>title</h1><div><div>{PARAS}</div>{second}</div>Last words",
                 f"<div>{PARAS}</div>{links}{mixed}{second}", f"<main><h1>title</h1>{PARAS}{links}</main>"):
        assert op9_html.main_text(f"<body>{page}</body>") == plain(page), page[:80]
    menu = '<a href="a">Home</a> | <a href="b">About us</a>'
    for page in (f"{links}<h1>title</h1><div>{PARAS}</div>{links}", f"<div>{menu}</div><h1>title</h1><div>{PARAS}</div><div>{menu}</div>",
                 f"{menu}<h1>title</h1><article>{PARAS}</article><div><h3>See</h3>{links}</div>",
                 f"<ul><li>{menu}</ul><h1>title</h1>{PARAS}<div>{menu}</div>"):
        assert op9_html.main_text(f"<body>{page}</body>") == "title " + plain(PARAS), page[:80]
    tail = links.replace("<ul>", f"<section><p>{'Words of a section. ' * 6}</p><ul>").replace("</ul>", "</ul></section>") * 2
    assert op9_html.main_text(f"<body><div>{PARAS}</div>{tail}</body>").count("Words of a section.") == 12


def test_html_density_decides():
    """Parts without a telling name: what is short and outside the densest subtree goes."""
    whole = " ".join(op9_html.re.sub("<[^>]*>", " ", PARAS).split())
    strays = ["<div class=c1>Buy two pairs of shoes today and get one for free</div>", "<p>Copyright 2024 Example Press</p>",
              "<div>Sign in / Cart</div>", '<div class="user-reviews"><p>' + "A fine read, five of five. " * 9 + "</p></div>"]
    for s in strays:
        for page in (f"{s}<div>{PARAS}</div>", f"<div>{PARAS}</div>{s}", f"<div><div>{PARAS}</div>{s}</div>", f"{s}<article>{PARAS}</article>{s}"):
            assert op9_html.main_text(f"<body>{page}</body>") == whole, page[:90]
    comments = "<div>" + "<p>I do not agree with the writer, and here is why.</p>" * 9 + "</div>"
    for box in ("article", "main"):
        assert op9_html.main_text(f"<body>Sign in<{box}>{PARAS}</{box}>{comments}Copyright</body>") == whole
        assert op9_html.main_text(f"<body><h1>T</h1><{box}>{PARAS}</{box}><h3>Comments</h3>{comments}</body>") == "T " + whole
    assert op9_html.main_text(f"<body><main><article>{PARAS}</article>{comments}</main></body>") == whole


def test_html_stray_end_tags_are_cheap():
    import time
    t0 = time.perf_counter()
    op9_html.main_text("<p>" + "<b>" * 20000 + "x" + "</i>" * 20000)
    assert time.perf_counter() - t0 < 5


def test_secrets_one_kind(spark):
    r = random.Random(6)
    odd = ["".join(r.choice("0123456789abcdef") for _ in range(40)), "0f8fad5b-d9cb-469f-a165-70867728950e", "some_file_name_2024_v2"]
    rows = [(i, f"see commit {odd[0]} or {odd[1]} in {odd[2]} and 4929{i:012d}", "en", "s", 0, "x") for i in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = op1_secrets.scan(docs).collect()
    assert {f.candidate for f in found} >= set(odd) and not any(f.is_secret for f in found)
    assert {d.doc_id: d.text for d in op1_secrets.mask_secrets(docs).collect()} == {i: t for i, t, *_ in rows}
    labels = spark.createDataFrame([(0, 0, 1)], "doc_id long, nth int, label int")
    assert [(f.doc_id, f.nth) for f in op1_secrets.scan(docs, labels).collect() if f.is_secret] == [(0, 0)]
    x = spark.createDataFrame([(k % 50 if k < 900 else k, 0, float(k >= 990)) + (0.0,) * len(op1_secrets.FEATURES) for k in range(1000)],
                              ["h", "nth", "label", *op1_secrets.FEATURES])
    train, kinds = op1_secrets.training_rows(x, 40)
    got = train.collect()
    assert kinds == {0.0, 1.0} and len(got) == len({t.h for t in got}) <= 40
    assert 2 <= sum(t.label for t in got) <= 10
    assert op1_secrets.training_rows(x, 5000)[0].count() == 150


def test_secrets_have_no_size_limits(spark):
    r = random.Random(8)
    key = lambda n: "".join(r.choice("ABCDEFabcdefghij0123456789") for _ in range(n - 1)) + "7"
    cut = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(key(64) for _ in range(260))
    dashes = "-----BEGIN PGP PRIVATE KEY BLOCK-----\n" + "\n".join(f"{key(20)}-{key(20)}" for _ in range(300)) + "\n-----END PGP PRIVATE KEY BLOCK-----"
    want = [('password = "{}"', key(300)), ("token: '{}'", key(5000)), ("{}\n\nend", cut), ("{} end", dashes),
            (f"my_password_{'x' * 40} = {{}}", "hunter2aa!"), (f"my_password_{'y' * 400}_z = {{}} end", "hunter2aab!"),
            ("a secret_" * 3000 + "b={} c", "abc123def456")]
    rows = [(None if i == 1 else i, t.format(v), "en", "s", 0, "x") for i, (t, v) in enumerate(want)]
    rows += [(90, 'password = "abc123" then xabc123y', "en", "s", 0, "x"), (91, "password" * 30000, "en", "s", 0, "x"),
             (92, "x_secret_key-" * 20000 + " = ", "en", "s", 0, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {(f.doc_id, f.candidate) for f in op1_secrets.scan(docs).collect() if f.is_secret}
    assert got == {(None if i == 1 else i, v) for i, (_, v) in enumerate(want)} | {(90, "abc123")}
    masked = {m.doc_id: m.text for m in op1_secrets.mask_secrets(docs).collect()}
    assert masked[90] == f'password = "{op1_secrets.MASK}" then xabc123y' and masked[None] == f"token: '{op1_secrets.MASK}'"
    labels = spark.createDataFrame([(None, 0, 0), (0, 0, 1)], "doc_id long, nth int, label int")
    marked = {f.doc_id: f.score for f in op1_secrets.scan(docs.where("doc_id is null or doc_id = 0"), labels).collect()}
    assert marked[None] < 0.5 < marked[0]


def test_columns_of_any_name(spark, rows):
    """Extra columns keep their names and values in the operators that return whole documents."""
    names = ["mix_size", "_pid", "_s", "size", "in_size", "mix_rank", "_copy", "_bad", "_id", "_h", "_jac_id", "jac_h", "row", "bad", "of",
             "masked", "target", "_idx", "base", "spans", "place", "n", "node", "word", "score"]
    docs = spark.createDataFrame([(i, t, lang, source, n, *[f"{c}{k}" for c in names]) for k, (i, t, lang, source, n, _) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))
    docs = docs.repartition(3)
    mixed = op5_mixing.mix(docs)
    assert mixed.count() == len(rows) and {"in_size_", "in_target", "size", "target"} <= set(mixed.columns)
    model = op6_toxicity.train(docs, spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int"))
    before = {tuple(r[c] for c in names) for r in docs.collect()}
    for out in (op5_mixing.sample(docs), op1_secrets.mask_secrets(docs), op2_ngram_join.drop_near_copies(docs), op6_toxicity.keep_clean(docs, model)):
        assert out.columns == docs.columns
        assert {tuple(r[c] for c in names) for r in out.collect()} <= before


def test_lattice_rows_have_their_own_results(spark):
    v = np.random.default_rng(3).normal(size=(3, 16))
    near = (v[0] * 1.001).tolist()
    rows = [(1, v[0].tolist(), "a"), (2, near, "a"), (3, near, "a"), (1, None, "a"), (None, near, "a"), (None, v[1].tolist(), "a"),
            (4, near, "b"), (5, v[0].tolist(), None), (1, v[2].tolist(), "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(((g.vec_id or 0, g.n_links) for g in op8_lattice.near_vectors(df).collect()))
    assert got == [(0, 0), (0, 3), (1, 0), (1, 0), (1, 3), (2, 3), (3, 3), (4, 0), (5, 0)]


def test_secrets_kinds(spark):
    r = random.Random(7)
    key = lambda n: "".join(r.choice("ABCDEFabcdefghij0123456789") for _ in range(n - 1)) + "7"
    pem = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\n" + "\n".join(key(64) for _ in range(5)) + "\n-----END RSA PRIVATE KEY-----"
    cut = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(key(64) for _ in range(3))
    want = [('password = "{}"', "hunter2!x"), ("AWS_SECRET_ACCESS_KEY={}\nnext", key(40) + "/+x"), ("token: {} end", "ghp_" + key(36)),
            ("Authorization: Bearer {}", key(32)), ("DB_PASSWORD={}\nUSER=me", "s3cr3t-pw"), ("before {} after", pem), ("{}\n\nplain words", cut),
            ("{{'api_key': '{}'}}", key(24)), ("use {} here", "AKIA" + "ABCDEFGH" + "23456789"[:8]), ("db2_password_2={} x", "abcd1234"),
            ("url ?token={}&x=1", key(20)), ("a = {}", "sk_live_" + key(24))]
    want += [(f"run{k} --api_token={{}} now", key(16 + k)) for k in range(20)]
    clean = ["0f8fad5b-d9cb-469f-a165-70867728950e is an id", "the password: required by 4096 hosts", "token = get_token2(x)",
             "secret: /var/run/secrets/db1", "password = config.password1", "see example-host1.example.com and 4929123412341234",
             "password1 is not given, tokens are counted", "mail me at name1234567890@long-host-name1.example.org"]
    rows = [(i, t.format(v), "en", "s", 0, "x") for i, (t, v) in enumerate(want)]
    clean += [f"host{k}-{key(5)}.example{k}.com and 4929{k:012d} in /usr/lib{k}/{key(6)}/file{k}.txt" for k in range(20)]
    clean += [f"token: /var/run{k}/{key(6)} and password = settings.s{key(8)} or secret = load_{key(6)}(x)" for k in range(20)]
    rows += [(100 + i, t, "en", "s", 0, "x") for i, t in enumerate(clean)]
    docs = spark.createDataFrame(rows, SCHEMA)
    text = {i: t for i, t, *_ in rows}
    found = op1_secrets.scan(docs).collect()
    for f in found:
        assert text[f.doc_id][f.start:f.start + f.length] == f.candidate
    got = {(f.doc_id, f.candidate) for f in found if f.is_secret}
    assert got == {(i, v) for i, (_, v) in enumerate(want)}, sorted((f.doc_id, f.candidate, f.score) for f in found)
    masked = {m.doc_id: m.text for m in op1_secrets.mask_secrets(docs).collect()}
    assert all(masked[i] == t.format(op1_secrets.MASK) for i, (t, _) in enumerate(want))
    assert all(masked[i] == t for i, t in text.items() if i >= 100)
    long = [(1, "a" * 300_000 + " password = '" + "b1" * 50_000, "en", "s", 0, "x"), (2, "-----BEGIN PRIVATE KEY-----" * 3000, "en", "s", 0, "x"),
            (3, "x1_" * 100_000, "en", "s", 0, "x"), (4, "-----BEGIN PRIVATE KEY-----\n" + (key(64) + "\n") * 2000, "en", "s", 0, "x")]
    assert op1_secrets.scan(spark.createDataFrame(long, SCHEMA)).count() >= 3003


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("name,keep", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_tokens_of_equal_hashes(name, keep):
    """Chunks that share the polynomial hash (Thue-Morse words and their complements) keep their own ids."""
    import public_tokenizers
    from quarry.llm.common import mix, prefix_hash, range_hash
    from quarry.llm.tokens import ChunkEncoder, encode_column
    one = thue_morse(2048)
    two = one.translate(str.maketrans("ab", "ba"))
    both = np.frombuffer((one + two).encode(), dtype=np.uint8)
    c = prefix_hash(both)
    assert len(set(mix(range_hash(c, np.array([0, 2048]), np.array([2048, 4096]))).tolist())) == 1
    enc = ChunkEncoder(public_tokenizers.path(name), keep)
    texts = [one, two, f"x {one} y {two} z", "x", two * 40, "plain words here", one * 40, "a" * 9000 + " b", "", "é" * 700, "plain words"]
    for _ in range(2):
        got = [ids[at[k]:at[k + 1]].tolist() for _, ids, at in encode_column(enc, pa.array(texts)) for k in range(len(at) - 1)]
        assert got == [enc.whole(t) for t in texts]


def test_long_words_differ():
    from quarry.llm.common import hash_words
    one = thue_morse(2048)
    data = np.frombuffer(f"{one} {one.translate(str.maketrans('ab', 'ba'))} {one}".encode(), dtype=np.uint8)
    h, _ = hash_words(data, np.array([0, len(data)]))
    assert h[0] == h[2] and h[0] != h[1]
