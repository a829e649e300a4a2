"""The corpus pipeline on a small table with nulls, repeated rows and clashing column names, each stage against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from quarry.llm import op1_secrets, op5_mixing, op6_toxicity

EXTRA = ["mix_size", "_pid", "size", "in_size", "_copy", "_bad", "_id", "_h", "_jac_id", "row", "of", "place", "node", "start", "sequence_id"]


def sentence(r, n):
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]) + str(r.randrange(60)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    hexa = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    base = [sentence(r, r.randrange(30, 120)) for _ in range(40)]
    out = [(i, t) for i, t in enumerate(base)]
    out += [(100 + i, sentence(r, 40) + " you utter idiot of a fool") for i in range(20)]                    # toxic
    out += [(200 + i, base[0] + (f" tail{i}" if i else "")) for i in range(4)]                                # near copies
    out += [(300 + i, f'{sentence(r, 20)} token = "{hexa()}" {sentence(r, 5)}') for i in range(8)]             # secrets
    out += [(None, sentence(r, 50)), (None, base[5]), (None, None), (5, base[5]), (5, sentence(r, 30)), (400, ""), (401, " "), (400, "")]
    out += [(500, sentence(r, 4000))]
    return [(i, t, "en", None if k % 9 == 8 else f"s{k % 4}", len(t or ""), *[f"{c}{k}" for c in EXTRA]) for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def stages(spark, rows, tmp_path_factory):
    """The folder of the tables and the rows after every stage."""
    d = str(tmp_path_factory.mktemp("pipeline"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(100 + i, 0, 1) for i in range(12)] + [(i, 1, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in P.STAGES:
        before = docs
        docs = P.staged(stage(spark, docs, d), f"test-{name}")
        out.append((name, before, docs))
    return d, out


def plain(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages(stages):
    assert [n for n, _, _ in stages[1]] == ["toxicity", "near_copies", "secrets", "mixing", "packing"]
    for _, before, after in stages[1][:-1]:
        assert after.columns == before.columns


def test_toxic_documents_go(spark, stages):
    d, ((_, before, after), *_) = stages
    index, w, b = op6_toxicity.train(before, spark.read.parquet(f"{d}/labels.parquet"))
    keep = Counter({r: n for r, n in plain(before).items()
                    if 1 / (1 + np.exp(-(b + sum(w[index[f]] for f in op6_toxicity.text_features(r[1] or "") if f in index)))) < 0.7})
    assert plain(after) == keep
    ids = {r.doc_id for r in after.collect()}
    assert not ids & set(range(100, 120)) and set(range(40)) <= ids


def test_one_of_each_near_copy_group_stays(stages):
    _, before, after = stages[1][1]
    texts = list({(r[0], r[1] or "") for r in plain(before)})
    grams = []
    for _, t in texts:
        w = t.split()
        grams.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i][1] == texts[j][1] or (grams[i] and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])):
                if grams[i] or texts[i] == texts[j]:
                    root[find(i)] = find(j)
    groups = defaultdict(set)
    for i, t in enumerate(texts):
        groups[find(i)].add(t)
    kept = [(r.doc_id, r.text or "") for r in after.collect()]
    assert len(kept) == len(set(kept)) and all(len(g & set(kept)) == 1 for g in groups.values())
    assert plain(after).keys() <= plain(before).keys()


def test_secrets_are_masked_in_place(stages):
    _, before, after = stages[1][2]
    found = defaultdict(set)
    for f in op1_secrets.scan(before).where("is_secret").collect():
        found[f.doc_id].add((f.start, f.length))
    want = Counter()
    for r, n in plain(before).items():
        spans = sorted(found[r[0]]) if r[0] is not None and 300 <= r[0] < 308 else []
        text, at = "", 0
        for s, k in spans:
            text, at = text + r[1][at:s] + op1_secrets.MASK, s + k
        want[(r[0], text + r[1][at:], *r[2:4], len(text + r[1][at:]), *r[5:]) if spans else r] += n
    assert plain(after) == want
    assert sum("[SECRET]" in (r.text or "") for r in after.collect()) == 8
    assert not any(re.search("[0-9a-f]{40}", r.text or "") for r in after.collect())


def test_sources_reach_their_targets(stages):
    _, before, after = stages[1][3]
    size = lambda t: len(re.findall(op5_mixing.WORD, t or ""))
    by = defaultdict(list)
    for r, n in plain(before).items():
        by[r[3]] += [r] * n
    total = sum(size(r[1]) for v in by.values() for r in v)
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(by, key=lambda s: (s is None, s or "")))}
    have = {s: sum(size(r[1]) for r in v) for s, v in by.items()}
    capped: set = set()
    while True:
        level = (total - sum(3 * have[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        more = {s for s, w in weights.items() if 3 * have[s] < w * level}
        if more <= capped:
            break
        capped |= more
    want = Counter()
    for s, docs in by.items():
        docs.sort(key=lambda r: (size(r[1]), r[0] is not None and hashlib.md5(str(r[0]).encode()).hexdigest() or "", r[0] is not None, r[0] or 0))
        u = int(hashlib.md5(f"{s or ''}#42".encode()).hexdigest()[:8], 16) / 4294967296
        rate = min(3 * have[s], weights[s] * level) / have[s] if have[s] else 0.0
        for i, r in enumerate(docs):
            copies = int(np.floor(u + (i + 1) * rate) - np.floor(u + i * rate))
            want += Counter({r: copies}) if copies else Counter()
    assert plain(after) == want


def test_sequences_hold_every_token_once(stages):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    _, before, after = stages[1][4]
    pieces = after.collect()
    tokens = Counter((r.doc_id, len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in before.collect())
    per: Counter = Counter()
    for p in pieces:
        per[p.doc_id, p.doc_tokens] += p.length
    assert per == Counter({k: k[1] * n for k, n in tokens.items()})
    seq = defaultdict(list)
    for p in pieces:
        seq[p.sequence_id].append((p.offset, p.length))
    for spans in seq.values():
        at = 0
        for off, n in sorted(spans):
            assert off == at
            at += n
        assert at <= 4096


def test_run_is_the_chain(spark, stages):
    d, out = stages
    assert plain(P.run(spark, d).select("doc_id", "length", "doc_tokens")) == plain(out[-1][2].select("doc_id", "length", "doc_tokens"))
