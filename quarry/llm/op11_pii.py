"""Operator 11: personal data by weak supervision (native Spark only).

Base spans (e-mail, IP, card, phone) follow four fixed patterns with checks and are always kept.  Wider patterns
give further candidates: spelled-out e-mails, IPv6 and bracketed IPs, numbers in national phone or card layouts.
Regex, gazetteer and context labelers vote +1, 0 or -1 on every candidate, base ones included;
expectation-maximisation over the counts of vote patterns, with the base spans as certain ones, estimates how often
each labeler votes so for personal and other spans, and so a posterior per pattern; a logistic regression on features of shape and
context is trained on the posteriors.  A further candidate becomes a span when its score is at least ``THRESHOLD``,
its form is not ruled out (a card number must pass its check), its form or the words before it speak for it, and it
overlaps no base span.

Everything about one document is worked out in its row by array functions, so no document is split, joined or
shuffled; only counts of vote patterns and of feature rows (both bounded by the number of patterns, not of rows)
are grouped.  The driver gets one row of sums per step of expectation-maximisation and the model's weights.

Edge cases: NULL text is empty and has no spans; empty, blank and very long texts are treated alike (patterns start
at the first character of a run, so runs of any length are read once); repeated rows give repeated results; NULL
doc_ids stay NULL; without candidates nothing is trained; an empty table gives an empty result; ``keep`` names the
columns that are carried along, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read, staged, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
THRESHOLD = 0.5
STEPS = 8                      # of expectation-maximisation at most
CELL = 4096                    # code points; overlaps are looked up by cell
RUN = 256                      # hits whose places are summed at once
# ---- fixed values: the base patterns and checks, written so that no run of characters is read twice ----------
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
# ---- wider patterns -----------------------------------------------------------------------------------------
AT = r"(?:\(at\)|\[at\]|\{at\}|<at>|＠)"
DOT = r"(?: ?[(\[{]dot[)\]}] ?| dot )"
WIDE_EMAIL = rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?: ?{AT} ?| at )[a-z0-9-]++(?:(?:\.|{DOT})[a-z0-9-]++)++"
WIDE_IP = (r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::|[0-9A-Fa-f]{1,4})(?::[0-9A-Fa-f]{1,4}){0,6}(?![0-9A-Za-z:])"
           r"|(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
WIDE_NUMBER = r"(?<![0-9A-Za-z_+.,:])\(?[0-9](?:[\x20.()/-]{0,2}[0-9]){6,18}+(?![0-9A-Za-z_])"
# ---- gazetteers and context words ---------------------------------------------------------------------------
DOMAINS = "com org net edu gov mil int info biz io co eu de fr es it nl be at ch pl pt se no fi dk ie uk us ca au nz jp cn in br mx ar za ru"
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
CALLING_CODES = r"^(?:\+|00)\s?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
BEFORE = {"email": r"e-?mail|mail|contact|correo|courriel|reach|write", "ip": r"\bip\b|address|host|server|client|from",
          "card": r"card|visa|master|amex|credit|payment|karte|carte|tarjeta", "phone": r"phone|tel|call|mobile|cell|fax|whatsapp|dial|handy|móvil"}
OTHER = r"(?:version|release|build|section|isbn|issn|doi|order|invoice|ticket|serial|ref|sku|pages?|lines?|\bid|\bno|#|§|\bv)\W{0,3}$"
DATE = (r"^\(?(?:(?:19|20)[0-9]{2}[-/. ][01]?[0-9][-/. ][0-3]?[0-9]|[0-3]?[0-9][-/. ][0-3]?[0-9][-/. ](?:19|20)[0-9]{2}"
        r"|(?:19|20)[0-9]{2}[01][0-9][0-3][0-9])|^[0-2]?[0-9]:[0-5][0-9](?::[0-5][0-9])?$|^(?:19|20)[0-9]{2}\s?[-/]\s?(?:19|20)[0-9]{2}$")
VOTES = ["form", "listed", "context", "other", "edges", "date"]
FEATURES = ["email", "ip", "card", "phone", "digits", "length", "marks", "listed", "context", "other", "edges", "date", "checked"]


SPAN = "struct<start:int,end:int,c:string,before:string,after:string>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once (a lambda's variable; a repeated expression would be run again)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(hits: Column, gaps: Column) -> Column:
    """start, end (code points) and text of each hit, with what stands before and after it.

    Places are summed inside runs of ``RUN`` hits that start from the sums of the runs before, so that no long
    array is copied once a hit.
    """
    def lengths(s):
        return F.zip_with(F.zip_with(s["h"], F.slice(s["g"], F.lit(1), F.size(s["h"])), lambda h, g: F.struct(h.alias("h"), g.alias("g"))),
                          F.slice(s["g"], F.lit(2), F.size(s["h"])),
                          lambda x, n: F.struct(x["h"].alias("c"), F.char_length(x["g"]).alias("lead"), F.char_length(x["h"]).alias("len"),
                                                F.right(x["g"], F.lit(40)).alias("before"), F.left(n, F.lit(20)).alias("after")))

    def runs(x):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / RUN).cast("int")), lambda i: F.slice(x, i * RUN + 1, F.lit(RUN)))

    def starts(r):
        sums = F.transform(r, lambda x: F.aggregate(x, F.lit(0), lambda a, s: a + s["lead"] + s["len"]))
        return F.aggregate(sums, F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)))

    def place(r, off):
        return F.aggregate(r, F.struct(off.alias("p"), F.array().cast(f"array<{SPAN}>").alias("o")), lambda a, s: F.struct(
            (a["p"] + s["lead"] + s["len"]).alias("p"), F.concat(a["o"], F.array(F.struct(
                (a["p"] + s["lead"]).alias("start"), (a["p"] + s["lead"] + s["len"]).alias("end"),
                s["c"].alias("c"), s["before"].alias("before"), s["after"].alias("after")))).alias("o")))["o"]

    placed = _let(F.struct(hits.alias("h"), gaps.alias("g")), lambda s: F.when(F.size(s["h"]) > 0, _let(
        lengths(s), lambda x: _let(runs(x), lambda r: F.flatten(F.zip_with(r, F.slice(starts(r), F.lit(1), F.size(r)), place))))))
    return F.coalesce(placed, F.array().cast(f"array<{SPAN}>"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """The check of card numbers on a string of digits."""
    twice = lambda i: F.substr(d, F.char_length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.char_length(d) - 1), twice), F.lit(0),
                        lambda a, v: a + v - F.when(v > 9, 9).otherwise(0))
    return (F.char_length(d) > 0) & (total % 10 == 0)


def _hits(text: Column, rx: str, there: Column, wanted) -> Column:
    """Placed matches of ``rx``, those that fail ``wanted`` dropped; texts without ``there`` are not searched."""
    found = F.filter(_places(F.regexp_extract_all(text, F.lit(rx), F.lit(0)), F.split(text, rx, -1)), wanted)
    return F.when(there, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _tagged(spans: Column, kind, base: bool) -> Column:
    number = (lambda s: F.lit(KINDS.index(kind))) if isinstance(kind, str) else kind
    return F.transform(spans, lambda s: F.struct(number(s).cast("int").alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                 F.lit(base).alias("base"), s["c"].alias("c"), s["before"].alias("before"),
                                                 s["after"].alias("after")))


def candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """row (struct of ``keep``), base and wide: arrays of placed spans with their kind, text and surroundings."""
    t = F.col("text")
    d = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), text_or_empty().alias("text"))
    card = lambda s: F.when(F.char_length(_digits(s["c"])) <= 19, luhn(_digits(s["c"]))).otherwise(False)
    phone = lambda s: F.char_length(_digits(s["c"])).between(8, 15)
    base = F.concat(
        _tagged(_hits(t, EMAIL, F.contains(t, F.lit("@")), lambda s: F.lit(True)), "email", True),
        _tagged(_hits(t, IP, t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), lambda s: s["c"].rlike(OCTETS)), "ip", True),
        _tagged(_hits(t, CARD, t.rlike(CARD), card), "card", True),
        _tagged(_hits(t, PHONE, F.contains(t, F.lit("+")), phone), "phone", True))
    spelled = t.rlike(rf"(?i)[(\[{{<]at[)\]}}>]|＠| at [a-z0-9-]++(?:\.[a-z0-9]|{DOT})")
    number_kind = lambda s: F.when(F.char_length(_digits(s["c"])) >= 13, 2).otherwise(3)
    wide = F.concat(
        _tagged(_hits(t, WIDE_EMAIL, spelled, lambda s: F.lit(True)), "email", False),
        _tagged(_hits(t, WIDE_IP, t.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:|[0-9][(\[]\.[)\]][0-9]"), lambda s: F.lit(True)), "ip", False),
        _tagged(_hits(t, WIDE_NUMBER, t.rlike(WIDE_NUMBER), lambda s: F.lit(True)), number_kind, False))
    d = d.select("row", base.alias("base"), wide.alias("wide"))
    # the base spans of each cell of the text, for the cells in which a wide one starts or ends
    cells = F.when((F.size("wide") > 0) & (F.size("base") > 0), F.transform(
        F.sequence(F.lit(0), F.floor(F.array_max(F.transform("wide", lambda w: w["end"])) / CELL).cast("int")),
        lambda k: F.filter("base", lambda b: (b["start"] < (k + 1) * CELL) & (b["end"] >= k * CELL))))
    d = d.select("row", "base", "wide", cells.alias("cells"))

    def free(w):
        near = lambda at: F.element_at(F.col("cells"), F.floor(at / CELL).cast("int") + 1)
        meets = lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])
        return F.col("cells").isNull() | ~(F.exists(near(w["start"]), meets) | F.exists(near(w["end"]), meets))

    return d.select("row", "base", F.filter("wide", free).alias("wide"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(F.coalesce(yes, F.lit(False)), 1).when(F.coalesce(no, F.lit(False)), -1).otherwise(0)


def _by_kind(s: Column, pairs: list[Column]) -> Column:
    out = F.when(s["kind"] == 0, pairs[0])
    for k in (1, 2):
        out = out.when(s["kind"] == k, pairs[k])
    return out.otherwise(pairs[3])


def _labelled(s: Column) -> Column:
    """A span with the labelers' votes and the classifier's other features."""
    c, digits, no = s["c"], _digits(s["c"]), F.lit(False)
    n = F.char_length(digits)
    before, after = F.lower(s["before"]), F.lower(s["after"])
    national = c.rlike(r"^(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$|^00[1-9]|^0[0-9]{1,4}[ /-][0-9 ]{5,}$")
    form = _by_kind(s, [
        _vote(c.rlike(f"(?i){AT}|{DOT}"), ~c.rlike("@")),
        _vote(c.rlike(r"(?i)^(?=.*[a-f])(?:[0-9a-f]{0,4}:){3,7}[0-9a-f]{0,4}$|[(\[]\.[)\]]"), F.lit(True)),
        _vote(n.between(13, 19) & luhn(digits), F.lit(True)), _vote(national, c.rlike(r"^[0-9]+$") | (n < 9))])
    tail = F.lower(F.regexp_extract(c, r"([A-Za-z0-9-]+)$", 1))
    listed = _by_kind(s, [
        _vote(tail.isin(DOMAINS.split()), F.lit(True)), _vote(no, c.rlike(r"^(?:0|22[4-9]|2[3-5][0-9])[.\[(]")),
        _vote(c.rlike(CARD_ISSUERS), F.lit(True)), _vote(c.rlike(CALLING_CODES) | ((n == 10) & digits.rlike("^[2-9]")), no)])
    context = _by_kind(s, [_vote(before.rlike(BEFORE[k]), no) for k in KINDS])
    edges = _vote(no, s["before"].rlike(r"[A-Za-z0-9_/=#-]$") | s["after"].rlike(r"^[A-Za-z0-9_/=]"))
    return F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"),
        F.when(s["base"], 1).otherwise(form).alias("form"), listed.alias("listed"), context.alias("context"),
        _vote(no, before.rlike(OTHER)).alias("other"), edges.alias("edges"), _vote(no, c.rlike(DATE)).alias("date"),
        *[(s["kind"] == i).cast("int").alias(k) for i, k in enumerate(KINDS)],
        F.least(n, F.lit(20)).alias("digits"), F.least(F.char_length(c), F.lit(40)).alias("length"),
        F.size(F.array_distinct(F.regexp_extract_all(c, F.lit(r"[^A-Za-z0-9]"), F.lit(0)))).alias("marks"),
        ((s["kind"] == 2) & luhn(digits)).cast("int").alias("checked"))


def labelled_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """row and spans: base and wide spans with votes and features, written once."""
    c = candidates(docs, keep)
    return staged(c.select("row", F.transform(F.concat("base", "wide"), _labelled).alias("spans")), "pii-spans")


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def posterior(patterns: DataFrame, steps: int = STEPS) -> Column:
    """Expectation-maximisation over ``patterns`` (kind, base, votes, n): the probability that a span is personal data.

    Base spans are certain, so they hold the two classes in place.  Start for the others: the labelers' majority.
    Pseudo-counts keep a labeler from being turned round by few votes.
    """
    certain = lambda p: F.when(F.col("base"), 1.0).otherwise(p)
    more = {(1, 1): 8.0, (1, 0): 4.0, (1, -1): 1.0, (0, 1): 1.0, (0, 0): 4.0, (0, -1): 8.0}
    post, last = certain(_sigmoid(1.5 * sum((F.col(v) for v in VOTES), F.lit(0)))), None
    for _ in range(steps):
        w = {1: F.col("n") * post, 0: F.col("n") * (1 - post)}
        sums = patterns.agg(
            *[F.sum(F.when(F.col("kind") == k, w[y]).otherwise(0.0)).alias(f"k{k}_{y}") for k in range(4) for y in (0, 1)],
            *[F.sum(F.when(F.col(v) == x, w[y]).otherwise(0.0)).alias(f"{v}{x}_{y}") for v in VOTES for x in (-1, 0, 1) for y in (0, 1)]
        ).first()
        prior = [math.log((5 + (sums[f"k{k}_1"] or 0)) / (5 + (sums[f"k{k}_0"] or 0))) for k in range(4)]
        lo = F.element_at(F.array(*[F.lit(p) for p in prior]), F.col("kind") + 1)
        now = list(prior)
        for v in VOTES:
            total = {y: sum((sums[f"{v}{x}_{y}"] or 0) + more[y, x] for x in (-1, 0, 1)) for y in (0, 1)}
            ratio = [math.log(((sums[f"{v}{x}_1"] or 0) + more[1, x]) / total[1]) - math.log(((sums[f"{v}{x}_0"] or 0) + more[0, x]) / total[0])
                     for x in (-1, 0, 1)]
            lo = lo + F.element_at(F.array(*[F.lit(r) for r in ratio]), F.col(v) + 2)
            now += ratio
        post = certain(_sigmoid(lo))
        if last is not None and max(abs(a - b) for a, b in zip(now, last)) < 1e-2:
            break
        last = now
    return post


def span_weights(spans: DataFrame) -> tuple[list[float], float] | None:
    """Weights and intercept of the span classifier, trained on the posteriors of all candidates."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    names = list(dict.fromkeys(["kind", "base", *VOTES, *FEATURES]))
    rows = staged(spans.select(F.explode("spans").alias("s")).groupBy(*[F.col(f"s.{x}").alias(x) for x in names])
                  .agg(F.count(F.lit(1)).alias("n")), "pii-rows")
    patterns = staged(rows.groupBy("kind", "base", *VOTES).agg(F.sum("n").alias("n")).coalesce(1), "pii-patterns")
    if not patterns.take(1):
        return None
    p = rows.withColumn("post", posterior(patterns))
    both = p.select(*FEATURES, F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("post")).alias("weight")),
                                                 F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("post"))).alias("weight")))).alias("y"))
    vec = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = LogisticRegression(weightCol="weight", regParam=0.001, maxIter=50).fit(
        vec.transform(both.select(*FEATURES, "y.label", "y.weight").where("weight > 0").coalesce(2)))
    return [float(x) for x in model.coefficients], float(model.intercept)


def find_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """row (struct of ``keep``), base and spans: arrays of (kind, start, end, base, score), by kind and start."""
    found = labelled_spans(docs, keep)
    model = span_weights(found)

    def scored(s):
        lo = F.lit(model[1])
        for w, f in zip(model[0], FEATURES):
            lo = lo + F.lit(w) * s[f]
        return F.struct(*[s[x].alias(x) for x in ("kind", "start", "end", "base")],
                        F.when((s["form"] >= 0) & (s["form"] + s["context"] > 0), _sigmoid(lo)).otherwise(0.0).alias("score"))

    spans = F.col("spans") if model else F.filter("spans", lambda s: F.lit(False))
    shaped = F.transform(spans, scored) if model else F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,score:double>>")
    found = found.select("row", F.array_sort(F.filter(shaped, lambda s: s["base"] | (s["score"] >= THRESHOLD))).alias("spans"))
    return found.select("row", F.filter("spans", lambda s: s["base"]).alias("base"), "spans")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets (of overlapping ones the first)."""
    f = find_spans(docs, docs.columns)
    order = F.array_sort("spans", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    text = F.col("row.text").cast("string")
    cut = F.aggregate(order, F.struct(F.lit(0).alias("p"), F.lit("").alias("t")), lambda a, s: F.when(
        s["start"] >= a["p"], F.struct(s["end"].alias("p"), F.concat(
            a["t"], F.substr(text, a["p"] + 1, s["start"] - a["p"]), F.lit("["),
            F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), F.lit("]")).alias("t"))).otherwise(a),
        lambda a: F.concat(a["t"], F.substr(text, a["p"] + 1, F.char_length(text))))
    masked = F.when(F.size("spans") > 0, cut).otherwise(text)
    return f.select(*[masked.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def _joined(spans: str) -> Column:
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def op11_pii(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    f = find_spans(docs.select("doc_id", "text"), ["doc_id"])
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return f.select("row.doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                    F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
