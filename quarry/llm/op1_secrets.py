"""Operator 1: secret scan with a random forest that removes false positives (native Spark only).

Candidates are runs of 16 or more characters of keys and tokens that hold a digit, shorter values given to
a name with a credential word (without the name), and whole private-key blocks.  Each gets features of its
length, character transitions, dictionary coverage, path form and neighbouring words; a random forest,
trained on labelled findings, gives the probability of a secret.  Key blocks and known token prefixes are
secrets whatever the forest says, unless labelled otherwise.

Labelled findings are a table (doc_id, nth, label).  Without one, ``rule_labels`` marks the clear cases:
values given to a credential-like name, quoted or not, known token prefixes and private keys are secrets;
e-mail hosts, dotted names, paths, calls, UUIDs and plain numbers are not; everything else stays unlabelled
and is only scored.

Bounds (parameters): at most ``max_labelled`` labelled findings, those of equal texts once and each kind
with its share, train the forest; the ``max_words`` words that stand in the most documents, counted over all
of them, make the dictionary.  All documents are scanned whole.

Edge cases: NULL, empty or blank text has no findings; repeated rows give repeated findings; without
labelled findings of both kinds the label is the score, and unlabelled ones stay below the threshold; very
long texts, names, values and keys are scanned like others, without a limit; labels of a NULL doc_id belong to the
texts without one; an empty table gives an empty result; other columns are not read.  Values made of letters alone
are no candidates, quoted or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read, staged, text_or_empty

THRESHOLD = 0.5
UNKNOWN = 0.25                 # score of an unlabelled candidate when nothing tells the kinds apart
MASK = "[SECRET]"
# ---- fixed values: credential words, assignment before a value, token prefixes --------------
NAMES = r"(?i)(?:token|secret|passw(?:or)?d|pwd|passphrase|api_?key|apikey|auth|bearer|credential|access_?key|private)"
ASSIGNED = r"(?i)[a-z0-9_\-]*(?:token|secret|passw(?:or)?d|pwd|passphrase|key|auth|bearer|credential)[a-z0-9_\-]*[\"']?\s*(?:=>|:=|={1,2}|:|\s)\s*[\"'`]?$"
CREDENTIAL = (r"(?i:passw(?:or)?d|pwd|passphrase|secret|token|credential|(?:api|access|private|secret|auth|account|encryption)"
              r"[_\-]?key)")
GIVEN = r"[\"'`]?\s{0,4}+(?:=>|:=|={1,2}+|:)\s{0,4}+"          # between a name and its value
# a whole name that holds a credential word, and what is between it and its value; each name is read a fixed number of times
NAME = rf"(?=[A-Za-z0-9_\-]*+{GIVEN})(?=[A-Za-z0-9_\-]*?{CREDENTIAL})[A-Za-z0-9_\-]++{GIVEN}"
NAMED = rf"^(?:{NAME}[\"'`]?)(?=\S)"                           # what stands before the value in a hit
DIRECT = rf"(?:(?<![A-Za-z0-9_\-]){NAME}|(?i:\bbearer)\s{{1,4}}+)[\"'`]?$"
PREFIXES = (r"^(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_\-]{16,}|sk-[A-Za-z0-9_\-]{20,}"
            r"|[sr]k_(?:live|test)_[A-Za-z0-9]{10,}|xox[abeoprs]-[A-Za-z0-9\-]{10,}|(?:AKIA|ASIA)[A-Z0-9]{16}$"
            r"|AIza[A-Za-z0-9_\-]{35}|npm_[A-Za-z0-9]{30,}|hf_[A-Za-z0-9]{30,}"
            r"|eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]*)")
REFERENCE = r"^[./~$%]|://|^[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+$|^(?:\d{1,4}[\-./:]){1,5}\d{1,4}$"
UUID = r"^(?i)[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$"
# a private key with its body up to its end line (or the lines of one that is cut off); a value after a credential
# word; a run of key characters that is not itself such a name
CANDIDATE = (r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
             r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
             r"|(?:(?:\s|\\[nr]){1,4}+[A-Za-z0-9+/=]{40,}+)*+)"
             rf"|(?<![A-Za-z0-9_\-]){NAME}(?:(?:\"(?=[^\s\"]{{6,}}+\")(?=[A-Za-z]*+[^A-Za-z\"])[^\s\"]++|'(?=[^\s']{{6,}}+')(?=[A-Za-z]*+[^A-Za-z'])[^\s']++"
             r"|`(?=[^\s`]{6,}+`)(?=[A-Za-z]*+[^A-Za-z`])[^\s`]++)"
             r"|(?=[^\s\"'`,;<>(){}\[\]&]*[0-9])(?=[^\s\"'`,;<>(){}\[\]&]*[A-Za-z])[^\s\"'`,;<>(){}\[\]&]{6,}+)"
             r"|(?<![A-Za-z0-9_+/.\-])(?=[A-Za-z_+/.\-]*+[0-9])"
             rf"(?!{NAME}[^\s=])[A-Za-z0-9_+/.\-]{{16,}}+={{0,2}}+")
HEADER = r"^-----BEGIN"
FEATURES = ["length", "transitions", "digits", "hex", "distinct", "vowels", "covered", "dots", "slashes", "at_before",
            "assigned", "named", "quoted_before", "quoted_after"]


def findings(docs: DataFrame) -> DataFrame:
    """A row per candidate: doc_id, h (text hash), nth, start (code points), length, candidate, before, after and given
    (the value of a name with a credential word, however long)."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    t = t.where(F.col("text").rlike(CANDIDATE))
    t = t.select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"),
                 F.split("text", CANDIDATE, -1).alias("gap"),
                 F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hit"))
    x = t.select("doc_id", "h", "row", F.posexplode(F.arrays_zip(
        F.slice("gap", F.lit(1), F.size("hit")).alias("b"), F.slice("gap", F.lit(2), F.size("hit")).alias("a"),
        F.col("hit").alias("c"))).alias("nth", "x"))
    # the name and the quote before a value are no part of the candidate
    x = x.withColumn("name", F.regexp_extract(F.col("x.c"), NAMED, 0))
    x = staged(x.select("doc_id", "h", "row", "nth",
                        F.substr(F.col("x.c"), F.char_length("name") + 1).alias("candidate"),
                        (F.char_length("x.b") + F.char_length("name")).alias("lead"),
                        F.right(F.concat(F.right(F.col("x.b"), F.lit(80)), F.col("name")), F.lit(80)).alias("before"),
                        F.left(F.col("x.a"), F.lit(40)).alias("after"), (F.col("name") != "").alias("given")), "sec-found")
    w = Window.partitionBy("row").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("lead") + F.char_length("candidate")).over(w)
    return x.select("doc_id", "h", "row", "nth", (end - F.char_length("candidate")).cast("long").alias("start"),
                    F.char_length("candidate").cast("long").alias("length"), "candidate", "before", "after", "given")


def dictionary(docs: DataFrame, max_words: int) -> list[str]:
    """The words of four or more letters that stand in the most documents (at least two), counted over all of them."""
    words = (docs.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(text_or_empty()), F.lit(r"\p{L}{4,}"), F.lit(0)))).alias("w"))
        .groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return [r["w"] for r in words.orderBy(F.col("n").desc(), "w").limit(max_words).collect()]


def _share(rx: str) -> Column:
    c = F.col("candidate")
    return (F.char_length(c) - F.char_length(F.regexp_replace(c, rx, ""))) / F.char_length(c)


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    c, low = F.col("candidate"), F.lower(F.col("candidate"))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        c, "[a-z]+", "a"), "[A-Z]+", "b"), "[0-9]+", "0"), "[^a-zA-Z0-9]+", "-")
    runs = F.regexp_extract_all(low, F.lit(r"\p{L}{4,}"), F.lit(0))
    known = F.array_intersect(runs, F.array(*[F.lit(w) for w in words])) if words else F.array().cast("array<string>")
    tail = F.regexp_extract("before", r"(\S*)$", 1)
    flag = lambda x: x.cast("double")
    return (found.withColumn("transitions", F.char_length(kinds) / F.char_length(c))
            .withColumn("digits", _share("[0-9]")).withColumn("hex", _share("[0-9a-fA-F]"))
            .withColumn("distinct", F.size(F.array_distinct(F.split(low, ""))) / F.least(F.char_length(c), F.lit(64)))
            .withColumn("vowels", _share("[aeiouAEIOU]"))
            .withColumn("covered", F.aggregate(known, F.lit(0), lambda s, w: s + F.char_length(w)) / F.char_length(c))
            .withColumn("dots", _share(r"\.")).withColumn("slashes", _share("/"))
            .withColumn("at_before", flag(tail.rlike(r"[@/\\]|www|http")))
            .withColumn("assigned", flag(F.col("given") | F.col("before").rlike(ASSIGNED)))
            .withColumn("named", flag(F.regexp_extract("before", r"((?:\S+\s+){0,3}\S*)$", 1).rlike(NAMES)))
            .withColumn("quoted_before", flag(F.col("before").rlike("[\"'`]$")))
            .withColumn("quoted_after", flag(F.col("after").rlike("^[\"'`]"))))


def rule_labels(x: DataFrame) -> Column:
    """1 for clear secrets, 0 for clear other things, NULL when unclear."""
    c = F.col("candidate")
    quoted = (F.col("quoted_before") == 1) & (F.col("quoted_after") == 1)
    plain = ((F.col("given") | F.col("before").rlike(DIRECT)) & (F.char_length(c) >= 8) & c.rlike("[0-9]") & c.rlike("[A-Za-z]")
             & ~c.rlike(REFERENCE) & ~F.col("after").rlike(r"^\s?[(\[]"))
    secret = (c.rlike(HEADER) | c.rlike(PREFIXES) | plain
              | ((F.col("assigned") == 1) & quoted & (F.col("digits") < 1) & ~c.rlike(REFERENCE)))
    other = ((F.col("digits") == 1) | c.rlike(REFERENCE) | F.col("after").rlike(r"^\s?[(\[]") | c.rlike(UUID) | F.col("candidate").rlike(r"^[0-9.\-]+$") | (F.col("at_before") == 1)
             | F.col("candidate").rlike(r"^[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+$"))
    return F.when(secret, F.lit(1)).when(other, F.lit(0)).cast("double")


def training_rows(x: DataFrame, max_labelled: int) -> tuple[DataFrame, set[float]]:
    """At most ``max_labelled`` distinct labelled rows in hash order, and their labels: findings of equal texts
    count once, and each kind has its share of the rows, but a tenth of them at least (all of a rarer kind)."""
    rows = staged(x.where("label is not null").select("h", "nth", "label", *FEATURES)
                  .dropDuplicates(["h", "nth", "label"]), "sec-labelled")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(n.values())
    take = {k: min(v, max(v * max_labelled // max(total, max_labelled), max_labelled // 10)) for k, v in n.items()}
    if n:
        most = max(take, key=lambda k: (take[k], k))
        take[most] = min(take[most], max_labelled - sum(v for k, v in take.items() if k != most))
    order = [F.xxhash64("h", "nth"), F.col("h"), F.col("nth")]
    out = rows.limit(0)
    for k in sorted(take):
        out = out.unionByName(rows.where(F.col("label") == k).orderBy(*order).limit(take[k]))
    return staged(out, "sec-train"), set(n)


def scan(docs: DataFrame, labelled: DataFrame | None = None, max_labelled: int = 20000, max_words: int = 2000,
         trees: int = 20, depth: int = 5) -> DataFrame:
    """Findings with score (probability of a secret) and is_secret."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    x = staged(with_features(findings(docs), dictionary(docs, max_words)), "sec-features")
    if labelled is None:
        x = x.withColumn("label", rule_labels(x))
    else:
        known = labelled.select(F.col("doc_id").cast("long").alias("of"), F.col("nth").alias("at"), F.col("label").cast("double").alias("label"))
        known = known.groupBy("of", "at").agg(F.max("label").alias("label"))
        x = x.join(known, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("nth") == F.col("at")), "left").drop("of", "at")
    train, kinds = training_rows(x, max_labelled)
    if len(kinds) < 2:
        scored = x.withColumn("score", F.coalesce("label", F.lit(0.0 if kinds == {0.0} else UNKNOWN)))
    else:
        vec = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth,
                                        seed=1, subsamplingRate=0.7).fit(vec.transform(train.coalesce(2)))
        scored = forest.transform(vec.transform(x)).withColumn("score", vector_to_array("probability")[1])
    certain = F.col("candidate").rlike(HEADER) | F.col("candidate").rlike(PREFIXES)   # unless labelled otherwise
    scored = scored.withColumn("score", F.when(certain & (F.coalesce("label", F.lit(1.0)) == 1), F.lit(1.0)).otherwise(F.col("score")))
    return scored.select("doc_id", "h", "nth", "start", "length", "candidate", "score",
                         (F.col("score") >= THRESHOLD).alias("is_secret"))


def mask_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with the secrets of each text replaced by a mask (and n_chars, if there, counted anew)."""
    bad = scan(docs, labelled).where("is_secret")
    bad = staged(bad.groupBy(F.col("doc_id").alias("of"), F.col("h").alias("of_h")).agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("bad")), "sec-mask")
    has = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    # the row travels as one struct, so its other columns may have any name
    d = docs.where(has).select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                               F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    j = d.join(bad, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left")
    text = F.col("row.text").cast("string")
    masked = F.aggregate(F.col("bad"), F.struct(F.lit(0).cast("long").alias("p"), F.lit("").alias("t")), lambda a, s: F.struct(
        (s["start"] + s["length"]).alias("p"),
        F.concat(a["t"], F.substr(text, (a["p"] + 1).cast("int"), (s["start"] - a["p"]).cast("int")), F.lit(MASK)).alias("t")),
        lambda a: F.concat(a["t"], F.substr(text, (a["p"] + 1).cast("int"), F.char_length(text))))
    j = j.select("row", F.when(F.col("bad").isNotNull(), masked).otherwise(text).alias("masked"), F.col("bad").isNotNull().alias("changed"))
    out = []
    for c in docs.columns:
        x = F.col("row")[c]
        if c == "text":
            x = F.col("masked")
        elif c == "n_chars":
            x = F.when(F.col("changed"), F.char_length("masked").cast(docs.schema[c].dataType)).otherwise(x)
        out.append(x.alias(c))
    return j.select(*out).unionByName(docs.where(~has))


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    f = scan(read(spark, sf_dir, "documents"))
    return f.select("doc_id", F.col("nth").cast("long").alias("nth"), "start", "length",
                    F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")
