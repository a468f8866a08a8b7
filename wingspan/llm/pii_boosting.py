"""PII redaction: high-recall candidates scored by gradient-boosted trees.

Everything runs as DataFrame expressions and Spark ML in the JVM.

1. Base spans per kind (email, ip, card, phone): exact patterns, leftmost
   and without overlap, each match validated once.  They always stay.
2. Generators propose wider, overlapping candidates (anything around an @,
   bracketed "at"/"dot" spellings, dotted numbers, digit groups).
3. Each candidate is described by a pattern of binned format and context
   features (digit count, groups, separators, brackets, neighbours, a cue
   word before it).  Checks that decide a base match (Luhn sum, the plus
   sign, part ranges) are not features.  A candidate is a positive example
   when a validated base span of its kind coincides with it; so the trees
   learn how confirmed data look and extend that to look-alikes the base
   patterns miss.
4. All candidates of all documents are counted by pattern (a table bounded
   by the product of the bins); boosted trees are trained on the weighted
   patterns of four folds, and thresholds per generator are calibrated on
   the fifth: the lowest score whose patterns together reach
   ``min_precision``.
5. Candidates with an accepted pattern that overlap no base span are added.

Patterns use possessive quantifiers and anchored starts, which find the same
matches in linear time and without deep recursion on very long texts.  Null
texts are empty.  Without positive and negative examples nothing is added.
Offsets are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wingspan.llm.common import stored

KINDS = ["email", "ip", "card", "phone"]
MIN_PRECISION = 0.95
MIN_SUPPORT = 20
ROUNDS = 12
DEPTH = 3
FOLDS = 5
_RUN = 64
_LOCAL = "[A-Za-z0-9._%+-]"

_DIGIT_QUICK = r"[0-9]"
# kind -> (quick test, pattern)
BASE = {
    "email": ("@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]++\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?+[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# generator -> (quick test, pattern); overlapping with each other and with the base
GENERATORS = {
    "email": ("@|(?i)[\\[(]\\x20?at\\x20?[\\])]",
              r"[^\s@<>()\[\]]{1,64}+@[^\s@<>()\[\]]{3,120}+"
              r"|(?i)[A-Z0-9._%+-]{1,64}+\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Z0-9-]{1,64}+"
              r"(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?[A-Z0-9-]{2,24}+){1,4}+"),
    "ip": (r"[0-9]\.[0-9]++\.[0-9]", r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,6}+"),
    "digits": (r"[0-9]", r"\+?+\(?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+"),
}
FEATURES = ["gen", "digits", "groups", "longest", "dot", "dash", "space", "paren", "before", "after", "cue"]
_CUES = [r"(?i)(?:phone|tel|call|fax|mobile)", r"(?i)(?:mail|contact|write)", r"(?i)(?:card|visa|pay|account)",
         r"(?i)(?:ip|host|server|address)"]


def matches(text: Column, quick: str, pattern: str) -> Column:
    """array<struct<s, m, l, r>>: start, match, up to 24 characters before, one after.

    The matches are marked, the text is split at the marks, and running
    lengths give the offsets; runs of 64 pieces keep that linear in the
    number of matches.
    """
    kind = "array<struct<s:int,m:string,l:string,r:string>>"
    marked = F.regexp_replace(F.translate(text, "\u0001\u0002", "\u0003\u0003"), pattern, "\u0001$0\u0002")
    parts = F.split(marked, "[\u0001\u0002]")

    def runs(p: Column) -> Column:
        lengths = F.transform(p, lambda x: F.length(x))
        count = F.ceil(F.size(p) / F.lit(_RUN)).cast("int")
        index = F.sequence(F.lit(0), count - 1)
        sums = F.transform(index, lambda i: F.aggregate(
            F.slice(lengths, i * _RUN + 1, _RUN), F.lit(0), lambda a, x: a + x))
        offsets = F.aggregate(
            sums, F.struct(F.lit(0).alias("p"), F.array().cast("array<int>").alias("o")),
            lambda a, x: F.struct((a.p + x).alias("p"), F.concat(a.o, F.array(a.p)).alias("o")), lambda a: a.o)

        def one(i: Column, start: Column) -> Column:
            at = F.sequence(i * _RUN, F.least(i * _RUN + _RUN, F.size(p)) - 1)
            state = F.struct(start.alias("p"), F.array().cast(kind).alias("o"))

            def step(a: Column, k: Column) -> Column:
                m = F.get(p, k)
                found = F.struct(a.p.alias("s"), m.alias("m"), F.right(F.get(p, k - 1), F.lit(24)).alias("l"),
                                 F.substring(F.get(p, k + 1), 1, 1).alias("r"))
                return F.struct((a.p + F.length(m)).alias("p"),
                                F.when(k % 2 == 1, F.concat(a.o, F.array(found))).otherwise(a.o).alias("o"))
            return F.aggregate(at, state, step, lambda a: a.o)
        return F.flatten(F.zip_with(index, offsets, one))

    return F.when(text.rlike(quick), F.element_at(F.transform(F.array(parts), runs), 1)).otherwise(
        F.array().cast(kind))


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of ``m`` pass the Luhn check."""
    ds = F.split(F.reverse(digits_of(m)), "")

    def value(x: Column, i: Column) -> Column:
        d = x.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.transform(ds, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    n = F.length(digits_of(m))
    part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return {"email": F.lit(True), "ip": m.rlike(rf"^{part}(?:\.{part}){{3}}$"),
            "card": F.when(n.between(14, 19), luhn(m)).otherwise(False),
            "phone": n.between(10, 15)}[kind]


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of all validated base spans, by start then kind."""
    def of(k: int, kind: str) -> Column:
        right = F.filter(matches(text, *BASE[kind]), lambda x: valid(kind, x.m))
        return F.transform(right, lambda x: F.struct(
            x.s.alias("s"), F.lit(k).alias("k"), (x.s + F.length(x.m)).alias("e")))
    every = [of(k, kind) for k, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*every))


def pattern_of(gen: int, x: Column) -> Column:
    """The binned feature pattern of a candidate as a key of small numbers."""
    n = F.length(digits_of(x.m))
    runs = F.split(F.regexp_replace(x.m, "[^0-9]+", " "), " ")
    longest = F.array_max(F.transform(runs, lambda r: F.length(r)))
    groups = F.size(F.filter(runs, lambda r: r != ""))
    side = lambda c: (F.when(c.rlike(r"[\p{L}0-9]"), 2).when(c.rlike(r"[^\s.,;:!?\"']"), 1).otherwise(0))
    cue = F.lit(0)
    for i, p in enumerate(_CUES):
        cue = F.when(x.l.rlike(p), i + 1).otherwise(cue)
    has = lambda p: x.m.rlike(p).cast("int")
    values = [F.lit(gen), F.least(n, F.lit(20)), F.least(groups, F.lit(5)),
              F.when(longest <= 4, 0).when(longest <= 8, 1).otherwise(2),
              has(r"\."), has("-"), has(r"\x20"), has(r"[()]"),
              side(F.right(x.l, F.lit(1))), side(x.r), cue]
    return F.concat_ws(",", *[v.cast("string") for v in values])


def candidates(text: Column) -> Column:
    """array<struct<gen, s, e, n, key>> of all generators."""
    def of(g: int, quick: str, pattern: str) -> Column:
        return F.transform(matches(text, quick, pattern), lambda x: F.struct(
            F.lit(g).alias("gen"), x.s.alias("s"), (x.s + F.length(x.m)).alias("e"),
            F.length(digits_of(x.m)).alias("n"), pattern_of(g, x).alias("key")))
    every = [of(g, quick, pattern) for g, (quick, pattern) in enumerate(GENERATORS.values())]
    return F.concat(*every)


def extract(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with _base, _cands and _fold (copies of a text share a fold)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.withColumn("_base", base_spans(t)).withColumn("_cands", candidates(t))
            .withColumn("_fold", F.pmod(F.xxhash64(t), F.lit(FOLDS))))


def accepted_patterns(extracted: DataFrame, min_precision: float = MIN_PRECISION,
                      min_support: int = MIN_SUPPORT) -> list[str]:
    """Train and calibrate; the keys of the patterns whose candidates are redacted.

    The list is bounded by the product of the feature bins.
    """
    kinds = {0: [0], 1: [1], 2: [2, 3]}  # base kinds that confirm a generator's candidate
    one = extracted.select("_fold", "_base", F.explode("_cands").alias("c"))
    # a plus sign or an opening bracket may stand before a coinciding base span
    confirmed = F.exists("_base", lambda b: (F.abs(b.s - F.col("c.s")) <= 1) & (b.e == F.col("c.e")) & F.array_contains(
        F.get(F.array(*[F.array(*[F.lit(k) for k in ks]) for ks in kinds.values()]), F.col("c.gen")), b.k))
    table = stored(one.select("_fold", "c.key", confirmed.cast("long").alias("y"))
                   .groupBy("key", (F.col("_fold") == 0).alias("held"))
                   .agg(F.count("*").alias("n"), F.sum("y").alias("pos")), "pii-patterns")
    parts = F.split("key", ",")
    table = table.select("*", *[F.get(parts, F.lit(i)).cast("double").alias(f) for i, f in enumerate(FEATURES)])
    train = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)
    rows = train.filter("NOT held").select("features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("pos").cast("double").alias("w")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("pos")).cast("double").alias("w")))).alias("x"))
    rows = rows.select("features", "x.label", "x.w").filter("w > 0").coalesce(1)
    if rows.select("label").distinct().count() < 2:
        return []
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, weightCol="w", seed=7,
                          minInstancesPerNode=1).fit(rows)
    scored = (model.transform(train).select("gen", "key", "held", "n", "pos",
                                            vector_to_array("probability")[1].alias("p"))
              .groupBy("gen", "key", "p").agg(
                  F.sum(F.when(F.col("held"), F.col("n")).otherwise(0)).alias("n"),
                  F.sum(F.when(F.col("held"), F.col("pos")).otherwise(0)).alias("pos")))
    down = Window.partitionBy("gen").orderBy(F.col("p").desc()).rangeBetween(Window.unboundedPreceding, 0)
    cum = scored.withColumn("cn", F.sum("n").over(down)).withColumn("cp", F.sum("pos").over(down))
    good = cum.filter((F.col("cn") >= min_support) & (F.col("cp") >= min_precision * F.col("cn")))
    cut = good.groupBy("gen").agg(F.min("p").alias("cut"))
    return sorted(r.key for r in scored.join(cut, "gen").filter("p >= cut").select("key").distinct().collect())


def once(value: Column, f) -> Column:
    """f(value) with ``value`` evaluated once, however often f refers to it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def added_spans(keys: list[str], base: Column, cands: Column) -> Column:
    """Candidates with an accepted pattern that overlap no base span, as struct<s, k, e>."""
    if not keys:
        return F.array().cast("array<struct<s:int,k:int,e:int>>")
    taken = F.filter(cands, lambda c: c.key.isin(keys) & ~F.exists(
        base, lambda b: (b.s < c.e) & (c.s < b.e)))
    kind = lambda c: F.when(c.gen < 2, c.gen).when(c.n > 13, 2).otherwise(3)
    return F.array_distinct(F.transform(taken, lambda c: F.struct(
        c.s.alias("s"), kind(c).cast("int").alias("k"), c.e.alias("e"))))


def listing(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x.k), x.s.cast("string"), x.e.cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per row of ``docs``: id_col, _base and _spans (base and added, sorted)."""
    got = stored(extract(docs.select(F.col(id_col), F.col(text_col).alias("_text")), "_text").drop("_text"),
                 "pii-spans")
    keys = accepted_patterns(got, **params)
    return got.select(id_col, "_base", F.array_sort(F.concat(
        "_base", added_spans(keys, F.col("_base"), F.col("_cands")))).alias("_spans"))


def redact(docs: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans merge.

    The merged span takes the kind of its first part.  Texts without spans
    (null ones too) stay as they are.
    """
    found = extract(docs.select(F.col(text_col).alias("_text")), "_text").drop("_text")
    keys = accepted_patterns(stored(found, "pii-spans"), **params)
    text = F.col(text_col)
    whole = F.coalesce(text, F.lit(""))
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    kind = "array<struct<s:int,k:int,e:int>>"

    def merge(a: Column, x: Column) -> Column:  # spans come by start
        last = F.element_at(a.o, -1)
        joined = F.concat(F.slice(a.o, 1, F.size(a.o) - 1), F.array(F.struct(
            last.s.alias("s"), last.k.alias("k"), F.greatest(last.e, x.e).alias("e"))))
        return F.struct(F.greatest(a.end, x.e).alias("end"),
                        F.when((x.s < a.end) & (F.size(a.o) > 0), joined).otherwise(
                            F.concat(a.o, F.array(x))).alias("o"))

    def merged(spans: Column) -> Column:
        state = F.struct(F.lit(0).alias("end"), F.array().cast(kind).alias("o"))
        return F.aggregate(spans, state, merge, lambda a: a.o)

    def rebuilt(o: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(o, lambda x: x.e))
        kept = F.transform(starts, lambda s, i: F.substring(text, s + 1, F.coalesce(
            F.get(o, i).getField("s"), F.length(text)) - s))
        tags = F.concat(F.transform(o, lambda x: F.get(names, x.k)), F.array(F.lit("")))
        return F.array_join(F.zip_with(kept, tags, lambda a, b: F.concat(a, b)), "")

    def cleaned(found: Column) -> Column:
        spans = F.array_sort(F.concat(found.base, added_spans(keys, found.base, found.cands)))
        return once(spans, lambda x: F.when(F.size(x) > 0, once(merged(x), rebuilt)).otherwise(text))

    new = once(F.struct(base_spans(whole).alias("base"), candidates(whole).alias("cands")), cleaned)
    return docs.select(*[new.alias(c) if c == text_col else F.col(c) for c in docs.columns])
