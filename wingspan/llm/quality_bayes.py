"""Hierarchical empirical-Bayes quality classifier.

Three levels are combined per document:

* document evidence: a naive-Bayes log likelihood ratio over binned form
  features of the whole text (word count, adjacent repeats, symbol,
  separator, shouting and capital shares).  The class-conditional bin
  frequencies come from one grouped aggregation over every labelled row and
  form a table of (features x bins) cells, a fixed size.
* host level: the expected share of good documents of each host, shrunk
  towards the global share.  The prior strength is the method-of-moments
  estimate of a beta prior over the hosts, so sparse hosts move little.
* path level: the same, shrunk towards the host's posterior.

score = logistic(evidence + logit(path posterior)); a document is kept at
``threshold`` or above.  Group sums combine map-side, so a host with a
third of all rows is one row per task before the shuffle; group tables join
back null-safe and without a hint, so the planner picks broadcast or a
skew-split shuffle by their size.

Null or empty texts fall into the lowest bins; null hosts and paths are
groups of their own; without labels of both classes the evidence is 0.
Rows with repeated ids are scored one by one; of repeated labels of one id
the mean counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wingspan.llm.common import fresh, n_words, stored

THRESHOLD = 0.5
SMOOTHING = 1.0
MAX_STRENGTH = 1e6

# feature name -> upper bin edges (a value on an edge falls below it)
BINS = {
    "words": [0, 4, 9, 19, 49, 199, 999, 9999],
    "repeats": [0.0, 0.05, 0.15, 0.4],
    "symbols": [0.0, 0.02, 0.1, 0.3],
    "pipes": [0.0, 0.05, 0.2],
    "shouts": [0.0, 0.05, 0.2],
    "capitals": [0.02, 0.1, 0.3, 0.6],
}


def form_counts(text: str) -> Column:
    """Struct of the raw counts behind the features of a whole text, each pattern run once."""
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda p: F.regexp_count(t, F.lit(p))
    return F.struct(
        n_words(text).alias("words"), count(r"(?<!\S)(\S++)(?=\s\1(?!\S))").alias("repeats"),
        count(r"[#*$%&<>]++").alias("symbols"), count(r"(?<!\S)\|(?!\S)").alias("pipes"),
        count(r"!!++").alias("shouts"), count(r"\p{Lu}").alias("capitals"), F.length(t).alias("chars"))


def bins(text: str) -> Column:
    """Array of one bin number per feature, in the order of ``BINS``.

    The counts pass through a one-element array, so the conditions below
    refer to values and not to the patterns again.
    """
    def binned(c: Column, edges: list[float]) -> Column:
        b = F.lit(len(edges))
        for i in reversed(range(len(edges))):
            b = F.when(c <= edges[i], i).otherwise(b)
        return b

    def all_bins(raw: Column) -> Column:
        over = {"words": F.lit(1), "capitals": F.greatest(raw.chars, F.lit(1))}
        return F.array(*[binned(raw[n] / over.get(n, F.greatest(raw.words, F.lit(1))), edges)
                         for n, edges in BINS.items()])
    return F.element_at(F.transform(F.array(form_counts(text)), all_bins), 1)


def fit_evidence(features: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 label_col: str = "quality") -> dict[tuple[int, int], float]:
    """Log likelihood ratio of every (feature, bin) from all labelled rows.

    ``features`` has id_col and ``_bins``.  The result has at most
    sum(len(edges) + 1) entries, whatever the input size.
    """
    named = (labels.filter(F.col(label_col).isNotNull()).groupBy(id_col)
             .agg((F.avg(label_col) >= 0.5).alias("_good")))
    cells = (features.join(named, id_col).select("_good", F.posexplode("_bins").alias("f", "b"))
             .groupBy("f", "b").agg(F.sum(F.col("_good").cast("long")).alias("good"),
                                    F.count("*").alias("n")).collect())
    good = {(r.f, r.b): r.good for r in cells}
    bad = {(r.f, r.b): r.n - r.good for r in cells}
    from math import log
    out = {}
    for f, edges in enumerate(BINS.values()):
        keys = [(f, b) for b in range(len(edges) + 1)]
        g, w = (sum(d.get(k, 0) for k in keys) for d in (good, bad))
        for k in keys:
            out[k] = 0.0 if not g or not w else (
                log((good.get(k, 0) + SMOOTHING) / (g + SMOOTHING * len(keys)))
                - log((bad.get(k, 0) + SMOOTHING) / (w + SMOOTHING * len(keys))))
    return out


def evidence(weights: dict[tuple[int, int], float], bin_numbers: Column) -> Column:
    """Sum of the fitted log ratios of an array of bin numbers."""
    def total(b: Column) -> Column:
        out = F.lit(0.0)
        for f, edges in enumerate(BINS.values()):
            table = F.array(*[F.lit(weights[f, i]) for i in range(len(edges) + 1)])
            out = out + F.get(table, b[f])
        return out
    return F.element_at(F.transform(F.array(bin_numbers), total), 1)


def logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def shrunk(groups: DataFrame, keys: list[str], towards: Column, out: str) -> DataFrame:
    """Posterior mean share of each group under a beta prior around ``towards``.

    ``groups`` has keys, n and good (expected good documents).  The prior
    strength is m(1-m)/v - 1 with the mean m and the between-group variance v
    of the group shares, the sampling variance taken off.
    """
    share = F.col("good") / F.col("n")
    stat = groups.agg(
        F.sum("good").alias("g"), F.sum("n").alias("n"), F.count("*").alias("k"),
        F.sum(F.col("n") * share * share).alias("s2"))
    m = F.col("g") / F.col("n")
    within = m * (1 - m) * F.col("k") / F.col("n")
    between = F.greatest(F.col("s2") / F.col("n") - m * m - within, F.lit(0.0))
    strength = F.least(F.greatest(m * (1 - m) / F.greatest(between, F.lit(1e-12)) - 1, F.lit(1.0)),
                       F.lit(MAX_STRENGTH))
    row = stat.select(strength.alias("k")).first()
    k = F.lit(float(row.k) if row and row.k is not None else 1.0)
    return groups.select(*keys, ((F.col("good") + k * towards) / (F.col("n") + k)).alias(out))


def posteriors(scored: DataFrame, host: str, path: str) -> DataFrame:
    """(_host, _path, host_posterior, path_posterior) of every group of ``scored``.

    ``scored`` has the columns host and path and ``_evidence``.
    """
    base = F.lit(0.5)
    groups = stored(
        scored.select(F.col(host).alias("_host"), F.col(path).alias("_path"),
                      (1 / (1 + F.exp(-F.col("_evidence")))).alias("_p"))
        .groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum("_p").alias("good")), "quality-groups")
    total = groups.agg(F.sum("good").alias("g"), F.sum("n").alias("n")).first()
    prior = F.lit(total.g / total.n) if total.n else base
    hosts = groups.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    hosts = shrunk(hosts, ["_host"], prior, "host_posterior").withColumnRenamed("_host", "_h")
    paths = groups.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
    return shrunk(paths, ["_host", "_path", "host_posterior"], F.col("host_posterior"), "path_posterior")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    host: str = "source", path: str = "lang", label_col: str = "quality",
                    threshold: float = THRESHOLD, name: str = "_quality") -> DataFrame:
    """``docs`` with a struct column ``name``: evidence, host_posterior, path_posterior, score, kept.

    A column of that name is replaced; all others stay, whatever they are called.
    """
    compact = stored(docs.select(F.col(id_col), F.col(host).alias("_h0"), F.col(path).alias("_p0"),
                                 bins(text_col).alias("_bins")), "quality-bins")
    weights = fit_evidence(compact.select(id_col, "_bins"), labels, id_col, label_col)
    groups = posteriors(compact.withColumn("_evidence", evidence(weights, F.col("_bins"))), "_h0", "_p0")
    ev, h, p, hp, pp = (fresh(docs, c) for c in ("_evidence", "_host", "_path", "_host_posterior", "_path_posterior"))
    out = docs.withColumn(ev, evidence(weights, bins(text_col))).join(
        groups.toDF(h, p, hp, pp), F.col(host).eqNullSafe(F.col(h)) & F.col(path).eqNullSafe(F.col(p)), "left")
    score = 1 / (1 + F.exp(-(F.col(ev) + logit(F.col(pp)))))
    made = F.struct(F.col(ev).alias("evidence"), F.col(hp).alias("host_posterior"), F.col(pp).alias("path_posterior"),
                    score.alias("score"), (score >= threshold).alias("kept"))
    return out.select(*[c for c in docs.columns if c != name], made.alias(name))


def keep_good(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The documents that the classifier keeps, with the columns of ``docs``."""
    name = fresh(docs, "_quality")
    return score_documents(docs, labels, name=name, **params).filter(F.col(f"{name}.kept")).drop(name)
