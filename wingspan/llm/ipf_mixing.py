"""Mixing to target weights by iterative proportional fitting.

The token mass of the corpus is a contingency table over three axes
(source, language, topic).  Raking multiplies one factor per axis value
until the weighted table meets the target marginals of all axes; a
document's weight is the product of its three factors, and its sampling
probability that weight over the largest one; so expected token shares of
the sample are the targets, at the price of a sample that the rarest cell
keeps small.  A caller may give up the targets of the rarest cells for a
larger sample: the scale is then the weight above which cells hold no more
than ``saturation`` of the tokens, and probabilities end at 1.

The table and the factors stay DataFrames: one grouped pass over the
documents makes the cells, each raking step is one grouped sum over the
cells, and every new factor table is written to the shared folder (short
plans, cheap recovery).  A value with a third of all rows is one partial sum
per task.

A document is drawn when a hash of its id is below its probability, so
repeated rows share one decision and a rerun draws the same sample; rows
without an id are drawn by their text.  Null axis values are values of their
own.  Documents without words belong to cells like any other and weigh no
tokens; an axis value without tokens keeps the factor 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wingspan.llm.common import fresh, n_words, stored
from wingspan.operators.ordering import global_cumsum

TEMPER = 0.8
SWEEPS = 6
TOLERANCE = 1e-9
SATURATION = 0.0
# first letters of the vocabulary groups that stand in for topics
TOPIC_LETTERS = ["ab", "cd", "ef", "ghijkl", "mnop", "qrs", "tuvwxyz"]


def topic(text: str) -> Column:
    """Dominant vocabulary group of a text: t0..t6 by the initials of its longer words, else 'none'."""
    t = F.coalesce(F.col(text), F.lit(""))
    # one pattern pass keeps the initials; the groups are counted on that short string
    initials = F.lower(F.array_join(F.regexp_extract_all(
        t, F.lit("(?:^|[^A-Za-z])([A-Za-z])[A-Za-z][A-Za-z][A-Za-z]"), 1), ""))

    def counts(s: Column) -> Column:
        return F.array(*[F.length(s) - F.length(F.translate(s, x, "")) for x in TOPIC_LETTERS])

    def pick(c: Column) -> Column:  # the first of the largest counts
        most = F.array_max(c)
        return F.when(most == 0, "none").otherwise(
            F.concat(F.lit("t"), (F.array_position(c, most) - 1).cast("string")))
    return F.element_at(F.transform(F.transform(F.array(initials), counts), pick), 1)


def tempered_targets(cells: DataFrame, axis: str, given: dict | None, temper: float) -> DataFrame:
    """(value, target): the token shares of an axis raised to ``temper``, or the given shares.

    Values that ``given`` leaves out divide what is left to 1 by their
    tempered shares.  Shares are taken over the values that have tokens, so
    they add to 1 whatever the corpus holds.
    """
    mass = cells.groupBy(F.col(axis).alias("value")).agg(F.sum("tokens").alias("t"))
    mass = mass.withColumn("raw", F.pow(F.col("t").cast("double"), F.lit(float(temper))))
    named = F.lit(None).cast("double")
    for v, share in (given or {}).items():
        named = F.when(F.col("value").eqNullSafe(F.lit(v)) & (F.col("t") > 0), float(share)).otherwise(named)
    mass = mass.withColumn("named", named)
    sums = mass.agg(F.sum("named").alias("n"), F.sum(F.when(F.col("named").isNull(), F.col("raw"))).alias("f")).first()
    taken, free = float(sums.n or 0.0), float(sums.f or 0.0)
    whole = max(1.0, taken) if free else (taken or 1.0)
    left = max(0.0, whole - taken)
    share = F.coalesce(F.col("named"), F.lit(left / free if free else 0.0) * F.col("raw")) / F.lit(whole)
    return mass.select("value", share.alias("target"))


def _product(cells: DataFrame, factors: dict[str, DataFrame], without: str | None = None) -> DataFrame:
    """``cells`` with ``w``: the product of its factors (but for one axis)."""
    others = [a for a in factors if a != without]
    for a in others:
        f = factors[a].select(F.col("value").alias(f"_v_{a}"), F.col("factor").alias(f"_f_{a}"))
        cells = cells.join(f, F.col(a).eqNullSafe(F.col(f"_v_{a}")))
    w = reduce(lambda x, y: x * y, [F.col(f"_f_{a}") for a in others])
    return cells.withColumn("w", w).drop(*[f"_{p}_{a}" for a in others for p in "vf"])


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS,
         tolerance: float = TOLERANCE) -> dict[str, DataFrame]:
    """Factor table (value, factor) of each axis after raking.

    One sweep fits every axis once; it ends when a sweep moves no factor by
    more than ``tolerance`` (relative) or after ``sweeps``.
    """
    factors = {a: t.select("value", F.lit(1.0).alias("factor")) for a, t in targets.items()}
    for _ in range(sweeps):
        moved = 0.0
        for axis, target in targets.items():
            sums = (_product(cells, factors, axis).groupBy(F.col(axis).alias("_a"))
                    .agg(F.sum(F.col("tokens") * F.col("w")).alias("s")))
            old = factors[axis].select(F.col("value").alias("_o"), F.col("factor").alias("old"))
            made = (target.join(sums, F.col("value").eqNullSafe(F.col("_a")))
                    .join(old, F.col("value").eqNullSafe(F.col("_o")))
                    .select("value", F.when(F.col("s") > 0, F.col("target") / F.col("s")).otherwise(1.0)
                            .alias("factor"), "old"))
            factors[axis] = stored(made, f"rake-{axis}")
            step = factors[axis].agg(F.max(F.abs(F.col("factor") / F.col("old") - 1))).first()[0]
            moved = max(moved, step or 0.0)
        if moved <= tolerance:
            break
    return factors


def mixing_probabilities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: str = "source",
                         lang: str = "lang", topic_of: Column | None = None, targets: dict | None = None,
                         temper: float = TEMPER, sweeps: int = SWEEPS,
                         tolerance: float = TOLERANCE, saturation: float = SATURATION,
                         name: str = "_mix") -> DataFrame:
    """``docs`` with a struct ``name``: source, lang, topic, tokens, probability, kept.

    A column of that name is replaced; all others stay, whatever they are called.

    ``targets`` maps "source", "lang" or "topic" to {value: share}; axes and
    values left out follow the tempered shares of the corpus.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))
    mix, cell, share = fresh(docs, "_mix"), fresh(docs, "_cell"), fresh(docs, "_p")
    marked = docs.withColumn(mix, F.struct(
        F.col(source).alias("source"), F.col(lang).alias("lang"),
        (topic(text_col) if topic_of is None else topic_of).alias("topic"), n_words(text_col).alias("tokens")))
    cells = stored(marked.groupBy(*[F.col(f"{mix}.{a}").alias(a) for a in ("source", "lang", "topic")])
                   .agg(F.sum(f"{mix}.tokens").alias("tokens")), "mix-cells")
    goal = {a: stored(tempered_targets(cells, a, (targets or {}).get(a), temper), f"target-{a}")
            for a in ("source", "lang", "topic")}
    factors = rake(cells, goal, sweeps, tolerance)
    weighted = stored(_product(cells, factors), "mix-weights")
    heavy = weighted.filter("tokens > 0")
    if saturation > 0:
        total = heavy.agg(F.sum("tokens")).first()[0] or 0
        heavy = global_cumsum(heavy.groupBy("w").agg(F.sum("tokens").alias("tokens")), [F.col("w").desc()],
                              {"above": "tokens"}).filter(F.col("cum_above") > saturation * total)
    top = heavy.agg(F.max("w")).first()[0]
    p = weighted.select(F.struct("source", "lang", "topic").alias(cell),
                        F.least(F.col("w") / F.lit(float(top or 1.0)), F.lit(1.0)).alias(share))
    own = F.struct(f"{mix}.source", f"{mix}.lang", f"{mix}.topic")
    out = marked.join(p, own.eqNullSafe(F.col(cell)), "left")
    unit = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    made = F.struct(f"{mix}.*", F.col(share).alias("probability"), (unit < F.col(share)).alias("kept"))
    return out.select(*[c for c in docs.columns if c != name], made.alias(name))


def sample_mixture(docs: DataFrame, **params) -> DataFrame:
    """The drawn documents, with the columns of ``docs``."""
    name = fresh(docs, "_mix")
    return mixing_probabilities(docs, name=name, **params).filter(F.col(f"{name}.kept")).drop(name)
