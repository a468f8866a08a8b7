"""Driver queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm import (decontamination, drr_packing, fm_collocations, host_rules, ipf_mixing, pii_boosting, quality_bayes,
                          rtree_negatives, simhash_pigeonring, suffix_array_dedup, suffix_automaton,
                          toxicity_ftrl, voronoi_knn)
from wingspan.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


@register("op4_simhash_pigeonring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: doc_id, fingerprint, component_id."""
    return simhash_pigeonring.near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_quality_bayes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hierarchical quality score of every document, over all labels."""
    out = quality_bayes.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "_quality.*")


@register("op8_pii_boosting")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, all spans."""
    found = pii_boosting.find_pii(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("_base", _of_kind(k))).cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(pii_boosting.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii_boosting.listing(F.col("_base")), 256).alias("base_sha256"),
                        pii_boosting.listing(F.col("_spans")).alias("spans"))


def _of_kind(k: int):
    return lambda span: span.k == k


OP9_SQL = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM pos),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
c AS (SELECT w.doc_id, w.source, len(ws) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN dup ON dup.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS x FROM f GROUP BY source),
m AS (SELECT sum(x) / sum(n) AS p, sum(x * x / n) / sum(n) AS s2, count(*) / sum(n) AS kn FROM h),
k AS (SELECT p, least(greatest(p * (1 - p) / greatest(s2 - p * p - p * (1 - p) * kn, 1e-12) - 1, 1.0), 1e6)
  AS strength FROM m),
v AS (SELECT source, (x + p * strength) / (n + strength) < 0.5 AS passed FROM h, k)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND passed AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


@register("op9_host_rules", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document with the verdict of its host (source)."""
    out = host_rules.apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@register("op1_drr_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with a digest of their ids."""
    pieces = drr_packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def _op2_sql() -> str:
    """The same raking as a chain of CTEs, one per step."""
    counts = [f"len(regexp_extract_all(t, '(^|[^A-Za-z])[{x}{x.upper()}][A-Za-z][A-Za-z][A-Za-z]')) AS c{i}"
              for i, x in enumerate(ipf_mixing.TOPIC_LETTERS)]
    names = [f"c{i}" for i in range(len(counts))]
    pick = " ".join(f"WHEN {c} = most THEN 't{i}'" for i, c in enumerate(names))
    axes = ("source", "lang", "topic")
    sql = f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, source, lang, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS tokens,
  {', '.join(counts)} FROM d),
g AS (SELECT *, greatest({', '.join(names)}) AS most FROM n),
m AS (SELECT doc_id, source, lang, tokens, CASE WHEN most = 0 THEN 'none' {pick} END AS topic FROM g),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM m GROUP BY ALL)"""
    for a in axes:
        sql += f""",
goal_{a} AS MATERIALIZED (SELECT {a}, pow(sum(tokens), {ipf_mixing.TEMPER}) /
  sum(pow(sum(tokens), {ipf_mixing.TEMPER})) OVER () AS target, 1.0::DOUBLE AS f FROM cells GROUP BY {a})"""
    last = {a: f"goal_{a}" for a in axes}
    for k in range(ipf_mixing.SWEEPS):
        for a in axes:
            x, y = (b for b in axes if b != a)
            sql += f""",
f{k}_{a} AS MATERIALIZED (SELECT g.{a}, target, CASE WHEN s > 0 THEN target / s ELSE 1.0 END AS f
  FROM goal_{a} g JOIN (SELECT c.{a}, sum(c.tokens * p.f * q.f) AS s FROM cells c
    JOIN {last[x]} p ON c.{x} IS NOT DISTINCT FROM p.{x} JOIN {last[y]} q ON c.{y} IS NOT DISTINCT FROM q.{y}
    GROUP BY c.{a}) z ON g.{a} IS NOT DISTINCT FROM z.{a})"""
            last[a] = f"f{k}_{a}"
    joins = " ".join(f"JOIN {last[a]} {a[0]} ON c.{a} IS NOT DISTINCT FROM {a[0]}.{a}" for a in axes)
    return sql + f""",
w AS MATERIALIZED (SELECT c.*, s.f * l.f * t.f AS w FROM cells c {joins}),
a AS MATERIALIZED (SELECT *, sum(tokens) OVER (ORDER BY w DESC) AS above, sum(tokens) OVER () AS total FROM w),
p AS (SELECT source, lang, topic, least(w / (SELECT max(w) FROM a WHERE tokens > 0
  AND above > {ipf_mixing.SATURATION} * total), 1.0) AS p FROM w)
SELECT doc_id, m.source, m.lang, m.topic, tokens::BIGINT AS tokens,
  floor(p * 1e6 + 0.5) / 1e6 AS probability,
  ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < p AS kept
FROM m JOIN p ON m.source IS NOT DISTINCT FROM p.source AND m.lang IS NOT DISTINCT FROM p.lang
  AND m.topic = p.topic
"""


@register("op2_ipf_mixing", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked sampling probability of every document and whether it is drawn."""
    out = ipf_mixing.mixing_probabilities(table(spark, sf_dir, "documents"), tolerance=0.0)
    return out.select("doc_id", "_mix.source", "_mix.lang", "_mix.topic", "_mix.tokens",
                      (F.floor(F.col("_mix.probability") * 1e6 + 0.5) / 1e6).alias("probability"), "_mix.kept")


@register("op5_toxicity_ftrl")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows whose crc32(doc_id) mod 4 is 2 are never learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    weights = toxicity_ftrl.fit(docs, labels, ~held)
    scored = toxicity_ftrl.score_documents(docs, weights)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@register("op6_voronoi_knn", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    found = voronoi_knn.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP7_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS g FROM p),
own AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM win JOIN own USING (g), (SELECT unnest(range(0, 13)) AS k)
  WHERE first < doc_id),
u AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
k AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) AS kept FROM u ANTI JOIN gone
  ON gone.doc_id = u.doc_id AND gone.i = u.i GROUP BY u.doc_id),
r AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id
"""


@register("op7_suffix_automaton", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document when windows of 13 words that an earlier document holds are removed."""
    out = suffix_automaton.dedup_words(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op10_suffix_array")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document when strings of 400 bytes that occur twice are removed."""
    out = suffix_array_dedup.dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM benchmark),
bw AS (SELECT item, least(len(ws), 10) AS n, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
  FROM b WHERE len(ws) > 0),
t AS MATERIALIZED (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS w FROM bw),
p AS (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
  FROM d JOIN (SELECT DISTINCT n FROM t) l ON len(ws) >= l.n),
g AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM p),
h AS MATERIALIZED (SELECT rid, n, i, w FROM g SEMI JOIN t USING (n, w)),
hit AS (SELECT rid, count(DISTINCT i + k) AS n_hit
  FROM h JOIN (SELECT unnest(range(0, 10)) AS k) ON k < n GROUP BY rid),
its AS (SELECT DISTINCT rid, item FROM h JOIN t USING (n, w)),
li AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM its GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit ON hit.rid = d.rid LEFT JOIN li ON li.rid = d.rid
"""


@register("op13_decontamination", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of 10 words of the benchmark, with the items they come from."""
    marked = decontamination.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                  carry=["doc_id"])
    hit = decontamination.n_hit("spans")
    return marked.select("row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS MATERIALIZED (SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.label = c.label AS same,
    list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (
    PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM r WHERE rank <= 10
"""


@register("op12_rtree_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five best positives of every vector whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", "embedding", label.alias("label"))
    return rtree_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


OP11_SQL = """
WITH pc AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')),
    '[^\\x20\\x09]+') AS ws FROM documents),
tot AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pc GROUP BY lang),
pos AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
  FROM pc JOIN (SELECT unnest(range(1, 5)) AS m) ON len(ws) >= m),
f AS MATERIALIZED (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS p, any_value(ws[i:i + m - 1]) AS w,
  count(*) AS f FROM pos GROUP BY 1, 2, 3 HAVING count(*) >= 30),
inner_of AS (SELECT c.lang, array_to_string(c.w[j:j + k - 1], ' ') AS p, c.f AS longer
  FROM f c JOIN (SELECT unnest(range(2, 4)) AS k) ON c.m > k JOIN (SELECT unnest(range(1, 4)) AS j) ON j + k - 1 <= c.m),
most AS (SELECT lang, p, max(longer) AS longer FROM inner_of GROUP BY lang, p),
own AS (SELECT f.* FROM f LEFT JOIN most ON most.lang = f.lang AND most.p = f.p
  WHERE m > 1 AND 100 * coalesce(longer, 0)::HUGEINT < 80 * f::HUGEINT),
cut AS (SELECT own.*, k, x.f AS l, y.f AS r, ((2000000 * own.f::HUGEINT) // (x.f + y.f))::BIGINT AS score
  FROM own JOIN (SELECT unnest(range(1, 4)) AS k) ON k < own.m
  JOIN f x ON x.lang = own.lang AND x.p = array_to_string(own.w[1:k], ' ')
  JOIN f y ON y.lang = own.lang AND y.p = array_to_string(own.w[k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, p) AS rank FROM best)
SELECT ranked.lang, rank::BIGINT AS rank, p AS phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM ranked JOIN tot ON tot.lang = ranked.lang WHERE rank <= 2000
"""


@register("op11_fm_collocations", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of two to four words of each language."""
    found = fm_collocations.collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
