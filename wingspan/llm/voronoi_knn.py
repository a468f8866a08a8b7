"""Exact top-k inner products by a Voronoi kNN join.

Pivots split queries and data into Voronoi cells (nearest pivot).  For a
vector s of cell j at distance d from its pivot p_j and any query q,

    q.p_j - |q| d  <=  q.s  <=  q.p_j + |q| d.

* Summaries: a histogram of d per cell (cells x bins, a fixed size).
* Bounds: for a query cell i with radius U and largest norm N,
  q.p_j lies within p_i.p_j -+ U |p_j|.  Adding up histogram bins by their
  lower bound until k + 1 vectors are covered gives a score theta that every
  query of the cell reaches k times; a vector of cell j is needed by cell i
  only if p_i.p_j + U |p_j| + N d >= theta.
* Replication: data travel as blocks (one cell, at most ``block`` vectors)
  to the query groups that need them, dealt into chunks of bounded size.
* Local solve: each (query group, chunk) is one numpy product; blocks whose
  upper bound is under a query's k-th score so far are skipped.  Partial
  top-k lists meet in a ranked window per query.

Query cells are split or joined to groups of about ``group`` queries, so a
cell with a third of all vectors is many groups and many blocks.  The bounds
hold exactly; a small relative slack covers rounding.

Vectors that are null, empty or hold null or non-finite components take no
part.  Shorter vectors are padded with zeros.  Rows of one id count once: the
largest vector in array order stands for the id.  A query never meets its
own id.  Scores are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wingspan.llm.common import stored

TOP = 20
SCALE = 64
PIVOTS = 64
BINS = 64
GROUP_QUERIES = 1024
BLOCK_VECTORS = 512
CHUNK_VECTORS = 8192
_EXACT = float(1 << 53)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): floor(scale * component) as doubles, for the vectors that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    x = F.col(vec_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return df.filter(F.col(id_col).isNotNull() & (F.size(x) > 0) & ~bad).select(F.col(id_col).alias("id"), v.alias("v"))


def one_per_id(vectors: DataFrame) -> DataFrame:
    """One row per id; only ids alone are shuffled unless some repeat."""
    twice = stored(vectors.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "knn-repeats")
    merged = vectors.join(twice, "id", "left_semi").groupBy("id").agg(F.max("v").alias("v"))
    return vectors.join(twice, "id", "left_anti").unionByName(merged)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(
        np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _cells(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each row and the distance to it."""
    cell = np.argmin((pivots * pivots).sum(1) - 2 * (x @ pivots.T), axis=1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def blocks(vectors: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """(cell, n, rmin, rmax, norm, ids, m): vectors of one cell and task, nearest to the pivot first."""
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, ids = _matrix(b.column(1), dim), b.column(0).to_numpy().astype(np.int64)
            cell, dist = _cells(x, pivots)
            order = np.lexsort((dist, cell))
            rows = []
            for part in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
                for at in range(0, len(part), size):
                    p = part[at:at + size]
                    rows.append((int(cell[p[0]]), len(p), float(dist[p[0]]), float(dist[p[-1]]),
                                 float(np.sqrt((x[p] ** 2).sum(1).max())), ids[p].tobytes(), x[p].tobytes()))
            kinds = [pa.int32(), pa.int64(), *[pa.float64()] * 3, *[pa.binary()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             ["cell", "n", "rmin", "rmax", "norm", "ids", "m"])

    return vectors.mapInArrow(run, "cell int, n long, rmin double, rmax double, norm double, ids binary, m binary")


def need_table(histogram: dict, queries: dict, pivots: np.ndarray, radius: float, top: int) -> np.ndarray:
    """need[i, j]: smallest pivot distance at which a vector of cell j matters to query cell i."""
    p, norms = len(pivots), np.sqrt((pivots ** 2).sum(1))
    inner = pivots @ pivots.T
    slack = 1e-6 * (1 + np.abs(inner).max() + radius * (1 + norms.max()))
    cell = np.array([j for j, _ in histogram], dtype=int)
    edge = np.array([(b + 1) * radius / BINS for _, b in histogram])
    count = np.array(list(histogram.values()))
    need = np.full((p, p), np.inf)
    for i, (u, n) in queries.items():
        low = inner[i, cell] - u * norms[cell] - n * edge
        order = np.argsort(-low)
        full = np.flatnonzero(np.cumsum(count[order]) >= top + 1)
        theta = low[order][full[0]] if len(full) else -np.inf
        need[i] = (theta - slack - inner[i] - u * norms) / max(n, 1e-300)
    return need


def query_groups(counts: dict[int, int], size: int) -> tuple[dict[int, int], dict[int, int]]:
    """(first group, number of groups) of every query cell: small cells share one, large ones have several."""
    first, parts, group, held = {}, {}, 0, 0
    for cell, n in sorted(counts.items()):
        if held and held + n > size:
            group, held = group + 1, 0
        first[cell], parts[cell] = group, max(1, -(-n // size))
        held += n
        if parts[cell] > 1:
            group, held = group + parts[cell], 0
    return first, parts


def _best(scores: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` columns of each row by score, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :top]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def solve(qids: np.ndarray, q: np.ndarray, data: list[tuple], pivots: np.ndarray, top: int):
    """Top lists (scores, ids) of the queries over the blocks; missing places have the lowest score."""
    lowest = np.iinfo(np.int64).min + 1
    scores = np.full((len(qids), top), lowest)
    ids = np.full((len(qids), top), np.iinfo(np.int64).max)
    reach, norm = q @ pivots.T, np.sqrt((q * q).sum(1))
    data.sort(key=lambda d: -float((reach[:, d[0]] + norm * d[1]).max()))
    for cell, rmax, dids, d in data:
        bound = reach[:, cell] + norm * rmax
        live = np.flatnonzero(bound + 1e-6 * (1 + np.abs(bound)) >= scores[:, -1])
        if not len(live):
            continue
        if np.abs(q).max(initial=0) * np.abs(d).max(initial=0) * q.shape[1] < _EXACT:
            s = (q[live] @ d.T).astype(np.int64)
        else:
            s = q[live].astype(np.int64) @ d.T.astype(np.int64)
        s = np.where(qids[live][:, None] == dids[None, :], lowest, s)
        near, who = _best(np.concatenate([scores[live], s], 1),
                          np.concatenate([ids[live], np.broadcast_to(dids, s.shape)], 1), top)
        scores[live], ids[live] = near, who
    return scores, ids


def top_inner_products(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                       top: int = TOP, scale: int = SCALE, pivots: int = PIVOTS, group: int = GROUP_QUERIES,
                       block: int = BLOCK_VECTORS, chunk: int = CHUNK_VECTORS) -> DataFrame:
    """(query_id, rank, id, score): the ``top`` best other rows of each query row.

    ``is_query`` is a condition over the rows of ``df``.
    """
    vectors = stored(one_per_id(integer_vectors(df, id_col, vec_col, scale)), "knn-vectors")
    asked = stored(one_per_id(integer_vectors(df.filter(is_query), id_col, vec_col, scale)), "knn-queries")
    out_schema = "query_id long, rank int, id long, score long"
    spark = df.sparkSession
    shape = vectors.agg(F.max(F.size("v")).alias("dim"), F.count("*").alias("n")).first()
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()  # at most ``pivots`` rows
    if not chosen:
        return spark.createDataFrame([], out_schema)
    dim = shape.dim
    centre = np.unique(np.array([r.v + [0.0] * (dim - len(r.v)) for r in chosen]), axis=0)
    data, queries = (stored(blocks(x, centre, s), name) for x, s, name in
                     ((vectors, block, "knn-data"), (asked, group, "knn-asked")))
    radius = (data.agg(F.max("rmax")).first()[0] or 0.0) or 1.0
    # a block's vectors all count at its farthest bin: a valid (lower) bound for each of them
    bins = data.groupBy("cell", F.least(F.floor(F.col("rmax") * BINS / radius), F.lit(BINS - 1)).alias("b")).agg(
        F.sum("n").alias("n")).collect()
    seen = queries.groupBy("cell").agg(F.max("rmax").alias("u"), F.max("norm").alias("norm"),
                                       F.sum("n").alias("n")).collect()
    need = need_table({(r.cell, r.b): r.n for r in bins}, {r.cell: (r.u, r.norm) for r in seen}, centre, radius, top)
    first, parts = query_groups({r.cell: r.n for r in seen}, group)
    n_chunks = max(1, -(-shape.n // chunk))

    # which groups need a block: per group the smallest need of its query cells, a fixed-size table
    wanted: dict[int, list[float]] = {}
    for i, g in first.items():
        for k in range(parts[i]):
            now = wanted.setdefault(g + k, [np.inf] * len(centre))
            wanted[g + k] = [min(a, b) for a, b in zip(now, need[i].tolist())]
    if not wanted:
        return spark.createDataFrame([], out_schema)
    table = spark.createDataFrame([(g, j, float(x)) for g, row in wanted.items() for j, x in enumerate(row)],
                                  "grp int, cell int, need double")
    sent = (data.join(table, "cell").filter("rmax >= need")
            .withColumn("chunk", F.pmod(F.xxhash64("ids"), F.lit(n_chunks)).cast("int")))
    homes = spark.createDataFrame([(i, first[i], parts[i]) for i in first], "cell int, g0 int, parts int")
    placed = (queries.join(homes, "cell")
              .withColumn("grp", (F.col("g0") + F.pmod(F.xxhash64("ids"), F.col("parts"))).cast("int"))
              .select("grp", "ids", "m", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk")))

    def local(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        qids = np.concatenate([np.frombuffer(x, np.int64) for x in left["ids"].to_pylist()] or [np.empty(0, np.int64)])
        held = [(c, r, np.frombuffer(i, np.int64), np.frombuffer(m, np.float64).reshape(-1, dim)) for c, r, i, m in
                zip(*(right[c].to_pylist() for c in ("cell", "rmax", "ids", "m")))]
        names = ["query_id", "id", "score"]
        if not len(qids) or not held:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        q = np.concatenate([np.frombuffer(x, np.float64).reshape(-1, dim) for x in left["m"].to_pylist()])
        scores, ids = solve(qids, q, held, centre, top)
        real = scores > np.iinfo(np.int64).min + 1
        return pa.table([pa.array(np.repeat(qids, real.sum(1))), pa.array(ids[real]), pa.array(scores[real])],
                        names=names)

    partial = (placed.groupBy("grp", "chunk").cogroup(sent.groupBy("grp", "chunk"))
               .applyInArrow(local, "query_id long, id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id")))
    return partial.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= top).select(
        "query_id", "rank", "id", "score")
