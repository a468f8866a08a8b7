"""SimHash near-duplicate classes with a pigeonring candidate filter.

1. Fingerprint: a 64-bit SimHash of the word shingles of a whole text.
2. Classes: equal fingerprints are one class, named by its smallest doc id.
   Everything below works on distinct fingerprints, so a group of a million
   exact copies is one row.
3. Pigeonring: the 64 bits are a ring of ``segments`` runs.  If two
   fingerprints differ in at most t bits, some start on the ring has a chain
   of consecutive segments whose cumulative differences stay within the
   proportional budget floor(l * t / segments) for every length l.  The first
   segments of such a chain must be equal (their budget is 0), which gives an
   equality key per start; the rest of the chain prunes before the full
   Hamming check.
4. Buckets of one key hold distinct fingerprints only.  Up to
   ``bucket_limit`` they are compared in place (a bounded block, only
   spanning links leave the task).  The members of larger buckets are
   regrouped exactly: fingerprints within t bits share a centre at
   ceil(t / 2) flipped bits, so grouping by centre loses no link and its
   groups are bounded by the number of flips.  The same chain and Hamming
   checks follow.
5. Components of the links give each document the smallest doc id reachable.

Null texts and texts without words have fingerprint 0 and are linked like
any other.  Repeated rows get equal results; a null doc id never names a
class while another id exists.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.llm.common import fresh, stored, utf8
from wingspan.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
SEGMENTS = 7
BUCKET_LIMIT = 2048
_BLOCK = 1 << 16


def simhash(data: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of one text (bytes.lower and bytes.split act on ASCII only)."""
    words = data.lower().split()
    n = len(words)
    if n == 0:
        return 0
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    stops = ends.tolist()[min(shingle, n) - 1:]
    h64 = xxhash.xxh64_intdigest
    total = len(stops)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, _BLOCK):
        hs = np.array([h64(text[s:e], HASH_SEED) for s, e in
                       zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK])], dtype="<u8")
        counts += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (id_col, fp): fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([simhash(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], [id_col, "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), utf8(text_col).alias("_t")).mapInArrow(run, f"`{id_col}` {id_type}, fp long")


def ring(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment of the 64-bit ring."""
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def chain_masks(start: int, segments: int, max_bits: int) -> list[tuple[int, int]]:
    """(mask of the chain's first l segments, its budget) for l = 1..segments."""
    out, mask = [], 0
    for length in range(1, segments + 1):
        shift, width = ring(segments)[(start + length - 1) % segments]
        mask |= ((1 << width) - 1) << shift
        out.append((mask, length * max_bits // segments))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def index_keys(fps: DataFrame, segments: int, max_bits: int) -> DataFrame:
    """(fp, start, key): key holds the bits of the chain prefix whose budget is 0."""
    zero = [max(m for m, budget in chain_masks(s, segments, max_bits) if budget == 0) if max_bits < segments
            else 0 for s in range(segments)]
    if not all(zero):
        raise ValueError("segments must exceed max_bits")
    keys = F.array(*[F.struct(F.lit(s).alias("start"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for s, m in enumerate(zero)])
    return fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.start", "k.key")


def ring_links(a: np.ndarray, start: int, segments: int, max_bits: int) -> list[tuple[int, int]]:
    """Spanning links among the distinct fingerprints ``a`` that pass the chain of ``start``.

    The cumulative chain budgets are checked in ring order, each on what the
    one before has left; the last of them is the full Hamming check.
    """
    masks = [(np.uint64(m), b) for m, b in chain_masks(start, segments, max_bits)]
    parent = list(range(len(a)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in range(len(a) - 1):
        diff = a[i + 1:] ^ a[i]
        left = np.arange(len(diff))
        for mask, budget in masks:
            left = left[np.bitwise_count(diff[left] & mask) <= budget]
            if not len(left):
                break
        for j in left.tolist():
            x, y = find(i), find(i + 1 + j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((i, i + 1 + j))
    return links


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
          bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``max_bits``.

    ``fps`` has one row per distinct fingerprint (fp).
    """
    keyed = index_keys(fps, segments, max_bits)
    sizes = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(keyed.join(sizes, ["start", "key"]), "pigeonring")
    small = (members.filter(F.col("n") <= bucket_limit).groupBy("start", "key")
             .agg(F.collect_list("fp").alias("fps")).select("start", "fps"))
    flips = [0, *(sum(1 << x for x in c) for r in range(1, (max_bits + 1) // 2 + 1)
                  for c in combinations(range(64), r))]
    hot = members.filter(F.col("n") > bucket_limit).select("fp").distinct()
    centred = (hot.select("fp", F.explode(F.array(*[F.lit(_signed(x)) for x in flips])).alias("flip"))
               .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
               .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
               .select(F.lit(-1).alias("start"), "fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = [], []
            for start, vals in zip(b.column(0).to_pylist(), b.column(1)):
                a = np.sort(vals.values.to_numpy(zero_copy_only=False).view(np.uint64))
                for s in (range(segments) if start < 0 else (start,)):
                    for i, j in ring_links(a, s, segments, max_bits):
                        left.append(a[i])
                        right.append(a[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (left, right)], ["a", "b"])

    return small.unionByName(centred).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
                    bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per row of ``docs``: id_col, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most
    ``max_bits`` differing bits; an empty table gives an empty result.
    """
    marked = stored(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min(id_col).alias("low")), "simhash-classes")
    found = connected_components(links(classes.select("fp"), max_bits, segments, bucket_limit), "a", "b")
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.select("fp", "root").join(lows, "root").select("fp", "component_id")
    return (marked.join(named, "fp")
            .select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with one document per near-duplicate component: the one with the smallest id.

    Of repeated rows of that id one stays.  Rows with a null id cannot be
    named and pass through unchanged.  All columns of ``docs`` are kept.
    """
    near = near_duplicates(docs.filter(F.col(id_col).isNotNull()).select(id_col, text_col), id_col, text_col, **params)
    n = fresh(docs, "_n")
    low = near.filter(F.col(id_col) == F.col("component_id")).groupBy(id_col).agg(F.count("*").alias(n))
    kept = docs.join(low, id_col)
    once = kept.filter(F.col(n) == 1).unionByName(kept.filter(F.col(n) > 1).dropDuplicates([id_col]))
    return (once.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull())))
