"""Benchmark decontamination with a broadcast hash set, in built-in expressions only.

A window is ``window`` consecutive words of a benchmark item; an item of
fewer words, but not none, is one window of its own length.  A document word
is hit if it lies inside any occurrence of a window.

* Hash set: every run of SEED words inside a window is a seed.  A window of
  L words holds L - SEED + 1 runs, so one of them starts at a document
  position divisible by that number: it is enough to hash every
  (L - SEED + 1)-th run of a document.  The set of seed hashes is broadcast
  in blocks of at most ``block_seeds`` hashes, so its size in an executor is
  bounded however large the benchmark is.
* Scan: one pass over the documents.  Words, run hashes and the probe of the
  broadcast set are one pipeline; only matching runs leave it, with the words
  around them, beside one marker row per document.
* Verification: the windows around a matching run are compared, as whole
  word sequences, with the windows of the benchmark.
* Removal: :func:`remove_spans` takes hit words out of the texts,
  :func:`remove_documents` drops documents with a hit word.

Nulls and edges: a null text or item has no words.  Empty tables give empty
results, an empty benchmark hits nothing.  Every row of ``docs`` gives one
row, repeated and null ids included.  Item rows of one id are one item; an
item without id goes by the empty string.  Other columns of the tables,
whatever their names, take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wingspan.llm.common import stored

WINDOW = 10
SEED = 5
BLOCK_SEEDS = 1_000_000  # hashes in one broadcast: about 40 MB
# The contract's word characters, and the same before A-Z are lower-cased.
WORD_CHARS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
OTHER_CHARS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
RAW_WORD_CHARS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
RAW_OTHER_CHARS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words(text: str | Column) -> Column:
    """Normalised words of a text; none for null."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.array_remove(F.split(ascii_lower(c), OTHER_CHARS + "+"), "")


def _starts(n: Column, length: int, step: int = 1) -> Column:
    """1, 1 + step, ... as far as ``length`` words fit into n; empty if they do not."""
    return F.when(n >= length, F.sequence(F.lit(1), n - (length - 1), F.lit(step))).otherwise(
        F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(item, w, n): the distinct windows of every item as word arrays of n words."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             words(text_col).alias("ws")).filter(F.size("ws") > 0)
    n = F.least(F.size("ws"), F.lit(window))
    at = F.sequence(F.lit(1), F.size("ws") - n + 1)
    return (items.select("item", n.alias("n"), F.explode(F.transform(at, lambda i: F.slice("ws", i, n))).alias("w"))
            .distinct())


def _scan(docs: DataFrame, seeds: DataFrame | None, lengths: list[int], markers: bool) -> DataFrame:
    """Marker rows of the documents and their runs whose hash is in ``seeds``: (rid, row, n_words, n, c0, ctx).

    ``docs`` has rid, row and ws.  A run of the windows of n words comes with
    ctx, the words that any window around it can hold, and c0, the position of
    the first of them.  Marker rows have n = 0.
    """
    def hashed(n: int) -> Column:
        seed = min(SEED, n)
        return F.transform(_starts(F.size("ws"), seed, n - seed + 1), lambda p: F.struct(
            F.lit(n).alias("n"), p.alias("p"), F.xxhash64(F.lit(n), F.slice("ws", p, seed)).alias("h")))

    runs = [hashed(n) for n in lengths]
    if markers:
        runs.insert(0, F.array(F.struct(F.lit(0).alias("n"), F.lit(0).alias("p"), F.lit(None).cast("long").alias("h"))))
    each = docs.select("*", F.explode(F.concat(*runs)).alias("run")).select("rid", "row", "ws", "run.*")
    if seeds is not None:
        each = each.join(F.broadcast(seeds), "h", "left").filter("n = 0 OR known")
    size, seed = F.size("ws"), F.least(F.lit(SEED), F.col("n"))
    c0 = F.greatest(F.col("p") - (F.col("n") - seed), F.lit(1))
    last = F.least(F.col("p") + F.col("n") - 1, size)
    hit = F.col("n") > 0
    return each.select("rid", F.when(~hit, F.col("row")).alias("row"), F.when(~hit, size).alias("n_words"), "n",
                       F.when(hit, c0).alias("c0"), F.when(hit, F.slice("ws", c0, last - c0 + 1)).alias("ctx"))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", carry: list[str] | None = None,
         block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """One row per row of ``docs``: row (struct of the ``carry`` columns, all by default), n_words, spans, items.

    ``spans`` are the maximal runs of hit words as struct<first, last>, 1-based;
    ``items`` the sorted ids of the items with an occurring window.
    """
    tests = stored(benchmark_windows(benchmark, window, item_col, item_text), "decontam-windows")
    lengths = [r.n for r in tests.select("n").distinct().orderBy("n").collect()]  # at most ``window`` values
    at = F.sequence(F.lit(1), F.col("n") - F.least(F.lit(SEED), F.col("n")) + 1)
    seeds = stored(tests.select("n", F.explode(F.transform(at, lambda i: F.xxhash64(
        "n", F.slice("w", i, F.least(F.lit(SEED), F.col("n")))))).alias("h")).select("h").distinct()
        .select("h", F.lit(True).alias("known")), "decontam-seeds")
    blocks = max(1, -(-seeds.count() // block_seeds))
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"),
                           F.struct(*(carry or docs.columns)).alias("row"), F.col(text_col).alias("text"))
    if blocks > 1:  # several scans have to agree on the row numbers
        numbered = stored(numbered, "decontam-rows")
    read = numbered.select("rid", "row", words("text").alias("ws"))
    parts = [_scan(read, seeds.filter(F.pmod("h", F.lit(blocks)) == b) if lengths else None, lengths, b == 0)
             for b in range(blocks)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = stored(found, "decontam-scan")

    # the windows of a context that hold its run, as whole sequences
    inside = F.sequence(F.col("c0"), F.col("c0") + F.size("ctx") - F.col("n"))
    near = (found.filter("n > 0").filter(F.size("ctx") >= F.col("n"))
            .select("rid", "n", F.explode(F.transform(inside, lambda i: F.struct(
                i.alias("i"), F.slice("ctx", i - F.col("c0") + 1, F.col("n")).alias("w")))).alias("x"))
            .select("rid", "n", "x.i", F.array_join("x.w", " ").alias("w")))
    tests = tests.select("item", F.array_join("w", " ").alias("w"))
    hits = stored(near.join(tests.select("w").distinct(), "w").select("rid", "i", "n", "w").distinct(), "decontam-hits")
    order = Window.partitionBy("rid").orderBy("i")
    ends = hits.groupBy("rid", "i").agg(F.max(F.col("i") + F.col("n") - 1).alias("e"))
    ends = ends.withColumn("before", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    fresh = F.when(F.col("before").isNull() | (F.col("i") > F.col("before") + 1), 1).otherwise(0)
    spans = (ends.withColumn("span", F.sum(fresh).over(order)).groupBy("rid", "span")
             .agg(F.min("i").alias("first"), F.max("e").alias("last")).groupBy("rid")
             .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans")))
    items = (hits.select("rid", "w").distinct().join(tests, "w").groupBy("rid")
             .agg(F.array_sort(F.collect_set("item")).alias("items")))
    marked = found.filter("n = 0").select("rid", "row", "n_words").join(spans.join(items, "rid"), "rid", "left")
    none = F.array().cast("array<struct<first:int,last:int>>")
    return marked.select("row", F.col("n_words").cast("long").alias("n_words"),
                         F.coalesce("spans", none).alias("spans"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def n_hit(spans: str | Column) -> Column:
    """Number of words in spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def remove_documents(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` without any hit word."""
    return mark(docs, benchmark, **params).filter(F.size("spans") == 0).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """``docs`` with the hit words, and what separates them from the word before, taken out of the texts.

    Texts without hit words (null ones too) stay as they are.
    """
    marked = mark(docs, benchmark, text_col=text_col, **params)
    text = F.col("row").getField(text_col)
    pieces = F.regexp_extract_all(text, F.lit(f"{RAW_OTHER_CHARS}*{RAW_WORD_CHARS}+"), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda s: (s["first"] <= i + 1) & (i + 1 <= s["last"])))
    tail = F.regexp_extract(text, f"{RAW_OTHER_CHARS}*\\z", 0)
    cleaned = F.when(F.size("spans") > 0, F.concat(F.array_join(kept, ""), tail)).otherwise(text)
    return marked.select(*[cleaned.alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                           for c in docs.columns])
