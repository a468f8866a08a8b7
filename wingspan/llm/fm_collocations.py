"""Phrase collocations from FM-indexes of shards.

* Shards: every task cuts its documents into shards of about ``shard_words``
  words (whole documents) and stores them as word ids of the shard's own
  dictionary; 0 separates pieces.  No text is shuffled.
* Words: dictionary counts are summed over the shards; words below ``least``
  cannot be part of a candidate and become separators (an exact prune).
* Index: per shard the Burrows-Wheeler transforms of the id sequence and of its
  reverse, in an order of three words of context, which is as deep as
  intervals are extended.
* Enumeration: a phrase is a pair of synchronised intervals, one in each
  index.  Phrases of two words come from extending every word to the left;
  their counts are summed over the shards, and each shard goes on with those
  that reach ``least`` in the whole corpus.  They are extended to the right in
  the reverse index (three words), and these to the left in the forward one
  (four).  Each extension keeps both intervals: the rows of the extended one
  are counted by symbol, and the counts of smaller symbols shift the other.
* Result: cuts and extensions of a candidate are phrases themselves, so its
  parts and its left and right extensions are looked up among the sums.
  A longer candidate that holds a phrase and reaches the share of its count
  implies a one-word extension that does, so these alone are tested.

All sums are over all documents; a phrase is one row per shard before them, so
a frequent phrase is no hot group.  Texts are processed whole; a document
longer than ``shard_words`` makes a shard of its own size.

Nulls and edges: a null text is empty, a null language counts as ``und``
(together with documents of that name).  Repeated rows count each time, empty
tables give empty results, other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wingspan.llm.common import stored

LEAST = 30
TOP = 2000
SHARE = 80  # percent of a phrase's count that makes a longer phrase replace it
SCORE_SCALE = 2_000_000
SHARD_WORDS = 1_000_000
SLICE_BYTES = 4 << 20
ENTRIES = 20_000  # dictionary rows in one Arrow batch
_WORDS = ("w1", "w2", "w3", "w4")

# Byte classes of the contract (0 word, 1 blank, 2 end of a piece) and A-Z in lower case.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, text of each word, number of its piece) of a string array without nulls."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    ends = offsets[1:] - offsets[0]
    kind = _CLASS[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    border = ends[:-1][ends[:-1] < len(data)]
    first[border] = inside[border]  # a text never continues the word before it
    starts = np.flatnonzero(first)
    n = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)
    text = np.searchsorted(ends, starts, side="right")
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + text
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.tobytes()),
                                             pa.py_buffer(_LOWER[data[inside]].tobytes()))
    return words, text, piece


def _packed(ids: np.ndarray) -> bytes:
    """32-bit ids, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return len(ids).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(blob: pa.Buffer) -> np.ndarray:
    n = int.from_bytes(blob[:8].to_pybytes(), "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 4 * n, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").ravel()


class _Shard:
    """Words of whole documents until there are enough for a shard."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.langs: list[pa.Array] = []
        self.breaks: list[np.ndarray] = []
        self.n = 0

    def add(self, texts: pa.Array, langs: pa.Array) -> None:
        words, text, piece = split_words(texts)
        if len(words):
            self.words.append(words)
            self.langs.append(langs.take(pa.array(text)))
            self.breaks.append(np.diff(piece, prepend=-1) != 0)
            self.n += len(words)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The dictionary (position from 1, language, word, count), then the sequence of positions."""
        word = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        lang = pa.chunked_array(self.langs).combine_chunks().dictionary_encode()
        pair = word.indices.to_numpy().astype(np.int64) * len(lang.dictionary) + lang.indices.to_numpy()
        known, code, count = np.unique(pair, return_inverse=True, return_counts=True)
        words = word.dictionary.take(pa.array(known // len(lang.dictionary))).cast(pa.string())
        langs = lang.dictionary.take(pa.array(known % len(lang.dictionary))).cast(pa.string())
        breaks = np.concatenate(self.breaks)
        seq = np.zeros(len(code) + int(breaks.sum()), np.int32)
        seq[np.arange(len(code)) + np.cumsum(breaks)] = code + 1  # a separator goes before each piece
        for at in range(0, len(known), ENTRIES):
            n = min(ENTRIES, len(known) - at)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * n), pa.array(np.arange(at + 1, at + n + 1)), langs.slice(at, n), words.slice(at, n),
                 pa.array(count[at:at + n]), pa.nulls(n, pa.binary())], _SHARD_NAMES)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.string())] * 2, pa.nulls(1, pa.int64()),
             pa.array([_packed(seq)], pa.binary())], _SHARD_NAMES)


_SHARD = "shard long, pos long, lang string, word string, n long, seq binary"
_SHARD_NAMES = [f.split()[0] for f in _SHARD.split(", ")]


def shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
           shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows of all shards: dictionary entries with counts (seq null), and one row with the word sequence (pos null)."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = _Shard(), TaskContext.get().partitionId() << 32
        for b in batches:
            for lo, hi in _slices(b.column(0)):
                held.add(b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo))
                if held.n >= shard_words:
                    yield from held.rows(shard)
                    held, shard = _Shard(), shard + 1
        if held.n:
            yield from held.rows(shard)

    return rows.mapInArrow(run, _SHARD)


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES each."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    if not len(size):
        return []
    cuts = np.flatnonzero(np.diff(size // SLICE_BYTES)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(size)]))


def context_order(seq: np.ndarray, symbols: int) -> np.ndarray:
    """Positions of ``seq`` sorted by three symbols from there (the end counts as 0)."""
    s = np.concatenate([seq, [0, 0]]).astype(np.int64)
    m = symbols + 1
    two = s[:-2] * m + s[1:-1]
    if m ** 3 >= 1 << 63:
        two = np.unique(two, return_inverse=True)[1]
    return np.argsort(two * m + s[2:])


def fm_index(seq: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transforms of a sequence over 0..symbols and of its reverse; it begins and ends with 0."""
    out = []
    for s in (seq, seq[::-1]):
        out.append(s[context_order(s, symbols) - 1])
    return out[0], out[1]


def _counted(rows: np.ndarray, symbol: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Interval number, symbol, count, and count of smaller symbols, for the symbols met in each interval."""
    key, n = np.unique(rows * (symbols + 1) + symbol, return_counts=True)
    row, sym = key // (symbols + 1), key % (symbols + 1)
    before = np.cumsum(n) - n
    first = np.flatnonzero(np.diff(row, prepend=-1))
    return row, sym, n, before - np.repeat(before[first], np.diff(np.append(first, len(row))))


def _rows_of(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(interval number, index row) for every row of the intervals."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def two_words(bwt: np.ndarray, symbols: int) -> tuple[np.ndarray, ...]:
    """All phrases a b: (a, b, count, start in the forward index, start in the reverse index)."""
    total = np.bincount(bwt, minlength=symbols + 1)
    c = np.cumsum(total) - total
    first = np.repeat(np.arange(symbols + 1), total)  # the word each row begins with
    b, a, n, smaller = _counted(first, bwt, symbols)  # by b, then a: extension of b to the left
    reverse = c[b] + smaller
    order = np.lexsort((b, a))  # by a, then b: the rows of the forward index in order
    a, b, n, reverse = a[order], b[order], n[order], reverse[order]
    forward = np.cumsum(n) - n
    keep = (a > 0) & (b > 0)
    return a[keep], b[keep], n[keep], forward[keep], reverse[keep]


def longer_phrases(bwt: np.ndarray, rbwt: np.ndarray, symbols: int, kept: np.ndarray) -> tuple[tuple, tuple]:
    """Phrases of three and of four words whose pairs are all in ``kept`` (sorted a * (symbols + 1) + b)."""
    def allowed(x, y):
        key = x * (symbols + 1) + y
        at = np.minimum(np.searchsorted(kept, key), max(len(kept) - 1, 0))
        return (x > 0) & (y > 0) & ((kept[at] == key) if len(kept) else False)

    a, b, n, fwd, rev = two_words(bwt, symbols)
    ok = allowed(a, b)
    a, b, n, fwd, rev = (z[ok] for z in (a, b, n, fwd, rev))
    row, at = _rows_of(rev, n)
    row, d, n3, smaller = _counted(row, rbwt[at].astype(np.int64), symbols)  # extension to the right
    ok = allowed(b[row], d)
    a3, b3, d3, n3, fwd3 = a[row][ok], b[row][ok], d[ok], n3[ok], (fwd[row] + smaller)[ok]
    row, at = _rows_of(fwd3, n3)
    row, e, n4, _ = _counted(row, bwt[at].astype(np.int64), symbols)  # extension to the left
    ok = allowed(e, a3[row])
    row, e, n4 = row[ok], e[ok], n4[ok]
    return (a3, b3, d3, n3), (e, a3[row], b3[row], d3[row], n4)


_INDEX = "shard long, gids binary, bwt binary, rbwt binary"
_PAIRS = "shard long, w1 long, w2 long, n long"
_COUNTS = "w1 long, w2 long, w3 long, w4 long, n long"


def _index_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows from (shard, seq, kept: the frequent words' positions and ids)."""
    for b in batches:
        for i in range(len(b)):
            shard, seq = b["shard"][i].as_py(), _unpacked(b["seq"][i].as_buffer())
            kept = b["kept"][i].values.flatten()
            pos, gid = kept[0].to_numpy().astype(np.int64), kept[1].to_numpy().astype(np.int64)
            order = np.argsort(gid)
            local = np.zeros(int(max(seq.max(initial=0), pos.max(initial=0))) + 1, np.int64)
            local[pos[order]] = np.arange(1, len(order) + 1)
            s = local[seq]
            s = s[(s > 0) | (np.append(s[1:], 0) > 0)]  # one separator is enough
            s = np.concatenate([[0], s, [0]]) if len(s) else np.zeros(1, np.int64)
            bwt, rbwt = fm_index(s, len(order))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), *[pa.array([z], pa.binary()) for z in
                                      (gid[order].tobytes(), _packed(bwt), _packed(rbwt))]],
                [f.split()[0] for f in _INDEX.split(", ")])


def _load(b: pa.RecordBatch, i: int) -> tuple:
    gids = np.concatenate([[0], np.frombuffer(b["gids"][i].as_buffer(), np.int64)])
    return (b["shard"][i].as_py(), gids, _unpacked(b["bwt"][i].as_buffer()).astype(np.int64),
            _unpacked(b["rbwt"][i].as_buffer()))


def _emit_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(len(b)):
            shard, gids, bwt, _ = _load(b, i)
            a, c, n, *_ = two_words(bwt, len(gids) - 1)
            yield from _pieces(_PAIRS, [np.full(len(n), shard), gids[a], gids[c], n])


def _emit_longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(len(b)):
            _, gids, bwt, rbwt = _load(b, i)
            pairs = b["kept"][i].values.flatten()
            a, c = (np.searchsorted(gids, z.to_numpy()) for z in pairs)
            kept = np.sort(a.astype(np.int64) * len(gids) + c)
            for *words, n in longer_phrases(bwt, rbwt, len(gids) - 1, kept):
                zero = np.zeros(len(n), np.int64)
                yield from _pieces(_COUNTS, [*[gids[w] for w in words], *[zero] * (4 - len(words)), n])


def _pieces(schema: str, columns: list[np.ndarray], size: int = 100_000) -> Iterator[pa.RecordBatch]:
    """The columns (64-bit) as batches of bounded size."""
    names = [f.split()[0] for f in schema.split(", ")]
    for at in range(0, len(columns[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[at:at + size].astype(np.int64)) for c in columns], names)


def _sums(rows: DataFrame, least: int) -> DataFrame:
    return rows.groupBy(*_WORDS).agg(F.sum("n").alias("f")).filter(F.col("f") >= least)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                     shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, word, f, gid), (phrases: w1..w4 by gid, 0 for none, f) of 1 to 4 words, (lang, n: all words)."""
    made = stored(shards(docs, text_col, lang_col, shard_words), "fm-shards")
    entries = made.filter("pos IS NOT NULL").drop("seq")
    totals = stored(entries.groupBy("lang").agg(F.sum("n").alias("n")), "fm-totals")
    words = stored(entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
                   .withColumn("gid", F.monotonically_increasing_id() + 1), "fm-words")
    kept = (entries.join(words.select("lang", "word", "gid"), ["lang", "word"]).groupBy("shard")
            .agg(F.collect_list(F.struct("pos", "gid")).alias("kept")))
    # both joins on the shard are shuffled at any size: the lists of all shards are no broadcast
    index = stored(made.filter("pos IS NULL").select("shard", "seq").join(kept.hint("merge"), "shard").mapInArrow(_index_shards, _INDEX), "fm-index")
    # one shuffle sums the shards' counts of a pair (a row per shard) and keeps the shards that hold it
    whole = F.sum("n").over(Window.partitionBy("w1", "w2"))
    two = stored(index.mapInArrow(_emit_two, _PAIRS).withColumn("f", whole).filter(F.col("f") >= least), "fm-two")
    pairs = two.groupBy("w1", "w2").agg(F.first("f").alias("f"))
    asked = two.groupBy("shard").agg(F.collect_list(F.struct("w1", "w2")).alias("kept"))
    longer = stored(_sums(index.join(asked.hint("merge"), "shard").mapInArrow(_emit_longer, _COUNTS), least), "fm-longer")
    zero = [F.lit(0).cast("long").alias(w) for w in _WORDS]
    single = words.select(F.col("gid").alias("w1"), *zero[1:], "f")
    return words, single.union(pairs.select("w1", "w2", *zero[2:], "f")).unionByName(longer), totals


def _filled(words: list[Column]) -> list[Column]:
    return [*words, *[F.lit(0).cast("long")] * (4 - len(words))]


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                 share: int = SHARE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, words, a, l, r, n, score, left_extension, right_extension): the ``top`` of each language.

    ``left_extension`` and ``right_extension`` are the largest counts of the
    phrase with one more word before or after it (0 where none reaches ``least``).
    """
    words, phrases, totals = frequent_phrases(docs, text_col, lang_col, least, shard_words)
    phrases = stored(phrases, "fm-phrases")
    w = [F.col(x) for x in _WORDS]
    length = sum(F.when(x > 0, 1).otherwise(0) for x in w)
    cands = phrases.filter("w2 > 0").withColumn("m", length)

    # left and right extensions: the longer phrases, named by what is left without their first or last word
    longer = cands.filter("m > 2")
    left = longer.groupBy(F.struct(*[c.alias(x) for c, x in zip(_filled(w[1:]), _WORDS)]).alias("p")).agg(
        F.max("f").alias("left_extension"))
    last = [F.when(F.col("m") - 1 > i, x).otherwise(0) for i, x in enumerate(w)]
    right = longer.groupBy(F.struct(*[c.alias(x) for c, x in zip(last, _WORDS)]).alias("p")).agg(
        F.max("f").alias("right_extension"))
    own = cands.select(F.struct(*_WORDS).alias("p"), "m", F.col("f").alias("a"))
    own = own.join(left, "p", "left").join(right, "p", "left").fillna(0, ["left_extension", "right_extension"])
    big = F.greatest("left_extension", "right_extension").cast("decimal(38,0)")
    own = own.filter(big * 100 < F.col("a").cast("decimal(38,0)") * share)

    # cuts: the lowest score, ties to the smallest k
    def part(lo: int, hi) -> list[Column]:
        return [F.when((F.lit(lo + i) < hi), F.col(f"p.{_WORDS[lo + i]}")).otherwise(0) if lo + i < 4 else F.lit(0)
                for i in range(4)]

    def key(cols: list[Column]) -> Column:
        return F.struct(*[c.cast("long").alias(x) for c, x in zip(cols, _WORDS)])

    cuts = [F.struct(F.lit(k).alias("k"), key(part(0, F.lit(k))).alias("head"), key(part(k, F.col("m"))).alias("rest"))
            for k in (1, 2, 3)]
    cut = own.select("*", F.explode(F.filter(F.array(*cuts), lambda c: c.k < F.col("m"))).alias("cut"))
    table = phrases.select(F.struct(*_WORDS).alias("part"), "f")
    cut = (cut.join(table.select(F.col("part").alias("h"), F.col("f").alias("l")), F.col("cut.head") == F.col("h"))
           .join(table.select(F.col("part").alias("t"), F.col("f").alias("r")), F.col("cut.rest") == F.col("t")))
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {SCORE_SCALE} DIV (CAST(l AS DECIMAL(20,0)) + r)")
    best = cut.groupBy("p", "m", "a", "left_extension", "right_extension").agg(
        F.min(F.struct(score.alias("score"), F.col("cut.k").alias("k"), "l", "r")).alias("best"))

    names = words.select("gid", "lang", "word")
    out = best
    for x in _WORDS:
        out = out.join(names.select(F.col("gid").alias(f"g_{x}"), F.col("word").alias(f"n_{x}"),
                                    *([F.col("lang")] if x == "w1" else [])), F.col(f"p.{x}") == F.col(f"g_{x}"), "left")
    out = out.join(totals, "lang").select("lang", F.concat_ws(" ", *[f"n_{x}" for x in _WORDS]).alias("phrase"),
                                          F.col("m").alias("words"), "a", "best.l", "best.r", "n", "best.score",
                                          "left_extension", "right_extension")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return out.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
