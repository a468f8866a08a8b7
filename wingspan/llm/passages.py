"""Passages that may repeat: the common front end of the substring operators.

A text is a sequence of units (words or bytes); a window is ``length``
consecutive units.  Each window has one anchor: the smallest gram hash in it
(leftmost of equals), which depends on the window's content only.  Runs of
windows with one anchor form a passage; every window lies in exactly one
passage, and equal windows have equal anchors.  So windows need comparing
only among passages of one anchor, and passages whose anchor occurs once in
the corpus need no comparing at all.

``repeated_anchors`` finds the anchors that repeat with one shuffle of
anchors (each batch sends an anchor once, so a line that a third of all
documents share costs a row per batch).  ``contents`` sends each distinct
passage of a batch to the shard of its anchor, ``places`` keeps where they
stand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wingspan.llm.common import stored, utf8

MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
NO_ID = (1 << 63) - 1
_PLACE_BITS = 24
_SLICE = 1 << 22
CUT_BYTES = 1 << 18


class Passages(NamedTuple):
    """Passages of several texts: number of the text, anchor hash, first window in that text, number of
    windows, byte range in ``data`` (all texts), and where the anchor gram begins in that range."""

    data: bytes
    text: np.ndarray
    anchor: np.ndarray
    start: np.ndarray
    count: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    offset: np.ndarray


def scramble(h: np.ndarray) -> np.ndarray:
    """A mixing step on 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * MIX[1]
    return (h ^ (h >> np.uint64(29))) * MIX[2]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in linear time (block prefix and suffix minima)."""
    n = len(x) - width + 1
    top = np.iinfo(x.dtype).max
    padded = np.concatenate([x, np.full(-len(x) % width, top, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchored_runs(order: np.ndarray, width: int,
                  inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor position, first window, number of windows) of the runs of windows with one anchor.

    ``order`` holds a 64-bit rank per gram, a window spans ``width`` grams;
    ``inside`` tells which windows lie in one text, the others are left out (None: all do).
    """
    n = len(order) - width + 1
    place = np.uint64((1 << _PLACE_BITS) - 1)
    at = np.empty(max(n, 0), np.int64)
    for lo in range(0, n, _SLICE):  # positions within a slice fit the low bits
        part = order[lo:min(lo + _SLICE, n) + width - 1]
        ranked = (part & ~place) | np.arange(len(part), dtype=np.uint64)
        at[lo:lo + _SLICE] = (sliding_min(ranked, width) & place).astype(np.int64) + lo
    kept = np.arange(len(at)) if inside is None else np.flatnonzero(inside)
    at = at[kept]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], kept[first], np.diff(np.append(first, len(at)))


def text_windows(units: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each unit, first unit of each text, whether the window from a unit on lies in one text)
    of joined texts with these numbers of units."""
    text = np.repeat(np.arange(len(units)), units)
    return text, np.cumsum(units) - units, text[:max(len(text) - window + 1, 0)] == text[window - 1:]


Cutter = Callable[[list[bytes]], "Passages | None"]


def _slices(texts: Iterator[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) of about ``CUT_BYTES``: most texts are too short to be cut one by one."""
    first, held, size = 0, [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CUT_BYTES:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, text): key names a row; it is the id where that is unique, else a negative hash of id and text."""
    twice = stored(docs.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n"))
                   .filter("n > 1 OR id IS NULL OR id < 0").select("id"), "repeated-ids")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(twice.withColumnRenamed("id", "_odd").withColumn("_is", F.lit(True)),
                     F.col("id").eqNullSafe(F.col("_odd")), "left")
    digest = F.xxhash64("id", "text").bitwiseOR(F.lit(-(1 << 63)))
    return rows.select(F.when(F.col("_is"), digest).otherwise(F.col("id")).alias("key"), "id", "text")


def packed_texts(keyed: DataFrame) -> DataFrame:
    """(key, id, packed): texts compressed for the shuffle.

    No key is null; saying so keeps the plan equal under inner and outer joins.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([press.compress(t) for t in b.column(2).to_pylist()], pa.binary())],
                ["key", "id", "packed"])

    return keyed.select("key", "id", utf8("text").alias("t")).mapInArrow(
        run, "key long, id long, packed binary").filter("key IS NOT NULL")


def unpacked(column: pa.Array) -> Iterator[bytes]:
    press = zstandard.ZstdDecompressor()
    return (press.decompress(x) for x in column.to_pylist())


def repeated_anchors(keyed: DataFrame, cut: Cutter, within: bool) -> DataFrame:
    """(key, anchors): the anchors of each row that also occur in another row (or, ``within``, again in it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, rows = [], []
            keys = b.column(0).to_numpy()
            for at, texts in _slices(b.column(1).to_pylist()):
                p = cut(texts)
                if p is not None and len(p.anchor):
                    a, t = p.anchor, p.text
                    if not within:
                        order = np.lexsort((a, t))
                        a, t = a[order], t[order]
                        new = np.append(True, (a[1:] != a[:-1]) | (t[1:] != t[:-1]))
                        a, t = a[new], t[new]
                    found.append(a)
                    rows.append(keys[at + t])
            if not found:
                continue
            anchor, key = np.concatenate(found), np.concatenate(rows)
            order = np.lexsort((key, anchor))
            anchor, key = anchor[order], key[order]
            new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            group = np.cumsum(new) - 1
            several = np.bincount(group)[group] > 1
            # 0: once in the batch; 1: first of several; 2: a further one, known to repeat
            kind = np.where(~several, 0, np.where(new, 1, 2))
            other = new | (key != np.concatenate([[key[0]], key[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[other].view(np.int64)), pa.array(key[other]), pa.array(kind[other].astype(np.int32))],
                ["anchor", "key", "kind"])

    rows = keyed.select("key", utf8("text").alias("t")).mapInArrow(run, "anchor long, key long, kind int")
    meet = Window.partitionBy("anchor", F.when(F.col("kind") == 2, F.col("key")))
    rows = rows.withColumn("n", F.count("*").over(meet)).filter("n > 1 OR kind > 0")
    return rows.groupBy("key").agg(F.collect_set("anchor").alias("anchors"))


def chosen_texts(texts: DataFrame, keyed: DataFrame, cut: Cutter, within: bool) -> DataFrame:
    """(key, id, packed, anchors) of the rows that hold a repeated anchor.

    Not written: a plan that reads it twice and joins ``texts`` (the same
    frame) once more shares one shuffle of them (Spark reuses the exchange).
    """
    return texts.join(repeated_anchors(keyed, cut, within), "key").select(
        "key", "id", "packed", "anchors")


def _passages(b: pa.RecordBatch, cut: Cutter) -> Iterator[tuple[int, int, int, bytes, int, int]]:
    """(key, id, anchor, content, start, offset) of the passages with a repeated anchor; a null id is ``NO_ID``."""
    keys, ids = b.column(0).to_pylist(), b.column(1).fill_null(NO_ID).to_pylist()
    for at, texts in _slices(unpacked(b.column(2))):
        p = cut(texts)
        if p is None:
            continue
        # an anchor that repeats is in the list of every row that holds it, so the lists of these rows serve together
        repeated = b.column(3).slice(at, len(texts)).flatten().to_numpy().view(np.uint64)
        wanted = np.flatnonzero(np.isin(p.anchor, repeated))
        for t, anchor, lo, hi, s, o in zip((p.text[wanted] + at).tolist(), p.anchor[wanted].view(np.int64).tolist(), *(
                x[wanted].tolist() for x in (p.lo, p.hi, p.start, p.offset))):
            yield keys[t], ids[t], anchor, p.data[lo:hi], s, o


def contents(chosen: DataFrame, cut: Cutter) -> DataFrame:
    """(anchor, content, low, high, n, offset): each distinct content once per batch, with its smallest
    and largest id, its number of places and where its anchor gram begins; one shard task gets an
    anchor's rows together, by low."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[bytes, list] = {}
            for _, i, anchor, content, _, offset in _passages(b, cut):
                x = held.get(content)
                if x is None:
                    held[content] = [anchor, i, i, 1, offset]
                else:
                    x[1], x[2], x[3] = min(x[1], i), max(x[2], i), x[3] + 1
            if held:
                long = [pa.array(c, pa.int64()) for c in zip(*held.values())]
                yield pa.RecordBatch.from_arrays([long[0], pa.array(list(held), pa.binary()), *long[1:]],
                                                 ["anchor", "content", "low", "high", "n", "offset"])

    rows = chosen.mapInArrow(run, "anchor long, content binary, low long, high long, n long, offset long")
    return rows.repartition("anchor").sortWithinPartitions("anchor", "low")


def places(chosen: DataFrame, cut: Cutter) -> DataFrame:
    """(digest, places): where each distinct content of a batch stands, as (key, id, start) triples of longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[bytes, list] = {}
            for key, i, _, content, s, _ in _passages(b, cut):
                held.setdefault(xxhash.xxh3_128_digest(content), []).extend((key, i, s))
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(held), pa.binary()),
                     pa.array([np.array(x, np.int64).tobytes() for x in held.values()], pa.binary())],
                    ["digest", "places"])

    return chosen.mapInArrow(run, "digest binary, places binary")


def anchor_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, bool]]:
    """The contents of each anchor of a shard task: ([(content, low, high, n, offset)], whether they are all).

    Rows come by anchor and low.  Equal contents of several batches are
    merged.  Once an anchor has more than ``limit`` distinct contents they
    are handed out as they come, in bounded lists that are not all.
    """
    at, held, wide = None, {}, False
    for b in batches:
        for anchor, content, low, high, n, offset in zip(*(c.to_pylist() for c in b.columns)):
            if anchor != at:
                if held:
                    yield [(c, *x) for c, x in held.items()], not wide
                at, held, wide = anchor, {}, False
            x = held.get(content)
            if x is None:
                held[content] = [low, high, n, offset]
            else:
                x[0], x[1], x[2] = min(x[0], low), max(x[1], high), x[2] + n
            if len(held) > limit:
                yield [(c, *x) for c, x in held.items()], False
                held, wide = {}, True
    if held:
        yield [(c, *x) for c, x in held.items()], not wide


class Rows:
    """Output rows of a task, handed on in batches of bounded size."""

    def __init__(self, names: list[str], kinds: list[pa.DataType], size: int = 10_000):
        self.names, self.kinds, self.size = names, kinds, size
        self.columns: list[list] = [[] for _ in names]

    def add(self, *row) -> None:
        for c, v in zip(self.columns, row):
            c.append(v)

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.columns[0]) >= self.size:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, self.kinds)], self.names)
            self.columns = [[] for _ in self.names]


def covered(n: int, spans) -> np.ndarray:
    """Which of n units lie in the (start, end) ranges of an Arrow list of structs (or None)."""
    edge = np.zeros(n + 1, np.int64)
    if spans is not None and len(spans):
        np.add.at(edge, spans.field(0).to_numpy(), 1)
        np.add.at(edge, spans.field(1).to_numpy(), -1)
    return np.cumsum(edge[:-1]) > 0
