"""Suffix-array dedup: bytes inside any string of ``window`` bytes that occurs twice.

Texts are UTF-8 bytes; matches never cross documents.  Every byte covered by
a ``window``-byte string that also starts anywhere else (the same document
included) goes, at all its occurrences.

Only passages with a repeated anchor can hold such strings (see
``passages``).  A content that stands at several places repeats as a whole.
The distinct contents of an anchor range form a shard text; its suffix array
(of those contents that can share a window at all) is built by induced
sorting, and the permuted common prefixes tell for every
window start whether a neighbour in the array shares ``window`` bytes.
Shard texts are bounded: an anchor with more than ``array_contents``
distinct contents is compared by a sorted meeting of equal windows instead,
with the same result and nothing held.  The repeated windows of each content go back to its places by
a plain shuffle join.

Null texts are empty.  Rows without an id, or with a repeated one, are
documents like any other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.llm.induced_sorting import permuted_lcp, suffix_array
from wingspan.llm.passages import (MIX, Passages, Rows, anchor_groups, anchored_runs, chosen_texts, contents, covered,
                                   packed_texts, places, scramble, text_windows, unpacked, with_key)

WINDOW_BYTES = 400
GRAM_BYTES = 32
ARRAY_CONTENTS = 50_000  # distinct contents of one anchor in one array: under 40 MB
SHARD_BYTES = 1 << 20


def cutter(window: int = WINDOW_BYTES, gram: int = GRAM_BYTES):
    """Passages of byte windows; ``gram`` is a power of two."""
    def cut(texts: list[bytes]) -> Passages | None:
        data = b"".join(texts)
        if len(data) < window:
            return None
        g, size = scramble(np.frombuffer(data, np.uint8).astype(np.uint64) + MIX[0]), 1
        while size < gram:
            g = scramble(g[:-size] * MIX[0] + g[size:])
            size *= 2
        text, origin, inside = text_windows(np.fromiter(map(len, texts), np.int64, len(texts)), window)
        at, start, count = anchored_runs(g, window - gram + 1, inside)
        text = text[start]
        return Passages(data, text, g[at], start - origin[text], count, start, start + count + window - 1, at - start)
    return cut


def repeated_windows(contents: list[bytes], window: int) -> list[np.ndarray]:
    """Per content, the starts of the windows that occur again in the contents."""
    text = b"".join(c + b"\x00" for c in contents)
    symbols = np.frombuffer(text, np.uint8).astype(np.int64) + 2
    ends = np.cumsum([len(c) + 1 for c in contents]) - 1
    starts = ends - [len(c) for c in contents]
    symbols[ends] = 1
    sa = suffix_array(np.append(symbols, 0))
    # separators compare equal here, but a whole window holds none
    common = permuted_lcp(text + b"\x00", sa, starts, max(map(len, contents)) + 8)
    near = common >= window
    near[sa[:-1]] |= near[sa[1:]]
    return [np.flatnonzero(near[s:max(s, e - window + 1)]) for s, e in zip(starts.tolist(), ends.tolist())]


def may_share(group: list[tuple], window: int, gram: int) -> list[tuple[bytes, int]]:
    """(content, n) of the contents of one anchor that can share a window with another one.

    A window reaches at least half of (window - gram) bytes beyond one end
    of the anchor gram, so two contents with a common window agree on that
    many bytes before the gram or after it.
    """
    half = (window - gram) // 2
    sides = [(c[o - half:o] if o >= half else None, c[o + gram:o + gram + half]) for c, _, _, _, o in group]
    before, after = Counter(x for x, _ in sides), Counter(y for _, y in sides if len(y) == half)
    return [(c, n) for (c, _, _, n, _), (x, y) in zip(group, sides)
            if x is not None and before[x] > 1 or after[y] > 1]


def _ranges(starts: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Byte ranges covered by windows at the sorted ``starts``."""
    gap = np.diff(starts) > window
    return (starts[np.concatenate([[True], gap])].tolist(),
            (starts[np.concatenate([gap, [True]])] + window).tolist())


def repeated_ranges(shards: DataFrame, window: int, gram: int, array_contents: int) -> DataFrame:
    """(digest, los, his): the byte ranges of each content covered by repeated windows."""
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(["meet", "n", "digest", "los", "his"], [pa.binary(), pa.int64(), pa.binary(), longs, longs])

        def add(content: bytes, los: list[int], his: list[int]) -> None:
            d = xxhash.xxh3_128_digest(content)
            out.add(d, 2, d, los, his)

        def solve(group: list[tuple[bytes, int]]) -> None:
            for (c, n), starts in zip(group, repeated_windows([c for c, _ in group], window)):
                if n > 1:
                    add(c, [0], [len(c)])
                elif len(starts):
                    add(c, *_ranges(starts, window))

        shard, size = [], 0
        for group, whole in anchor_groups(batches, array_contents):
            if not whole:
                for c, _, _, n, _ in group:
                    d = xxhash.xxh3_128_digest(c)
                    for i in range(len(c) - window + 1):
                        out.add(xxhash.xxh3_128_digest(c[i:i + window]), n, d, [i], [i + window])
                    yield from out.full()
            else:
                near = may_share(group, window, gram)
                shared = {c for c, _ in near}
                for c, _, _, n, _ in group:
                    if n > 1 and c not in shared:
                        add(c, [0], [len(c)])
                shard += near
                size += sum(len(c) for c, _ in near)
                if size >= SHARD_BYTES:
                    solve(shard)
                    shard, size = [], 0
            yield from out.full()
        if shard:
            solve(shard)
        yield from out.rest()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(["digest", "los", "his"], [pa.binary(), longs, longs])
        at, first = None, None  # the first row of a meeting waits until another proves it repeated
        for b in batches:
            for meet, n, digest, los, his in zip(*(c.to_pylist() for c in b.columns)):
                if meet != at:
                    at, first = meet, (digest, los, his)
                    if n > 1:
                        out.add(*first)
                        first = None
                    continue
                if first is not None:
                    out.add(*first)
                    first = None
                out.add(digest, los, his)
            yield from out.full()
        yield from out.rest()

    lists = "los array<long>, his array<long>"
    found = shards.mapInArrow(run, f"meet binary, n long, digest binary, {lists}")
    return found.repartition("meet").sortWithinPartitions("meet").mapInArrow(settle, f"digest binary, {lists}")


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_BYTES,
                gram: int = GRAM_BYTES, array_contents: int = ARRAY_CONTENTS) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept): kept is the remaining bytes of each row's text."""
    keyed, cut = with_key(docs, id_col, text_col), cutter(window, gram)
    texts = packed_texts(keyed)
    chosen = chosen_texts(texts, keyed, cut, True)
    ranges = repeated_ranges(contents(chosen, cut), window, gram, array_contents)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, lo, hi = [], [], []
            for at, los, his in zip(*(c.to_pylist() for c in b.columns)):
                for key, _, s in np.frombuffer(at, np.int64).reshape(-1, 3).tolist():
                    keys += [key] * len(los)
                    lo += [s + x for x in los]
                    hi += [s + x for x in his]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, lo, hi)], ["key", "lo", "hi"])

    spans = (places(chosen, cut).join(ranges, "digest").select("places", "los", "his")
             .mapInArrow(spread, "key long, lo long, hi long")
             .groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    whole = texts.join(spans, "key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, runs, kept = [], [], [], []
            for t, s in zip(unpacked(b.column(1)), b.column(2)):
                cut = covered(len(t), s.values)
                total.append(len(t))
                gone.append(int(cut.sum()))
                runs.append(int(np.count_nonzero(np.diff(cut.astype(np.int8), prepend=0) == 1)))
                kept.append(np.frombuffer(t, np.uint8)[~cut].tobytes() if gone[-1] else t)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (total, gone, runs)),
                                              pa.array(kept, pa.binary())],
                                             [id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return whole.select("id", "packed", "spans").mapInArrow(
        run, f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept binary")
