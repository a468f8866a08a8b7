"""Substring dedup with suffix automata of reference shards.

A document's words that lie in a window of ``window`` words whose sequence
also starts in a document with a smaller id are removed.

Only passages whose anchor repeats can hold such windows (see ``passages``).
Their distinct contents are the reference; a shard holds the contents of one
range of anchors, so all copies of a window meet in one shard.  In each
shard the contents of an anchor form a suffix automaton, every state of
which knows the smallest document id of its occurrences.  The contents then
stream through it: the matching statistics give, at every word, the longest
match that ends there, and where it spans a window the state of that suffix
names the window's first document (its owner).  The owners go back to the
places of each content, and a place keeps its words where the owner is not
smaller than its own document.

A copied passage is one row per batch and distinct content, however many
documents share it; the join back to the places is a plain shuffle join that
splits hot contents.  An anchor with more than ``automaton_contents``
distinct contents (a short common line amid different texts) is too large
for one automaton; its windows get their owners from a sorted meeting of
equal windows instead, with the same result and nothing held.

Null texts have no words.  Rows without an id come after all ids: windows
found in a document with an id are removed from them, and they remove
nothing.  Rows that share an id never remove each other's words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.llm.passages import (MIX, NO_ID, Passages, Rows, anchor_groups, anchored_runs, chosen_texts, contents,
                                   covered, packed_texts, places, scramble, text_windows, unpacked, with_key)

WINDOW_WORDS = 13
GRAM_WORDS = 3
PLAIN_LENGTH = 14
AUTOMATON_CONTENTS = 20_000


def cutter(window: int = WINDOW_WORDS, gram: int = GRAM_WORDS):
    """Passages of word windows; data is the words joined by one space.

    Grams of short words are common everywhere, so they are anchors only
    where a window has no other.
    """
    def cut(texts: list[bytes]) -> Passages | None:
        split = [t.split() for t in texts]
        words = list(chain.from_iterable(split))
        n = len(words)
        if n < window:
            return None
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        length = np.fromiter(map(len, words), np.int64, n)
        m = n - gram + 1
        g, size = np.zeros(m, np.uint64), np.zeros(m, np.int64)
        for k in range(gram):
            g = g * MIX[0] + h[k:k + m]
            size += length[k:k + m]
        g = scramble(g)
        plain = (size < PLAIN_LENGTH).astype(np.uint64) << np.uint64(63)
        text, origin, inside = text_windows(np.fromiter(map(len, split), np.int64, len(split)), window)
        at, start, count = anchored_runs((g >> np.uint64(1)) | plain, window - gram + 1, inside)
        text = text[start]
        ends = np.cumsum(length + 1)
        begins = ends - length - 1
        return Passages(b" ".join(words), text, g[at], start - origin[text], count, begins[start],
                        ends[start + count + window - 2] - 1, begins[at] - begins[start])
    return cut


class SuffixAutomaton:
    """Suffix automaton of several word sequences, each with an owner; states know their smallest owner."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [NO_ID]
        self.last = 0

    def add(self, words: list, owner: int) -> None:
        """Append one sequence; a mark of its own keeps matches from running into the one before."""
        for w in (len(self.next), *words):
            self._extend(w, owner)

    def _extend(self, w, owner: int) -> None:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        self.owner.append(owner)
        p = self.last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                self.owner.append(NO_ID)
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.last = new

    def finish(self) -> None:
        """Hand the smallest owner of each state up its suffix links, longest first."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            if self.owner[s] < self.owner[up]:
                self.owner[up] = self.owner[s]

    def owners(self, words: list, window: int) -> list[int]:
        """Owner of each window of the sequence; windows that no added sequence holds get ``NO_ID``."""
        out, state, matched = [], 0, 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                matched += 1
            if i + 1 >= window:
                owner = NO_ID
                if matched >= window:
                    while self.length[self.link[state]] >= window:
                        state = self.link[state]
                    matched = min(matched, self.length[state])
                    owner = self.owner[state]
                out.append(owner)
        return out


def window_owners(shards: DataFrame, window: int, automaton_contents: int) -> DataFrame:
    """(digest, first, owners): smallest ids of a content's windows from window ``first`` on.

    Only contents of which some place can lose words have rows.  Anchors
    with too many contents for one automaton go on window by window: equal
    windows meet sorted by id, so the first names the owner and nothing is
    held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(["meet", "low", "high", "digest", "first", "owners"],
                    [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64())])
        for group, whole in anchor_groups(batches, automaton_contents):
            rows = [(c, c.split(), low, high) for c, low, high, _, _ in group]
            if not whole:
                for c, words, low, high in rows:
                    d = xxhash.xxh3_128_digest(c)
                    for i in range(len(words) - window + 1):
                        out.add(xxhash.xxh3_128_digest(b" ".join(words[i:i + window])), low, high, d, i, None)
                    yield from out.full()
                continue
            automaton = None
            if len(rows) > 1:
                automaton = SuffixAutomaton()
                for _, words, low, _ in rows:
                    automaton.add(words, low)
                automaton.finish()
            for c, words, low, high in rows:
                own = automaton.owners(words, window) if automaton else [low] * (len(words) - window + 1)
                if min(own) < high:
                    d = xxhash.xxh3_128_digest(c)
                    out.add(d, low, high, d, 0, own)
            yield from out.full()
        yield from out.rest()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(["digest", "first", "owners"], [pa.binary(), pa.int32(), pa.list_(pa.int64())])
        at, owner = None, 0
        for b in batches:
            for meet, low, high, digest, first, owners in zip(*(c.to_pylist() for c in b.columns)):
                if owners is not None:
                    out.add(digest, first, owners)
                else:
                    if meet != at:
                        at, owner = meet, low
                    if owner < high:
                        out.add(digest, first, [owner])
            yield from out.full()
        yield from out.rest()

    found = shards.mapInArrow(run, "meet binary, low long, high long, digest binary, first int, owners array<long>")
    return found.repartition("meet").sortWithinPartitions("meet", "low").mapInArrow(
        settle, "digest binary, first int, owners array<long>")


def removed_spans(texts: DataFrame, keyed: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS,
                  automaton_contents: int = AUTOMATON_CONTENTS) -> DataFrame:
    """(key, spans): per row the word ranges (lo, hi) covered by removable windows, unmerged."""
    cut = cutter(window, gram)
    chosen = chosen_texts(texts, keyed, cut, False)
    owners = window_owners(contents(chosen, cut), window, automaton_contents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, lo, hi = [], [], []
            for at, first, own in zip(*(c.to_pylist() for c in b.columns)):
                least, most, width = min(own), max(own), len(own) - 1 + window
                for key, i, s in np.frombuffer(at, np.int64).reshape(-1, 3).tolist():
                    if most < i:  # every window goes, the usual case
                        keys.append(key)
                        lo.append(s + first)
                        hi.append(s + first + width)
                    elif least < i:
                        for k, o in enumerate(own):
                            if o < i:
                                keys.append(key)
                                lo.append(s + first + k)
                                hi.append(s + first + k + window)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, lo, hi)], ["key", "lo", "hi"])

    spans = (places(chosen, cut).join(owners, "digest").select("places", "first", "owners")
             .mapInArrow(run, "key long, lo long, hi long"))
    return spans.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """(id_col, n_words, n_removed, kept) of every row: kept is the remaining words joined by one space (bytes)."""
    keyed = with_key(docs, id_col, text_col)
    texts = packed_texts(keyed)
    whole = texts.join(removed_spans(texts, keyed, **params), "key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            for t, s in zip(unpacked(b.column(1)), b.column(2)):
                words = t.split()
                out = covered(len(words), s.values)
                total.append(len(words))
                gone.append(int(out.sum()))
                kept.append(b" ".join(words[i] for i in np.flatnonzero(~out).tolist()) if gone[-1]
                            else b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.binary())], [id_col, "n_words", "n_removed", "kept"])

    return whole.select("id", "packed", "spans").mapInArrow(
        run, f"`{id_col}` long, n_words long, n_removed long, kept binary")
