"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of documents.  A round is one window of
``length`` tokens; each queue earns its share of the window (its target
proportion), serves the whole tokens it has earned and carries the rest as
its deficit into the next round.  An emptied queue gives its share up to the
others.  The served tokens of all rounds form one stream, cut into
sequences of exactly ``length`` tokens (only the last may be shorter), so
any sequence is within one token per queue of the targets plus what the
deficits carried over.

Because a queue's deficit after k rounds is a closed form of k, any task can
place its documents on its own: it needs the number of tokens before the
document in its queue and the schedule, a table bounded by the square of the
number of top queues.  One pass tokenizes and writes the ids with running offsets per
(task, queue); a second adds the offsets of the tasks before it.  No queue is
ever gathered or ordered in one task, so a source with a third of all rows
costs nothing extra, and a lost executor costs the tasks it ran.

Sources beyond the ``max_queues`` - 1 largest that ``targets`` does not name
share the top queue "rest", which is a round-robin of its own with rounds of
one token: its queues are groups of at most ``max_queues`` sources (or, for
more sources, of such groups), weighted by their tokens, so every source
keeps its share of any stretch of the rest.  The path of a source, its
position in the groups and the sizes beside it, is joined to its (task,
source) offsets; no task holds more than the groups it meets.

Null and empty texts have the end id only; a
null source is a queue of its own; repeated rows are packed one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wingspan.llm.common import stored
from wingspan.llm.tokens import encoder
from wingspan.operators.ordering import global_row_number, join_null_safe

SEQUENCE_TOKENS = 2048
END_ID = 1
MAX_QUEUES = 256
SHARE_UNITS = 1 << 16
_TAIL_TOKENS = 1 << 12
_CACHED_GROUPS = 64
_BATCH_TOKENS = 1 << 21


@dataclass
class Schedule:
    """Closed form of the round-robin: served tokens of each queue after k rounds.

    Epoch e starts at round ``first[e]`` with ``base`` tokens served and a
    deficit of ``rest`` / ``total`` tokens; active queues earn
    ``length * weight / total`` a round.
    """

    tokens: np.ndarray
    length: int
    first: np.ndarray
    base: np.ndarray
    rest: np.ndarray
    weight: np.ndarray
    total: np.ndarray

    def served(self, k: np.ndarray) -> np.ndarray:
        """(queues x len(k)) tokens served before round k."""
        e = np.searchsorted(self.first, k, side="right") - 1
        earned = (self.rest[:, e] + (k - self.first[e]) * (self.length * self.weight[:, e])) // self.total[e]
        return np.minimum(self.tokens[:, None], self.base[:, e] + earned)

    def round_of(self, queue: int, i: int) -> int:
        """The round that serves token i (from 0) of a queue."""
        e = int(np.searchsorted(self.base[queue], i, side="right")) - 1
        need = (i - int(self.base[queue, e]) + 1) * int(self.total[e]) - int(self.rest[queue, e])
        per = self.length * int(self.weight[queue, e])
        return int(self.first[e]) + -(-need // per) - 1

    def positions(self, queue: int, i: np.ndarray) -> np.ndarray:
        """Stream positions of tokens ``i`` (from 0) of a queue."""
        e = np.searchsorted(self.base[queue], i, side="right") - 1
        need = (i - self.base[queue, e] + 1) * self.total[e] - self.rest[queue, e]
        k, which = np.unique(self.first[e] - (-need // (self.length * self.weight[queue, e])) - 1,
                             return_inverse=True)
        s = self.served(k)
        head = s.sum(0) + (self.served(k + 1)[:queue] - s[:queue]).sum(0)
        return head[which] + i - s[queue, which]

    def place(self, queue: int, start: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Cuts of tokens [start, start + n) of a queue: (token offsets from start, stream positions)."""
        k = np.arange(self.round_of(queue, start), self.round_of(queue, start + n - 1) + 2)
        s = self.served(k)
        chunk = s[:, 1:] - s[:, :-1]
        head = s[:, :-1].sum(0) + chunk[:queue].sum(0)  # stream position of the queue's chunk of each round
        lo = np.maximum(s[queue, :-1], start)
        hi = np.minimum(s[queue, 1:], start + n)
        at = head + lo - s[queue, :-1]
        full = hi > lo
        lo, hi, at = lo[full] - start, hi[full] - start, at[full]
        over = at // self.length != (at + hi - lo - 1) // self.length  # crosses a sequence end once
        cut = self.length - at[over] % self.length
        order = np.argsort(np.concatenate([lo, lo[over] + cut]), kind="stable")
        return (np.concatenate([lo, lo[over] + cut])[order], np.concatenate([at, at[over] + cut])[order])


def schedule(tokens: list[int], shares: list[float], length: int = SEQUENCE_TOKENS,
             share_units: int = SHARE_UNITS) -> Schedule:
    """Epochs of the round-robin; each ends when a queue runs empty, so there are at most as many as queues."""
    t = np.array(tokens, dtype=np.int64)
    scale = share_units / max(sum(shares), 1e-300)
    units = [max(1, round(x * scale)) for x in shares]
    m = len(t)
    served, deficit = [0] * m, [0.0] * m
    first, base, rest, weight, total = [], [], [], [], []
    k = 0
    while True:
        live = [j for j in range(m) if served[j] < t[j]]
        if not live and first:
            break
        w = [units[j] if served[j] < t[j] else 0 for j in range(m)]
        whole = max(sum(w), 1)
        r = [int(deficit[j] * whole) if w[j] else 0 for j in range(m)]
        for kept, row in ((first, k), (base, served[:]), (rest, r), (weight, w), (total, whole)):
            kept.append(row)
        if not live:
            break
        steps = min(-(-((int(t[j]) - served[j]) * whole - r[j]) // (length * w[j])) for j in live)
        for j in live:
            earned = r[j] + steps * length * w[j]
            served[j] = min(int(t[j]), served[j] + earned // whole)
            deficit[j] = earned % whole / whole
        k += steps
    kind = np.int64
    return Schedule(t, length, np.array(first, kind), np.array(base, kind).reshape(-1, m).T,
                    np.array(rest, kind).reshape(-1, m).T, np.array(weight, kind).reshape(-1, m).T,
                    np.array(total, kind))


def _group(sizes: list[int]) -> Schedule:
    """Round-robin of a group inside the rest: one token a round, weights as near the sizes as 64 bits allow."""
    whole = sum(sizes)
    return schedule(sizes, sizes, 1, min(whole, (1 << 62) // whole))


def _tail_cuts(plan: Schedule, path: list[tuple[int, Schedule]], queue: int, start: int,
               n: int) -> tuple[np.ndarray, np.ndarray]:
    """``Schedule.place`` for tokens of a source inside the rest; ``path`` leads from its group up."""
    cuts, at, last = [], [], -2
    for lo in range(0, n, _TAIL_TOKENS):
        i = np.arange(start + lo, start + min(n, lo + _TAIL_TOKENS))
        for child, group in path:
            i = group.positions(child, i)
        i = plan.positions(queue, i)
        new = (np.diff(i, prepend=last) != 1) | (i % plan.length == 0)
        cuts.append(np.flatnonzero(new) + lo)
        at.append(i[new])
        last = i[-1]
    return np.concatenate(cuts), np.concatenate(at)


def _queue_names(docs: DataFrame, source: str, max_queues: int, targets: dict) -> list:
    """The sources with top queues: the largest by rows, at most ``max_queues`` - 1, and those with targets."""
    rows = docs.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("n"))
    names = [r.s for r in rows.orderBy(F.col("n").desc(), F.col("s").asc_nulls_first()).limit(max_queues).collect()]
    if len(names) < max_queues:
        return names
    names = names[:max_queues - 1]
    return names + [t for t in targets if t not in names]


def _paths(sizes: DataFrame, n_sources: int, width: int) -> DataFrame:
    """(_tail, _rank, _sizes) of the sources in ``sizes`` (_tail, n): largest first, groups of ``width``.

    _sizes has the sizes of the source's group, then of the groups in the
    group above, up to the one that holds all.
    """
    ranked = global_row_number(sizes, [F.col("n").desc(), F.col("_tail").asc_nulls_first()], "_rank", reuse=True)
    paths = ranked.select("_tail", (F.col("_rank") - 1).alias("_rank"),
                          F.array().cast("array<array<bigint>>").alias("_sizes"))
    level, below = ranked.select((F.col("_rank") - 1).alias("at"), "n"), 1
    while True:
        up = stored(level.groupBy(F.floor(F.col("at") / width).alias("at")).agg(
            F.array_sort(F.collect_list(F.struct("at", "n"))).alias("own"), F.sum("n").alias("n")), "queue-groups")
        below *= width
        paths = paths.join(up.select("at", F.col("own.n").alias("own")),
                           F.floor(F.col("_rank") / below) == F.col("at")).select(
            "_tail", "_rank", F.concat("_sizes", F.array("own")).alias("_sizes"))
        level = up.select("at", "n")
        if below >= n_sources:
            return paths


def _queue(source: str, names: list) -> Column:
    """Number of a row's queue; len(names) is the shared one."""
    out = F.lit(len(names))
    if None in names:
        out = F.when(F.col(source).isNull(), names.index(None)).otherwise(out)
    known = {n: i for i, n in enumerate(names) if n is not None}
    if known:
        table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
        out = F.coalesce(F.get(F.array(F.element_at(table, F.col(source))), F.lit(0)), out)
    return out.cast("int")


def tokenized(docs: DataFrame, id_col: str, text_col: str, queue: Column, tail: Column, tokenizer: str | None,
              end_id: int) -> DataFrame:
    """(id_col, _queue, _tail, _part, _before, _n, _ids): ids of each text and end_id, 16 or 32 bits each.

    _tail is the source of a row in the last queue, and null in the others;
    _before counts the tokens of the same queue and _tail ahead in the same
    task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, ahead = encoder(tokenizer), TaskContext.get().partitionId(), {}
        narrow = enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        end = np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            ids = [x + end for x in enc.encode([t or "" for t in b.column(3).to_pylist()])]
            counts = [len(x) // 4 for x in ids]
            before = []
            for *q, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), counts):
                q = tuple(q)
                before.append(ahead.get(q, 0))
                ahead[q] = before[-1] + n
            if narrow:
                ids = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([part] * len(ids), pa.int32()),
                 pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                [id_col, "_queue", "_tail", "_part", "_before", "_n", "_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), queue.alias("_queue"), tail.alias("_tail"), F.col(text_col).alias("_t"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, _queue int, _tail {rows.schema['_tail'].dataType.simpleString()}, "
                                "_part int, _before long, _n long, _ids binary")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: str = "source",
         targets: dict[str | None, float] | None = None, length: int = SEQUENCE_TOKENS,
         tokenizer: str | None = None, end_id: int = END_ID, max_queues: int = MAX_QUEUES) -> DataFrame:
    """Pieces of all documents in packed sequences.

    ``targets`` gives token proportions by source (sources left out share
    what is left to 1 by their size); None takes each source's own share, the
    one mixture that every window can hold to the end.  Columns: id_col,
    source_queue, start, length, doc_tokens, sequence_id, offset, ids
    (little-endian unsigned 32-bit ids of the piece).
    """
    names = _queue_names(docs, source, max_queues, targets or {})
    queue, rest = _queue(source, names), len(names)
    ids = stored(tokenized(docs, id_col, text_col, queue, F.when(queue == rest, F.col(source)), tokenizer, end_id),
                 "token-ids")
    parts = ids.groupBy("_queue", "_tail", "_part").agg(F.sum("_n").alias("n"))
    earlier = Window.partitionBy("_queue", "_tail").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(parts.withColumn("_first", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "queue-offsets")
    sizes = {r._queue: r.n for r in starts.groupBy("_queue").agg(F.sum("n").alias("n")).collect()}
    tokens = [sizes.get(q, 0) for q in range(rest + 1)]
    width, path_cols = max(2, max_queues), []
    if tokens[rest]:
        tail = stored(starts.filter(F.col("_queue") == rest).groupBy("_tail").agg(F.sum("n").alias("n")), "queue-tail")
        paths = _paths(tail, tail.count(), width).withColumn("_queue", F.lit(rest))
        starts = join_null_safe(starts, paths, ["_queue", "_tail"], "left")
        path_cols = ["_rank", "_sizes"]
    if targets is None:
        shares = [float(x) for x in tokens]
    else:
        named = [targets.get(n) for n in names] + [None]
        left = max(0.0, 1.0 - sum(x for x in named if x is not None))
        free = sum(n for n, x in zip(tokens, named) if x is None) or 1
        shares = [left * n / free if x is None else float(x) for n, x in zip(tokens, named)]
    plan = schedule(tokens, shares, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(cols: list[list], kind: pa.DataType) -> pa.RecordBatch:
            flat = [np.concatenate(c) for c in cols[1:6]]
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, n in cols[0] for _ in range(n)], kind), pa.array(flat[0], pa.int32()),
                 *map(pa.array, flat[1:4]), pa.array(flat[4] // length), pa.array(flat[4] % length),
                 pa.array(cols[6], pa.binary())],
                [id_col, "source_queue", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        groups: dict[tuple[int, int], Schedule] = {}

        def path(rank: int, row: pa.ListScalar) -> list[tuple[int, Schedule]]:
            out = []
            for k in range(len(row)):
                child, rank = rank % width, rank // width
                if (k, rank) not in groups:
                    if len(groups) >= _CACHED_GROUPS:
                        groups.clear()
                    groups[k, rank] = _group(row[k].as_py())
                out.append((child, groups[k, rank]))
            return out

        for b in batches:
            cols, held = [[] for _ in range(7)], 0
            ranks = b.column(5).to_pylist() if path_cols else [None] * b.num_rows
            for row, (doc, q, start, n, raw, rank) in enumerate(zip(*(b.column(i).to_pylist() for i in range(5)),
                                                                    ranks)):
                if rank is None:
                    lo, at = plan.place(q, start, n)
                else:
                    lo, at = _tail_cuts(plan, path(rank, b.column(6)[row]), q, start, n)
                    q += rank
                size = np.diff(lo, append=n)
                data = memoryview(raw if len(raw) == 4 * n else np.frombuffer(raw, "<u2").astype("<u4").tobytes())
                cols[0].append((doc, len(lo)))
                for c, x in zip(cols[1:6], (np.full(len(lo), q), lo, size, np.full(len(lo), n), at)):
                    c.append(x)
                cols[6] += [bytes(data[4 * a:4 * (a + s)]) for a, s in zip(lo.tolist(), size.tolist())]
                held += n
                if held >= _BATCH_TOKENS:
                    yield batch(cols, b.schema.field(0).type)
                    cols, held = [[] for _ in range(7)], 0
            if held:
                yield batch(cols, b.schema.field(0).type)

    kind = docs.schema[id_col].dataType.simpleString()
    if path_cols:
        placed = join_null_safe(ids, starts.drop("n"), ["_queue", "_tail", "_part"])
    else:
        placed = ids.join(starts.drop("n", "_tail"), ["_queue", "_part"])
    placed = placed.select(id_col, "_queue", (F.col("_first") + F.col("_before")).alias("_start"), "_n", "_ids",
                           *path_cols)
    return placed.mapInArrow(run, f"`{id_col}` {kind}, source_queue int, start long, length long, "
                                  "doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(pieces: DataFrame, length: int = SEQUENCE_TOKENS, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces joined in order, ids padded with ``pad_id``.

    A sequence whose size is a power of two stays unpadded.  A sequence
    holds at most ``length`` tokens, so the groups are bounded.
    """
    rows = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    pad = F.when(F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0, 0).otherwise(length - F.col("n_tokens"))
    end = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), pad.cast("int")))
    joined = F.aggregate("p", F.unhex(F.lit("")), lambda a, x: F.concat(a, x.ids))
    return rows.select("sequence_id", "n_tokens", F.concat(joined, end).alias("ids"))
