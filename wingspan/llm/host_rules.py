"""Quality rules with host verdicts.

Per document the operator counts rule evidence over the whole text and
decides ``base_failed``.  Rule failures are then aggregated per host; the
failure rate of a host is shrunk with a beta prior whose mean and strength
are estimated from all hosts (method of moments), and a host whose shrunk
rate reaches ``max_host_rate`` fails as a whole.  The verdict joins back to
the documents: kept = not base_failed and the host passed.

The host sums combine map-side, so a host with a third of all rows is a few
rows in the shuffle.  Null texts have no words; a null host is a host of its
own; repeated rows count one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.llm.common import stored, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words whose sequence occurs at least twice in the list."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code = ids[:n]
    for k in range(1, width):  # exact: renumber the pairs (window so far, next word)
        code = np.unique(code * len(number) + ids[k:k + n], return_inverse=True)[1]
    twice = np.bincount(code)[code] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[width:width + n] -= twice
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def rule_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """The counts of ``_COUNTS`` for one whole text."""
    words = data.split()
    solid = data.translate(None, SPACES)
    chars = len(solid.decode("utf-8", "replace"))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.split(None, 1):
            seen.add(line)
    return len(words), chars, symbols, dup, repeat_words(words)


def with_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host: str = "source") -> DataFrame:
    """Rows (id_col, _host, the rule counts, base_failed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([rule_counts(t) for t in b.column(2).to_pylist()], dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, got.T.copy())],
                                             [id_col, "_host", *_COUNTS])

    kinds = {c: docs.schema[c].dataType.simpleString() for c in (id_col, host)}
    schema = f"`{id_col}` {kinds[id_col]}, _host {kinds[host]}, " + ", ".join(f"{c} long" for c in _COUNTS)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (docs.select(F.col(id_col), F.col(host).alias("_host"), utf8(text_col).alias("_t"))
            .mapInArrow(run, schema).withColumn("base_failed", failed))


def host_verdicts(counted: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(_host, host_docs, host_rate, host_passed): failure rates under a fitted beta prior."""
    hosts = stored(counted.groupBy("_host").agg(
        F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "host-rules")
    s = hosts.agg(F.sum("failed").cast("double").alias("f"), F.sum("host_docs").cast("double").alias("n"),
                  F.count("*").alias("k"),
                  F.sum(F.col("failed") * F.col("failed") / F.col("host_docs")).alias("s2")).first()
    mean, strength = 0.0, 1.0
    if s.n:
        mean = s.f / s.n
        spread = s.s2 / s.n - mean * mean - mean * (1 - mean) * s.k / s.n
        strength = min(max(mean * (1 - mean) / max(spread, 1e-12) - 1, 1.0), 1e6)
    rate = (F.col("failed") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))
    return hosts.select("_host", "host_docs", rate.alias("host_rate"), (rate < max_host_rate).alias("host_passed"))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str = "source",
                max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: id_col, the rule counts, base_failed, host, host_rate, host_passed, kept."""
    counted = stored(with_counts(docs, id_col, text_col, host), "rule-counts")
    verdicts = host_verdicts(counted, max_host_rate).withColumnRenamed("_host", "_h")
    out = counted.join(verdicts, F.col("_host").eqNullSafe(F.col("_h")), "left")
    return out.select(id_col, *_COUNTS, "base_failed", F.col("_host").alias("host"), "host_rate", "host_passed",
                      (~F.col("base_failed") & F.col("host_passed")).alias("kept"))
