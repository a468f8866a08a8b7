"""A search index in versioned segments (TX12, TX13, ST7).

Layout under the index folder::

    segments/<name>/rows/       key, content hash, dl (words) and the chunk's columns
    segments/<name>/postings/   key, term, tf, dl; every file sorted by term and key
    deletes/<name>/             keys whose rows in older segments are gone
    manifests/<version>.json    the segments and deletes of a version, its live counts, the epoch of each feed

A version exists once its manifest does.  The manifest is written under
another name and renamed, and the rename fails if the version is there already:
readers see the old version or the new one, and of two writers one has to try
again.  Files of a writer that stopped before the rename belong to no version;
:meth:`VersionedIndex.vacuum` removes them.

* :meth:`apply` writes one segment with the inserted and updated rows, and the
  keys that they and the deletions replace; other segments stay as they are.
  Rows whose content is unchanged are not written again.  An epoch that a feed
  has applied before changes nothing.
* A row of segment s is live unless its key was deleted in a version after s.
* :meth:`merge` joins the small segments into one and forgets deletions that
  no segment is older than.
* :meth:`search` reads the postings of the query's terms only (a pushed-down
  filter on files sorted by term) and scores them by BM25 over the live rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.operators.manifests import ManifestLog
from wingspan.operators.search import BM25_B, BM25_K1, query_terms, top_k
from wingspan.operators.text import tokens

SMALL_ROWS = 100_000  # segments below this many rows are merged
_EMPTY = {"segments": [], "deletes": [], "epochs": {}, "rows": 0, "words": 0}


def _nothing(step: str) -> None:
    """Called after every step of a writer; tests stop a writer here."""


def _write(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").parquet(path)


def _counted(batches):
    """(key, term, tf, dl) of rows (key, dl, terms)."""
    import numpy as np
    import pyarrow as pa
    for b in batches:
        terms = b.column("terms")
        row = np.repeat(np.arange(b.num_rows), terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        names = terms.flatten().dictionary_encode()
        if not len(row):
            continue
        held, n = len(names.dictionary), names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, tf = np.unique(row * held + n, return_counts=True)
        keep = np.array([bool(w) for w in names.dictionary.to_pylist()])[pairs % held]
        pairs, tf = pairs[keep], tf[keep]
        at = pa.array(pairs // held)
        yield pa.RecordBatch.from_arrays([b.column("key").take(at), names.dictionary.take(pa.array(pairs % held)),
                                          pa.array(tf, pa.int64()), b.column("dl").take(at)],
                                         names=["key", "term", "tf", "dl"])


class VersionedIndex(ManifestLog):
    """Index of rows named by ``key`` with the text column ``text`` under ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "chunk_id", text: str = "search_text"):
        super().__init__(spark, path, _EMPTY)
        self.key, self.text = key, text

    # -- reading -----------------------------------------------------------
    def _dead(self, state: dict) -> DataFrame:
        """(key, gone): the last version that deleted the key."""
        out = None
        for d in state["deletes"]:
            one = self.spark.read.parquet(f"{self.path}/deletes/{d['name']}").select(
                self.key, F.lit(d["version"]).cast("long").alias("_gone"))
            out = one if out is None else out.unionByName(one)
        return None if out is None else out.groupBy(self.key).agg(F.max("_gone").alias("_gone"))

    def _live(self, state: dict, part: str, only: list[dict] | None = None, keep=lambda df: df) -> DataFrame | None:
        out = None
        for s in state["segments"] if only is None else only:
            one = keep(self.spark.read.parquet(f"{self.path}/segments/{s['name']}/{part}")).withColumn(
                "_made", F.lit(s["version"]).cast("long"))
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
        dead = self._dead(state)
        if out is not None and dead is not None:
            out = out.join(dead, self.key, "left").filter(F.col("_gone").isNull() | (F.col("_gone") <= F.col("_made")))
            out = out.drop("_gone")
        return None if out is None else out.drop("_made")

    def rows(self, version: int | None = None) -> DataFrame | None:
        """The live rows of a version; None for an index without segments."""
        return self._live(self.manifest(version), "rows")

    # -- writing -----------------------------------------------------------
    def _write_segment(self, name: str, rows: DataFrame, step: Callable[[str], None]) -> tuple[int, int]:
        base = f"{self.path}/segments/{name}"
        _write(rows, f"{base}/rows")
        step("rows written")
        made = self.spark.read.parquet(f"{base}/rows")
        # a segment holds a key once, so its terms are counted within the row
        kind = made.schema[self.key].dataType.simpleString()
        post = made.select(F.col(self.key).alias("key"), "dl", tokens(F.col(self.text)).alias("terms")).mapInArrow(
            _counted, f"key {kind}, term string, tf long, dl long").withColumnRenamed("key", self.key)
        # sorted files, so that a search reads the row groups of its terms: no posting leaves its task
        _write(post.sortWithinPartitions("term", self.key), f"{base}/postings")
        step("postings written")
        got = made.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("w")).first()
        return int(got.n), int(got.w)

    def _totals(self, state: dict) -> None:
        live = self._live(state, "rows", keep=lambda df: df.select(self.key, "dl"))
        got = None if live is None else live.agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("w")).first()
        state["rows"], state["words"] = (int(got.n), int(got.w or 0)) if got else (0, 0)

    def apply(self, changes: DataFrame, op: str = "change", epoch: int | None = None, feed: str = "feed",
              order: str | None = None, step: Callable[[str], None] = _nothing) -> dict:
        """Apply (key, op, columns of the chunk) rows: op ``deleted`` removes a key, any other one upserts it.

        Of several rows of a key the one with the largest ``order`` column
        stays (without one: the largest content hash).  Rows without a key
        are an error.  Returns the manifest in force.
        """
        state = self.manifest()
        if epoch is not None and epoch <= state["epochs"].get(feed, -1):
            return state
        n_words = F.size(F.filter(tokens(F.coalesce(F.col(self.text), F.lit(""))), lambda t: F.length(t) > 0))
        content = F.sha2(F.coalesce(F.col(self.text), F.lit("")), 256)
        new = changes.withColumns({"content_hash": content, "dl": n_words.cast("long")})
        columns = [self.key, *[c for c in new.columns if c not in (self.key, op)]]
        newest = F.struct(*([order] if order else []), "content_hash")
        new = new.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in new.columns if c != self.key]), newest).alias("_r"))
        new = new.select(self.key, "_r.*")
        before = self._live(state, "rows", keep=lambda df: df.select(self.key, F.unhex("content_hash").alias("_was")))
        new = (new.withColumn("_was", F.lit(None).cast("binary")) if before is None
               else new.join(before, self.key, "left"))
        name, version = uuid.uuid4().hex, state["version"] + 1
        gone = F.col(op) == "deleted"
        # rows without a key are staged for the error: the feed is worked out once
        changed = new.filter(F.col(self.key).isNull() | (gone & F.col("_was").isNotNull())
                             | (~gone & ~F.col("_was").eqNullSafe(F.unhex("content_hash"))))
        # the hash is made again from the text, which it does not compress with
        changed = changed.withColumn("_was", F.col("_was").isNotNull()).drop("content_hash")
        staged = f"{self.path}/segments/{name}/changes"
        _write(changed, staged)
        step("changes written")
        changed = self.spark.read.parquet(staged)
        counts = changed.agg(F.count_if(~gone).alias("up"), F.count_if("_was").alias("old"),
                             F.count_if(F.col(self.key).isNull()).alias("unnamed")).first()
        if counts.unnamed:
            raise ValueError(f"change rows without a {self.key}")
        if counts.up:
            n, words = self._write_segment(name, changed.filter(~gone).withColumn("content_hash", content)
                                           .select(*columns), step)
            state["segments"].append({"name": name, "version": version, "rows": n, "words": words})
        if counts.old:
            changed.filter("_was").select(self.key).write.parquet(f"{self.path}/deletes/{name}")
            step("deletes written")
            state["deletes"].append({"name": name, "version": version})
        if epoch is not None:
            state["epochs"][feed] = epoch
        state["version"] = version
        self._totals(state)
        self._commit(state, step)
        return state

    def merge(self, small_rows: int = SMALL_ROWS, step: Callable[[str], None] = _nothing) -> dict:
        """Join all segments below ``small_rows`` rows into one; the larger ones are not read."""
        state = self.manifest()
        small = [s for s in state["segments"] if s["rows"] < small_rows]
        if len(small) < 2:
            return state
        name = uuid.uuid4().hex
        n, words = self._write_segment(name, self._live(state, "rows", small), step)
        merged = {"name": name, "version": max(s["version"] for s in small), "rows": n, "words": words}
        state["segments"] = [s for s in state["segments"] if s not in small] + ([merged] if n else [])
        oldest = min((s["version"] for s in state["segments"]), default=state["version"] + 1)
        state["deletes"] = [d for d in state["deletes"] if d["version"] > oldest]
        state["version"] += 1
        self._commit(state, step)
        return state

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove files that the last ``keep`` versions do not name (no writer may be active); returns the names."""
        kept = self.versions()[-keep:]
        used = {s["name"] for v in kept for s in (lambda m: m["segments"] + m["deletes"])(self.manifest(v))}
        gone = []
        for part in ("segments", "deletes"):
            fs, p = self._fs(f"{self.path}/{part}")
            for f in fs.listStatus(p) if fs.exists(p) else []:
                if f.getPath().getName() not in used:
                    gone.append(f"{part}/{f.getPath().getName()}")
                    fs.delete(f.getPath(), True)
        fs, p = self._fs(f"{self.path}/manifests")
        for f in fs.listStatus(p) if fs.exists(p) else []:
            if f.getPath().getName() not in {f"{v:012d}.json" for v in kept}:
                gone.append(f"manifests/{f.getPath().getName()}")
                fs.delete(f.getPath(), False)
        return sorted(gone)

    # -- search ------------------------------------------------------------
    def search(self, query_text: str, k: int = 8, filters: dict | None = None,
               version: int | None = None) -> DataFrame | None:
        """TX12: the k best live rows for one query string, with equality filters (FLT8) on their columns."""
        state = self.manifest(version)
        q = self.spark.createDataFrame([(0, query_text)], "query_id int, query_text string")
        terms = [r.term for r in query_terms(q).select("term").distinct().collect()]  # words of one query
        post = self._live(state, "postings", keep=lambda df: df.filter(F.col("term").isin(terms)))
        if post is None:
            return None
        n, avgdl = state["rows"], state["words"] / max(state["rows"], 1)
        df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
        weight = F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / F.lit(avgdl)))
        hits = post.join(df, "term").groupBy(self.key).agg(F.sum(idf * weight).alias("score"))
        rows = self._live(state, "rows")
        for c, v in (filters or {}).items():
            rows = rows.filter(F.col(c) == F.lit(v))
        if filters:
            hits = hits.join(rows.select(self.key), self.key, "left_semi")
        best = top_k(hits.withColumn("query_id", F.lit(0)), k, "query_id", [F.round("score", 9).desc(), F.col(self.key)])
        return best.drop("query_id").join(rows, self.key).orderBy("rank")


def sync_stream(stream: DataFrame, index: VersionedIndex, checkpoint: str, feed: str = "stream",
                order: str | None = None, step: Callable[[str], None] = _nothing):
    """ST7: a change stream (key, change, columns) drained into the index, one version a micro-batch.

    A batch that is replayed after a failure finds its epoch applied and
    changes nothing, or no such epoch and is applied in full.
    """
    q = (stream.writeStream.foreachBatch(lambda batch, epoch: index.apply(batch, epoch=epoch, feed=feed, order=order,
                                                                          step=step) and None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
