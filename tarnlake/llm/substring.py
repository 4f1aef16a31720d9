"""Substring deduplication through a log-structured fingerprint index.

Every window of 13 words is fingerprinted by the smallest hash of its seven-word grams, so neighbouring windows mostly share one and the index holds about a quarter of
the windows. Equal windows have equal fingerprints. Each batch of documents becomes a sorted, immutable run that is merge-joined with the older runs; windows
whose fingerprint two documents have are then compared by 96 bits of hash over all their words, which settles who has them first. (Both hashes are made of 64-bit hashes of words.)

A new run is merged with older ones no larger than GROWTH times what is merged so far. So a small batch never rewrites a large run, an entry is rewritten only when its run grows by half at least, and there are about as
many runs as doublings of the index: n ingests write O(n log n). Buckets are ranges of hashes, as many as the texts so far need; a run of fewer is cut finer as it is read.

:class:`SubstringIndex` keeps texts and runs in a folder, so a later session opens it, adds a batch, and gets what one run over all batches would give.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.batches import TextBatch, bucket_cells, buckets_for, from_planes, to_planes, write_batches
from tarnlake.llm.common import mix, rolling_hashes, scan_words, shared_dir, stage, word_hashes
from tarnlake.sources.sinks import VersionedTable

WINDOW, GRAM = 13, 7
#: Batches that one call ingests, and by how much a run may be larger than what is merged with it.
INGESTS, GROWTH = 2, 2
_RUN = "kind string, bucket int, batch string, data binary, owners binary, names array<string>"


class Windows:
    """The windows of a file's texts: where each starts, the rank of its document's id in the file, and hashes."""

    def __init__(self, batch: TextBatch, window: int, gram: int):
        self.batch, self.window = batch, window
        self.starts, self.ends, self.first = scan_words(batch.data, batch.offsets)
        self.hashes = word_hashes(batch.data, self.starts, self.ends)
        doc = np.repeat(np.arange(len(batch.ids)), np.diff(self.first))
        at = np.arange(len(self.hashes))
        self.at = at[at + window <= self.first[1:][doc]] if len(at) else at
        self.order, rank = np.unique(batch.order, return_inverse=True)
        self.rank = rank[doc[self.at]]
        grams = rolling_hashes(self.hashes, gram)
        low = grams[self.at].copy()
        for j in range(1, window - gram + 1):
            np.minimum(low, grams[self.at + j], out=low)
        self.prints = mix(low)

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct fingerprints in order, and whether documents of more than one id have them."""
        if not len(self.at):
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        new = np.ones(len(self.at), bool)
        new[1:] = (self.prints[1:] != self.prints[:-1]) | (self.rank[1:] != self.rank[:-1])
        prints, rank = self.prints[new], self.rank[new]
        order = np.argsort(prints, kind="stable")
        prints, rank = prints[order], rank[order]
        heads = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
        return prints[heads], np.minimum.reduceat(rank, heads) < np.maximum.reduceat(rank, heads)

    def candidates(self, hits: list[bytes]) -> Candidates:
        """Windows whose fingerprint is among ``hits`` or repeats between this file's documents."""
        own, several = self.fingerprints()
        wanted = np.unique(np.concatenate([own[several], *[np.frombuffer(h, np.uint64) for h in hits]]))
        place = np.minimum(np.searchsorted(wanted, self.prints), max(0, len(wanted) - 1))
        return Candidates(self, np.flatnonzero(wanted[place] == self.prints) if len(wanted) else np.zeros(0, np.int64))


class Candidates:
    """Distinct candidate windows of a file in order of their hash, with the rank of the first document that has each."""

    def __init__(self, windows: Windows, some: np.ndarray):
        self.windows, self.some = windows, some
        at = windows.at[some]
        whole = rolling_hashes(windows.hashes, windows.window, 1)
        check = rolling_hashes(windows.hashes, windows.window, 2) >> np.uint64(32)
        h, c = (whole[at], check[at]) if len(at) else (np.zeros(0, np.uint64),) * 2
        order = np.lexsort((c, h))
        new = np.ones(len(at), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])
        heads = np.flatnonzero(new)
        self.which = np.empty(len(at), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.hash, self.check = h[order][heads], c[order][heads]
        self.least = np.minimum.reduceat(windows.rank[some][order], heads) if len(heads) else np.zeros(0, np.int64)


def _grouped(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All entries of ``data`` and the row of each."""
    parts = [np.frombuffer(x, np.uint64) for x in rows["data"]]
    return (np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


@dataclass(frozen=True)
class Run:
    """A sorted run: its rows (a hash bucket each), how many buckets it is cut into, and the bytes of text that it stands for."""

    rows: DataFrame
    buckets: int
    size: int


def merged_with(size: int, runs: list[int], growth: int = GROWTH) -> list[int]:
    """Which of the ``runs`` (sizes) a new run of ``size`` is merged with: from the smallest on, while one isn't over ``growth`` times what is merged so far."""
    out = []
    for i in sorted(range(len(runs)), key=lambda i: runs[i]):
        if runs[i] > growth * size:
            break
        size += runs[i]
        out.append(i)
    return out


def _finer(run: Run, buckets: int) -> DataFrame:
    """A run's rows cut into more buckets: twice as many, four times, and so on. A bucket is a range of hashes, so its finer ones are slices of it."""
    if run.buckets == buckets:
        return run.rows

    def cut(frames):
        for rows in frames:
            out = []
            for r in rows.itertuples():
                entries, owners = np.frombuffer(r.data, np.uint64), np.frombuffer(r.owners, np.uint32)
                out += [(r.kind, b, None, entries[part].tobytes(), owners[part].tobytes(), r.names) for b, part in bucket_cells(entries, buckets)]
            yield pd.DataFrame(out, columns=["kind", "bucket", "batch", "data", "owners", "names"])

    return run.rows.mapInPandas(cut, _RUN)


class FingerprintIndex:
    """Sorted immutable runs, one row a hash bucket each: fingerprints in order and the file that had each first.

    :meth:`ingest` merge-joins a new batch with every run and writes one run more; the same pass merges runs of about its size into it. A run on disk never changes.
    """

    def __init__(self, runs: list[Run] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None, growth: int = GROWTH):
        self.runs: list[Run] = list(runs or [])
        self.growth = growth
        self._keep = keep or (lambda df: stage(df, "fingerprint-run", partition_by="kind"))

    def ingest(self, new: DataFrame, size: int, buckets: int) -> DataFrame:
        """``new``: rows (bucket, batch, data) of ``size`` bytes of text in ``buckets`` buckets, no fewer than any run has; data are distinct sorted fingerprints of a file.

        Returns rows (batch, data): which of a file's fingerprints another file has too, for files of this batch and of earlier ones.
        """
        folded = merged_with(size, [r.size for r in self.runs], self.growth)

        def merge(fresh: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            entries, row = _grouped(fresh)
            names = fresh["batch"].tolist()
            order = np.argsort(entries, kind="stable")
            entries, row = entries[order], row[order]
            heads = np.flatnonzero(np.concatenate([[True], entries[1:] != entries[:-1]])) if len(entries) else np.zeros(0, np.int64)
            count = np.diff(np.append(heads, len(entries)))
            distinct, owner = entries[heads], row[heads]
            known = np.zeros(len(distinct), bool)
            out, merged = [], [(distinct, owner)]
            for r in old.itertuples():
                run, run_owner = np.frombuffer(r.data, np.uint64), np.frombuffer(r.owners, np.uint32)
                place = np.searchsorted(run, distinct)
                place[place == len(run)] = 0
                same = run[place] == distinct if len(run) else np.zeros(len(distinct), bool)
                known |= same
                for o in np.unique(run_owner[place[same]]) if same.any() else ():
                    out.append(("hit", None, r.names[o], distinct[same][run_owner[place[same]] == o].tobytes(), None, None))
                if r.fold:
                    merged.append((run, run_owner.astype(np.int64) + len(names)))
                    names = names + list(r.names)
            repeated = np.repeat((count > 1) | known, count)
            for i in np.unique(row[repeated]).tolist():
                out.append(("hit", None, names[i], entries[repeated & (row == i)].tobytes(), None, None))
            # What an older run has stays that run's: every fingerprint is in one run, with the file that had it first.
            merged[0] = (distinct[~known], owner[~known])
            entries, owner = (np.concatenate(x) for x in zip(*merged, strict=True))
            if len(entries):
                order = np.argsort(entries, kind="stable")
                bucket = int((fresh if len(fresh) else old)["bucket"].iloc[0])
                out.append(("run", bucket, None, entries[order].tobytes(), owner[order].astype(np.uint32).tobytes(), names))
            return pd.DataFrame(out, columns=["kind", "bucket", "batch", "data", "owners", "names"])

        old = new.sparkSession.createDataFrame([], f"{_RUN}, fold boolean")
        for i, run in enumerate(self.runs):
            old = old.unionByName(_finer(run, buckets).withColumn("fold", F.lit(i in folded)))
        done = self._keep(new.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInPandas(merge, _RUN))
        made = Run(done.where("kind = 'run'"), buckets, size + sum(self.runs[i].size for i in folded))
        self.runs = [r for i, r in enumerate(self.runs) if i not in folded] + [made]
        return done.where("kind = 'hit'").select("batch", "data")


def _tasks(files: DataFrame, each: int) -> int:
    """Tasks of about ``each`` files, and no fewer than there are cores."""
    return max(files.sparkSession.sparkContext.defaultParallelism, -(-files.count() // each))


def _fingerprints(files: DataFrame, folder: str, buckets: int, window: int, gram: int) -> DataFrame:
    """``(bucket, batch, data)``: the distinct sorted fingerprints of each file, by bucket."""

    def prints(batches):
        for rows in batches:
            for name in rows["batch"]:
                own, _ = Windows(TextBatch(folder, name), window, gram).fingerprints()
                yield pd.DataFrame([(b, name, own[part].tobytes()) for b, part in bucket_cells(own, buckets)], columns=["bucket", "batch", "data"])

    return files.select("batch").repartition(_tasks(files, 4), "batch").mapInPandas(prints, "bucket int, batch string, data binary")


def _judged(files: DataFrame, hits: DataFrame, folder: str, buckets: int, window: int, gram: int, others: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every document of ``files``, ``hits`` being all that ingests found. ``others``: files that may have windows first, too, but aren't judged."""

    def requests(files: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name in files["batch"]:
            w = Windows(TextBatch(folder, name), window, gram)
            c = w.candidates(hits["data"].tolist())
            for b, part in bucket_cells(c.hash, buckets):
                out.append((b, name, c.hash[part].tobytes(), c.check[part].astype(np.uint32).tobytes(), to_planes(w.order[c.least[part]])))
        return pd.DataFrame(out, columns=["bucket", "batch", "data", "check", "order"])

    def verdicts(rows: pd.DataFrame) -> pd.DataFrame:
        """One bit for each window that a file asked about: whether a document of another file has it and a smaller id."""
        h, row = _grouped(rows)
        c = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["check"]])
        o = np.concatenate([from_planes(x) for x in rows["order"]])
        order = np.lexsort((o, c, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])
        least = o[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        later = np.empty(len(h), bool)
        later[order] = o[order] > least
        edge = np.searchsorted(row, np.arange(len(rows) + 1))
        bits = [np.packbits(later[edge[i] : edge[i + 1]]).tobytes() for i in range(len(rows))]
        return pd.DataFrame({"batch": rows["batch"], "bucket": rows["bucket"], "data": bits})

    def cut(files: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        hits = answers.loc[answers["bucket"] < 0, "data"].tolist()
        bits = dict(answers.loc[answers["bucket"] >= 0, ["bucket", "data"]].itertuples(index=False))
        for name in files["batch"]:
            batch = TextBatch(folder, name)
            w = Windows(batch, window, gram)
            c = w.candidates(hits)
            later = np.zeros(len(c.hash), bool)
            for b, part in bucket_cells(c.hash, buckets):
                later[part] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=part.stop - part.start).astype(bool)
            gone = w.at[c.some[later[c.which] | (w.rank[c.some] > c.least[c.which])]]
            cover = np.bincount(gone, minlength=len(w.starts) + 1)[: len(w.starts) + 1].astype(np.int64)
            cover -= np.bincount(gone + window, minlength=len(w.starts) + 1)[: len(w.starts) + 1]
            kept = np.cumsum(cover)[: len(w.starts)] == 0
            text = batch.data.tobytes()
            for i, doc_id in enumerate(batch.ids):
                a, b = int(w.first[i]), int(w.first[i + 1])
                some = np.flatnonzero(kept[a:b]) + a
                words = [text[s:e] for s, e in zip(w.starts[some].tolist(), w.ends[some].tolist(), strict=True)]
                out.append((doc_id, b - a, b - a - len(some), b" ".join(words).decode("utf-8")))
        frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
        return frame.astype({"doc_id": "Int64"})

    # Tasks open their files again, so their number follows the files and not the few bytes that are shuffled.
    n = _tasks(files, 2)
    asking = files.select("batch") if others is None else files.select("batch").unionByName(others.select("batch"))
    hits = hits if others is None else hits.join(asking, "batch", "left_semi")
    files, asking, hits = files.select("batch").repartition(n, "batch"), asking.repartition(n, "batch"), hits.repartition(n, "batch")
    asked = asking.groupBy("batch").cogroup(hits.groupBy("batch")).applyInPandas(requests, "bucket int, batch string, data binary, check binary, order binary")
    answers = stage(asked.groupBy("bucket").applyInPandas(verdicts, "batch string, bucket int, data binary"), "window-verdicts")
    answers = answers.unionByName(hits.select("batch", F.lit(-1).alias("bucket"), "data"))
    answers = (answers if others is None else answers.join(files, "batch", "left_semi")).repartition(n, "batch")
    return files.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(cut, "doc_id long, n_words long, n_removed long, kept string")


class SubstringIndex:
    """Texts, runs of fingerprints and what they share, in the folder ``path``, which driver and executors see.

    :meth:`ingest` adds a batch of documents: it fingerprints the new texts only, merge-joins them with the runs, and compacts runs of their size. :meth:`deduplicated` judges all documents
    ingested so far, in whatever sessions and batches, or those of one ingest. The state is a table whose next version is published once an ingest is complete, so one that broke off has added nothing, and of two at a time
    one raises.
    """

    def __init__(self, spark: SparkSession, path: str, window: int = WINDOW, gram: int = GRAM, growth: int = GROWTH):
        self.spark, self.path, self.growth = spark, path.rstrip("/"), growth
        self._table = VersionedTable(spark, f"{self.path}/state")
        self._version = self._table.version()
        # Per ingest: its list of files and, for each of its batches, what was found; then the runs that are live.
        self._state: dict = {"window": window, "gram": gram, "buckets": 1, "bytes": 0, "ingests": [], "runs": []}
        if self._version:
            self._state = json.loads(self._table.read(self._version).first()["value"])

    @property
    def runs(self) -> list[dict]:
        return self._state["runs"]

    def _kept(self, df: DataFrame, name: str, **options) -> tuple[str, DataFrame]:
        path = f"{self.path}/{name}/part={uuid.uuid4().hex[:12]}"
        df.write.option("compression", "zstd").parquet(path, **options)
        return path, self.spark.read.schema(df.schema).parquet(path)

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        none = self.spark.createDataFrame([], schema)
        return reader.parquet(*paths).select(*none.columns) if paths else none

    def ingest(self, docs: DataFrame, parts: int = 1) -> None:
        """Add the documents (doc_id, text; more columns are ignored), as ``parts`` batches after one another."""
        _, files = write_batches(docs, folder=f"{self.path}/texts")
        listed, files = self._kept(files.withColumn("turn", F.pmod(F.xxhash64("batch"), F.lit(parts))), "files")
        sizes = {r["turn"]: r["bytes"] for r in files.groupBy("turn").agg(F.sum("bytes").alias("bytes")).collect()}
        state = json.loads(json.dumps(self._state))
        state["bytes"] += sum(sizes.values())
        # A power of two, so that older runs are cut finer at their own edges.
        state["buckets"] = buckets = max(state["buckets"], 1 << (buckets_for(state["bytes"]) - 1).bit_length())
        done: list[str] = []

        def keep(df: DataFrame) -> DataFrame:
            path, out = self._kept(df, "run", partitionBy="kind")
            done.append(path)
            return out

        index = FingerprintIndex([Run(self._read([r["path"]], _RUN).where("kind = 'run'"), r["buckets"], r["size"]) for r in state["runs"]], keep, self.growth)
        paths = {id(run): r["path"] for run, r in zip(index.runs, state["runs"], strict=True)}
        for i in sorted(sizes):
            index.ingest(_fingerprints(files.where(F.col("turn") == i), f"{self.path}/texts", buckets, state["window"], state["gram"]), sizes[i], buckets)
            paths[id(index.runs[-1])] = done[-1]
        state["ingests"].append({"files": listed, "found": done})
        state["runs"] = [{"path": paths[id(r)], "buckets": r.buckets, "size": r.size} for r in index.runs]
        self._version = self._table.write(self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1), base=self._version)
        self._state = state

    def deduplicated(self, ingest: int | None = None) -> DataFrame:
        """As :func:`dedup_substrings`, for all documents, or for those of the ingest of that number (from 0, -1 the last), judged against all ingested so far.

        Of other ingests, only files that share a fingerprint with the one asked for are opened.
        """
        kind = "batch string, docs long, bytes long"
        turns, every = self._state["ingests"], slice(None) if ingest is None else slice(ingest, ingest + 1 or None)
        hits = self._read([p for x in turns for p in x["found"]], _RUN).where("kind = 'hit'").select("batch", "data")
        files = self._read([x["files"] for x in turns[every]], kind)
        others = None
        if ingest is not None:
            # Later batches find what they share with this one, and it finds what it shares with earlier ones.
            near = self._read([p for x in turns[ingest % len(turns) :] for p in x["found"]], _RUN).where("kind = 'hit'").select("batch").distinct() if turns else hits.select("batch")
            others = near.join(files.select("batch"), "batch", "left_anti")
        return _judged(files, hits, f"{self.path}/texts", self._state["buckets"], self._state["window"], self._state["gram"], others)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, ingests: int = INGESTS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every row: its words, how many went, and the others joined by one space.

    A word goes if a window of ``window`` words covers it whose words also start, in that order, somewhere in a document of a smaller doc_id (null is larger
    than all). Windows are judged on the input. Rows of equal doc_id don't remove each other's words. Null, empty and blank texts have no words; more columns are ignored.
    """
    index = SubstringIndex(docs.sparkSession, f"{shared_dir(docs.sparkSession)}/substrings-{uuid.uuid4().hex[:12]}", window, gram)
    index.ingest(docs, ingests)
    return index.deduplicated()
