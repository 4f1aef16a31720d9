"""Collocations: phrases whose words stand together more often than chance has them.

Texts are split into pieces, and equal pieces become one row with a multiplicity. N-grams of pieces are counted by length, shortest first: one of n words is counted only if both parts of n - 1 words are frequent, which
a filter of fixed size tells without missing any. Tasks send each n-gram once per batch with its weight; DuckDB adds up each hash bucket, and spills what does not fit its memory. The parts of a phrase are looked up by
joins on the part, so no table of counts is copied to every task.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.bitfilter import broadcast_filter
from tarnlake.llm.bitfilter import known as is_known
from tarnlake.llm.common import lower_ascii, mix, rolling_hashes, scan_words, stage, text_buffer, word_hashes

#: Least count of a phrase, most words of one, phrases returned per language, and the percentage of its count that a longer phrase must have to stand for it.
LEAST, LONGEST, TOP, STANDS_FOR = 30, 4, 2_000, 80
SCALE = 2_000_000
NO_LANG = "und"
#: Bits of the filter. Where more n-grams are frequent than it can tell apart, more are counted that turn out rare; no result changes.
FILTER_BITS = 1 << 26
#: Pieces are taken together up to so many bytes; memory of one DuckDB.
BATCH_BYTES, MEMORY = 4 << 20, "256MB"
_COUNTS = "lang string, phrase string, m long"


def pieces(docs: DataFrame) -> DataFrame:
    """``(lang, piece, m)``: each distinct piece of a language with how often it occurs; its words are joined by one space. Pieces without words are left out."""
    text = F.translate(lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))), "\t", " ")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.explode(F.split(text, r"[.,;:!?\x0A-\x0D]", -1)).alias("piece"))
    piece = F.trim("piece")
    piece = F.when(F.contains(piece, F.lit("  ")), F.regexp_replace(piece, " {2,}", " ")).otherwise(piece)
    return rows.select("lang", piece.alias("piece")).where("piece <> ''").groupBy("lang", "piece").agg(F.count(F.lit(1)).alias("m"))


def _gram_hashes(words: np.ndarray, n: int, langs) -> np.ndarray:
    """Hash of every n consecutive words and the language, given as a hash per n-gram."""
    return mix(rolling_hashes(words, n) ^ langs) if len(words) >= n else words[:0]


def _cell_hashes(column) -> np.ndarray:
    data, offsets = text_buffer(column)
    return word_hashes(data, offsets[:-1], offsets[1:], 1)


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The byte ranges as an Arrow string array."""
    import pyarrow as pa

    length = ends - starts
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    at = np.arange(int(offsets[-1])) - np.repeat(offsets[:-1] - starts, length)
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))).cast(pa.string())


def _weighted_grams(n: int, known):
    """n-grams of pieces, those of a batch added up. ``known``: the broadcast filter of frequent (n - 1)-grams, if n > 1."""

    def grams(langs, texts, m):
        import pyarrow as pa

        data, offsets = text_buffer(texts)
        starts, ends, first = scan_words(data, offsets)
        size = np.diff(first)
        owner = np.repeat(np.arange(len(size)), size)
        count = max(0, len(starts) - n + 1)
        wanted = owner[:count] == owner[n - 1 :] if count else np.zeros(0, bool)
        if known is not None and count:
            own = _cell_hashes(langs)[owner]
            part = _gram_hashes(word_hashes(data, starts, ends), n - 1, own[: len(starts) - n + 2])
            frequent = is_known(part, np.frombuffer(known.value, np.uint64))
            wanted &= frequent[:-1] & frequent[1:]
        at = np.flatnonzero(wanted)
        table = pa.table({"lang": langs.take(pa.array(owner[at])), "phrase": _slices(data, starts[at], ends[at + n - 1]), "m": m.take(pa.array(owner[at]))})
        return table.group_by(["lang", "phrase"]).aggregate([("m", "sum")]).rename_columns(["lang", "phrase", "m"]) if len(at) else table

    def run(batches):
        import pyarrow as pa

        def some(held):
            table = pa.Table.from_batches(held).combine_chunks()
            return grams(*[table.column(i).combine_chunks() for i in range(3)]).to_batches(max_chunksize=1 << 16)

        held, size = [], 0
        for batch in batches:
            ends, done = text_buffer(batch.column(1))[1], 0
            while done < batch.num_rows:
                upto = max(done + 1, int(np.searchsorted(ends, ends[done] + BATCH_BYTES - size, side="right")) - 1)
                held.append(batch.slice(done, upto - done))
                size += int(ends[upto] - ends[done])
                done = upto
                if size >= BATCH_BYTES or done < batch.num_rows:
                    yield from some(held)
                    held, size = [], 0
        if held:
            yield from some(held)

    return run


def _scratch() -> str | None:
    """Where Spark lets this task spill; DuckDB's files there end with the task."""
    return next((d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)), None)


def _added_up(least: int):
    """A hash bucket's n-grams of at least so many occurrences, added up by DuckDB as they stream in."""

    def run(batches):
        import duckdb
        import pyarrow as pa

        first = next(batches, None)
        if first is None:
            return

        def every():
            yield first
            yield from batches

        with tempfile.TemporaryDirectory(dir=_scratch(), prefix="phrases-") as folder:
            con = duckdb.connect(config={"memory_limit": MEMORY, "temp_directory": folder, "threads": 1, "preserve_insertion_order": False})
            grams = pa.RecordBatchReader.from_batches(first.schema, every())
            con.register("grams", grams)
            yield from con.sql(f"SELECT lang, phrase, CAST(sum(m) AS BIGINT) AS m FROM grams GROUP BY lang, phrase HAVING sum(m) >= {int(least)}").to_arrow_reader(1 << 16)
            con.close()

    return run


def _filter_of(counts: DataFrame, n: int):
    """The frequent n-grams as a broadcast filter."""

    def hashes(batch):
        data, offsets = text_buffer(batch.column(1))
        starts, ends, _ = scan_words(data, offsets)
        return _gram_hashes(word_hashes(data, starts, ends), n, np.repeat(_cell_hashes(batch.column(0)), n)[: max(0, len(starts) - n + 1)])[::n]

    return broadcast_filter(counts.select("lang", "phrase"), hashes, FILTER_BITS)


def frequent_phrases(distinct: DataFrame, least: int = LEAST, longest: int = LONGEST) -> list[DataFrame]:
    """For 1 to ``longest`` words, ``(lang, phrase, m)``: every phrase that occurs at least so often in the pieces ``(lang, piece, m)``, overlaps included."""
    out: list[DataFrame] = []
    known = None
    for n in range(1, longest + 1):
        grams = distinct.select("lang", "piece", "m").mapInArrow(_weighted_grams(n, known), _COUNTS).repartition("lang", "phrase")
        out.append(stage(grams.mapInArrow(_added_up(least), _COUNTS), f"phrases-{n}"))
        known = _filter_of(out[-1], n) if n < longest else None
    return out


def _words(phrase: Column, start, n) -> Column:
    return F.array_join(F.slice(phrase, start, n), " ")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, stands_for: int = STANDS_FOR) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` of each language's ``top`` phrases of 2 to ``longest`` words, from the columns ``lang`` (null: ``und``) and ``text`` (null: empty).

    Words are runs of characters but space and tab, A-Z in lower case, within pieces that ``[.,;:!?]`` and line ends part; repeated rows count as often as they occur. A phrase with ``a`` >= ``least`` occurrences is
    scored at each of its cuts, floor(2,000,000 a / (l + r)) for the counts l and r of the two parts, and has its least score, at ties that of the first cut. One that stands inside a longer phrase with at least
    ``stands_for`` per cent of its count goes. ``n``: words of the language. Order: score and a descending, phrase ascending by bytes.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    distinct = stage(pieces(docs), "phrase-pieces")
    sizes = distinct.groupBy("lang").agg(F.sum(F.col("m") * (F.length("piece") - F.length(F.replace("piece", F.lit(" "), F.lit(""))) + 1)).alias("n"))
    counts = frequent_phrases(distinct, least, longest)
    found = counts[1]
    for x in counts[2:]:
        found = found.unionByName(x)
    every = counts[0].unionByName(found)
    found = found.select("lang", "phrase", F.col("m").alias("a"), F.split("phrase", " ").alias("w"))

    cuts = found.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _words(F.col("w"), F.lit(1), F.col("k")).alias("left"), _words(F.col("w"), F.col("k") + 1, F.size("w")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(every.select("lang", F.col("phrase").alias(side), F.col("m").alias(name)), ["lang", side])
    score = F.expr(f"CAST(a AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(7, 0)) div CAST(l + r AS DECIMAL(20, 0))")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))

    inner = found.where(F.size("w") > 2).select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("at")).select("lang", _words(F.col("w"), F.col("at"), F.col("k")).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < stands_for * F.col("a")))

    rows = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
