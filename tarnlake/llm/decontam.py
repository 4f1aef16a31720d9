"""Benchmark decontamination by a prefix-filtered set join. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import free_name, lower_ascii, others, row_key, scratch, stage

WINDOW = 13
#: Rarest words of a window that must all be in place before its words are compared.
PREFIX = 2
#: Words of a document that one row holds. A longer document is several rows, so no row, list or set grows with a document.
BLOCK_WORDS = 4_096
#: Word tables up to this many bytes are broadcast; beyond it the same joins shuffle.
BROADCAST_BYTES = 32 << 20
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def content_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BETWEEN, -1), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it and wherever the optimizer moves it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sized(table: DataFrame) -> DataFrame:
    """``table``, marked for broadcast if its measured size is within the bound."""
    size = table.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def item_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(wid, words)`` and ``(wid, item)``: each distinct window of ``window`` consecutive words of (item_id, text), or of a whole shorter item, under a number, and the ids it is in, null left out."""
    words = items.select(F.col("item_id").cast("string").alias("item"), content_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = words.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), F.least(F.lit(window), F.size("w"))).alias("words"))
    cut = stage(cut.distinct(), "item-cuts")
    windows = stage(cut.select("words").distinct().select(F.monotonically_increasing_id().alias("wid"), "words"), "item-windows")
    return windows, stage(cut.where("item is not null").join(windows, "words").select("wid", "item"), "window-items")


def word_blocks(docs: DataFrame, window: int = WINDOW, block: int = BLOCK_WORDS) -> DataFrame:
    """``(key, n, base, lead, own, w)``: documents of ``n`` words in blocks of ``own`` words from word ``base`` on.

    ``w`` has up to ``window`` - 1 words more on either side, ``lead`` of them before, so every window that touches a block's own words is whole in its row.
    """
    margin = window - 1

    def cut(ws: Column) -> Column:
        def one(s: Column) -> Column:
            lead = F.least(s, F.lit(margin))
            own = F.least(F.lit(block), F.size(ws) - s)
            return F.struct(F.size(ws).alias("n"), s.alias("base"), lead.alias("lead"), own.alias("own"), F.slice(ws, s - lead + 1, lead + block + margin).alias("w"))

        return F.when(F.size(ws) > 0, F.transform(F.sequence(F.lit(0), F.size(ws) - 1, F.lit(block)), one))

    return docs.select(row_key("doc_id", "text").alias("key"), F.explode(_let(content_words(F.col("text")), cut)).alias("b")).select("key", "b.*")


def _candidates(blocks: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """``(key, base, found)``: where in a block a window may stand, each place once, as place * (``window`` + 1) + length.

    A window stands in a document only if its PREFIX rarest words do, each at its distance from the window's start. Windows with one prefix word differ in how far into them it is and in
    their length only, so a word of a document proposes a few places, however many windows or items have it; a place that not enough words propose has no window.
    """
    vocabulary = windows.select(F.explode("words").alias("w")).distinct()
    own = blocks.select(F.explode(F.slice("w", F.col("lead") + 1, F.col("own"))).alias("w"))
    counts = stage(own.join(_sized(vocabulary), "w").groupBy("w").agg(F.count(F.lit(1)).alias("rows")), "item-words")
    placed = windows.select("words", F.size("words").alias("len"), F.posexplode("words").alias("off", "w")).join(counts, "w")
    # A window with a word that no document has is in none of them.
    order = F.slice(F.array_sort(F.collect_list(F.struct("rows", "w", "off"))), 1, PREFIX)
    rarest = placed.groupBy("words").agg(F.count(F.lit(1)).alias("known"), order.alias("p"), F.first("len").alias("len")).where(F.col("known") == F.col("len"))
    prefix = rarest.select("len", F.explode("p").alias("p")).groupBy(F.col("p.w").alias("w")).agg(F.collect_set(F.struct(F.col("p.off").alias("off"), "len")).alias("spots"))
    spread = blocks.select("key", "base", F.size("w").alias("n"), F.posexplode("w").alias("pos", "w"))
    met = spread.join(_sized(stage(prefix, "item-prefixes")), "w").select("key", "base", "n", "pos", F.explode("spots").alias("s"))
    at, size = F.col("pos") - F.col("s.off"), F.col("s.len")
    fits = met.where((at >= 0) & (at + size <= F.col("n"))).groupBy("key", "base", (at * (window + 1) + size).alias("place")).agg(F.count(F.lit(1)).alias("words"))
    enough = fits.where(F.col("words") >= F.least(F.lit(PREFIX), F.col("place") % (window + 1)))
    return stage(enough.groupBy("key", "base").agg(F.collect_list("place").alias("found")), "item-places")


def _occurrences(blocks: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """``(key, base, lead, own, at, size, wid)`` of every window that stands in a block: the words at each candidate place are compared with the windows."""
    near = blocks.select("key", "base", "lead", "own", "w").join(_sized(_candidates(blocks, windows, window)), ["key", "base"])
    places = F.transform("found", lambda x: F.struct(F.floor(x / (window + 1)).cast("int").alias("at"), F.slice("w", F.floor(x / (window + 1)).cast("int") + 1, x % (window + 1)).alias("words")))
    there = near.select("key", "base", "lead", "own", F.explode(places).alias("x")).select("key", "base", "lead", "own", "x.at", "x.words")
    return there.join(_sized(windows), "words").select("key", "base", "lead", "own", "at", F.size("words").alias("size"), "wid")


def mark_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    A word is hit if it is inside any occurrence of an item window; a document is contaminated if words are hit and they are a twentieth of
    its words or more. Null text has no words. Rows of ``items`` with null text, or no word, have no window; a null item_id counts in hits, not among the ids. Repeated
    rows get equal results. Other columns pass through, but for any of these five names.

    Documents are cut into blocks of words once. The rarest words of windows propose places in blocks; there the words are compared with the windows, and only true occurrences
    are gathered.
    """
    key, n_words, n_hit, ids = (free_name(docs, x) for x in ("_key", "_words", "_hit", "_ids"))
    with scratch(docs.sparkSession) as keep:
        windows, ids_of = item_windows(items, window)
        blocks = stage(word_blocks(docs, window, block), "word-blocks")
        hits = stage(_occurrences(blocks, windows, window), "window-hits")
        covered = F.filter(F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("size") - 1)))), lambda i: (i >= F.col("lead")) & (i < F.col("lead") + F.col("own")))
        by_block = hits.groupBy("key", "base", "lead", "own").agg(F.size(covered).alias("hit"))
        named = hits.select("key", "wid").distinct().join(_sized(ids_of), "wid").select("key", "item").distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("ids"))
        none = F.lit(None).cast("array<string>")
        parts = blocks.where("base = 0").select("key", "n", F.lit(0).alias("hit"), none.alias("ids"))
        parts = parts.unionByName(by_block.select("key", F.lit(0).alias("n"), "hit", none.alias("ids"))).unionByName(named.select("key", F.lit(0).alias("n"), F.lit(0).alias("hit"), "ids"))
        found = keep(parts.groupBy(F.col("key").alias(key)).agg(F.max("n").cast("long").alias(n_words), F.sum("hit").alias(n_hit), F.first("ids", True).alias(ids)), "contamination")
    out = docs.withColumn(key, row_key("doc_id", "text")).join(found, key, "left")
    words, hit, ids = F.coalesce(n_words, F.lit(0).cast("long")), F.coalesce(n_hit, F.lit(0).cast("long")), F.coalesce(ids, F.array().cast("array<string>"))
    return out.select(
        *[F.col(f"`{c}`") for c in others(docs, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")],
        words.alias("n_words"),
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (hit * 20 >= words)).alias("contaminated"),
    )
