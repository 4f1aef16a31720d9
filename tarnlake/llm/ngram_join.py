"""Jaccard self-join of shingle sets by grouped prefixes.

Equal sets are one. A set is a candidate only if it shares enough of its least hashes with others; what remains orders its shingles by rarity. Shingles that no other candidate has meet nothing, so a prefix is what the
others leave of it. Sets of one size with the same prefix, and as many shingles of their own, form a group, and groups meet in place of sets: size, position and parity maps bound which pairs can be similar. Members are
compared within groups and between them until every pair either is in one component or has been ruled out; comparing stops where components already tell, so copies of a text don't meet as all pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.bitfilter import bits_for, broadcast_filter, known
from tarnlake.llm.common import scratch, shingle_sets, stage, text_buffer, text_parts
from tarnlake.llm.components import components

#: Words of a shingle, and the least similarity in per cent.
SHINGLE, PERCENT = 3, 90
#: Sets of a shingle's list that meet all others in the first round over members, and how many times as many do in each next one, for what isn't linked by then.
LEADERS, MORE_LEADERS = 1, 8
#: Words of 64 bits of a set's parity map.
MAP_WORDS = 8
#: Names of sets that a task remembers to have sent. Others may be sent again, and are dropped later.
SENT_NAMES = 200_000
_PART_BYTES = 1 << 20


def _least(n, percent: int):
    """Shingles that a set of ``n`` shares with any similar set, at least. No similar set is smaller than this. ``n``: a number, an array or a column."""
    return F.floor((n * percent + 99) / 100).cast("long") if isinstance(n, Column) else (n * percent + 99) // 100


def _ahead(n, percent: int):
    """Shared shingles that a candidate needs in its prefix by hash: the more, the fewer texts with one passage in common are candidates, and the longer are prefixes."""
    if isinstance(n, Column):
        return F.least(1 + F.floor(n / 10), _least(n, percent))
    return min(1 + n // 10, _least(n, percent))


def _sets(column, shingle: int):
    """The sorted shingle hashes of each text, part by part."""
    data, offsets = text_buffer(column)
    for a, b in text_parts(offsets, _PART_BYTES):
        yield from shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle)


def _name(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a set; none for the empty set."""
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def named(sets, percent: int) -> list:
    """Arrow columns of sets of shingle hashes: names (null: empty), sizes, and the least hashes, in which a similar set shares enough."""
    import pyarrow as pa

    names, sizes, heads = [], [], []
    for s in sets:
        n = len(s)
        names.append(_name(s))
        sizes.append(n)
        heads.append(s[: n - _least(n, percent) + _ahead(n, percent)].view(np.int64))
    return [pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), pa.array(heads, pa.list_(pa.int64()))]


def named_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, sid, n, head)`` of every row: name, size and least hashes of its set, as in :func:`named`."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *named(_sets(batch.column(1), shingle), percent)], names=["doc_id", "sid", "n", "head"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, sid binary, n long, head array<long>")


def _candidates(distinct: DataFrame, percent: int) -> DataFrame:
    """The rows (rid, sid, n) of ``distinct`` that may have a similar set at all.

    In one order of hashes, the first k shared ones of two sets are among the first n - (least overlap) + k of each. A set of which fewer hashes in that prefix are in another's, too, has no partner.
    """
    entries = distinct.select("rid", F.explode("head").alias("t"))
    shared = entries.groupBy("t").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("t")
    hits = entries.join(shared, "t").groupBy("rid").agg(F.count(F.lit(1)).alias("hits"))
    return distinct.select("rid", "sid", "n").join(hits, "rid").where(F.col("hits") >= _ahead(_least(F.col("n"), percent), percent)).drop("hits")


def _whole_sets(docs: DataFrame, chosen: DataFrame, shingle: int) -> DataFrame:
    """``(rid, n, h)``: the whole sets of the candidates ``chosen`` (rid, sid, n). Texts are read again; only sets that a filter of the chosen names lets pass leave their task, mostly once each."""

    def hashes(batch):
        return np.frombuffer(b"".join(x[:8] for x in batch.column(0).to_pylist()), np.uint64)

    wanted = broadcast_filter(chosen.select("sid"), hashes, bits_for(chosen.count()))

    def run(batches):
        import pyarrow as pa

        words, sent = np.frombuffer(wanted.value, np.uint64), set()
        for batch in batches:
            names, sets = [], []
            if len(sent) > SENT_NAMES:
                sent.clear()
            for s in _sets(batch.column(0), shingle):
                if len(s) and (name := _name(s)) not in sent and known(np.frombuffer(name[:8], np.uint64), words)[0]:
                    names.append(name)
                    sets.append(s.view(np.int64))
                    sent.add(name)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["sid", "h"])

    sent = docs.select(F.col("text").cast("string")).mapInArrow(run, "sid binary, h array<long>").dropDuplicates(["sid"])
    return stage(chosen.join(sent, "sid").select("rid", "n", "h"), "ngram-sets")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``(rid, n, own, shared, prefix)``: shingles that no other candidate has, and the prefix of the others, rarest first, where a similar set must share one."""
    tokens = sets.select("rid", "n", F.explode("h").alias("t"))
    counts = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    ranked = tokens.join(counts, "t").groupBy("rid", "n").agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("r"))
    take = (F.size("r") - _least(F.col("n"), percent) + 1).cast("int")
    return ranked.where(take > 0).select("rid", "n", (F.col("n") - F.size("r")).alias("own"), F.size("r").alias("shared"), F.transform(F.slice("r", F.lit(1), take), lambda x: x["t"]).alias("prefix"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose whole sets are similar enough."""
    one, two = (sets.select(F.col("rid").alias(x), F.col("n").alias(f"n_{x}"), F.col("h").alias(f"h_{x}")) for x in "ab")
    met = pairs.join(one, "a").join(two, "b").withColumn("both", F.size(F.array_intersect("h_a", "h_b")))
    return stage(met.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b"), "ngram-links")


def _parity_maps(sets: DataFrame) -> DataFrame:
    """``(rid, map)``: for each bit, whether an odd number of a set's hashes fall on it. Two sets differ in at least as many shingles as their maps differ in bits."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h = batch.column(1)
            edges, values = h.offsets.to_numpy(), h.values.to_numpy().view(np.uint64)
            bits = [np.packbits(np.bincount(values[a:b] % np.uint64(64 * MAP_WORDS), minlength=64 * MAP_WORDS) & 1, bitorder="little").view(np.int64) for a, b in zip(edges, edges[1:], strict=False)]
            words = np.array(bits, np.int64).reshape(-1, MAP_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(words[:, k]) for k in range(MAP_WORDS)]], names=["rid", *(f"b{k}" for k in range(MAP_WORDS))])

    found = sets.select("rid", "h").mapInArrow(run, "rid long" + "".join(f", b{k} long" for k in range(MAP_WORDS)))
    return found.select("rid", F.struct(*(f"b{k}" for k in range(MAP_WORDS))).alias("map"))


def _near(one: str, two: str, n: Column, percent: int) -> Column:
    """Whether two parity maps allow sets of together ``n`` shingles to be similar."""
    apart = sum((F.bit_count(F.col(f"{one}.b{k}").bitwiseXOR(F.col(f"{two}.b{k}"))) for k in range(MAP_WORDS)), F.lit(0))
    return (100 + percent) * apart <= (100 - percent) * n


def _fits(percent: int) -> Column:
    """Whether the leader ``x`` and the entry (n, cap, map) may be similar: each is within the other's bound, neither is too small, and their parity maps don't differ too much."""
    sizes = (F.col("x.n") <= F.col("cap")) & (F.col("n") <= F.col("x.cap")) & (F.least("x.n", "n") >= _least(F.greatest("x.n", "n"), percent))
    return sizes & _near("x.map", "map", F.col("x.n") + F.col("n"), percent)


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("x.rid", "rid").alias("a"), F.greatest("x.rid", "rid").alias("b")).distinct()


def set_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(a, b)``: links between the distinct ``sets`` (rid, n, h) that join them into the components that all pairs of at least that similarity would, if not all of them."""
    prefixes = stage(_prefixes(sets, percent).join(_parity_maps(sets), "rid"), "ngram-prefixes")
    by = ["n", "shared", "prefix_id"]
    keyed = prefixes.withColumn("prefix_id", F.md5(F.array_join(F.col("prefix").cast("array<string>"), " ")))
    groups = stage(keyed.groupBy(*by).agg(F.min("rid").alias("g"), F.count(F.lit(1)).alias("members")), "ngram-groups")
    members = stage(keyed.select("rid", "map", *by).join(groups, by).select("rid", "n", "map", "g", "members"), "ngram-members")

    # Where two similar sets first share a shingle, each has as many left as both must share: from there on a set meets sets of up to ``cap`` shingles only. One whose cap is below its own size is idle: it meets no
    # other idle one, as one of two is no larger than the other.
    heads = prefixes.join(groups.select(F.col("g").alias("rid")), "rid", "left_semi")
    entries = heads.select("rid", "n", "own", "shared", "map", F.posexplode("prefix").alias("at", "t"))
    cap = F.floor((F.col("shared") - F.col("at")) * F.lit((100 + percent) / percent) - F.col("n") + 1e-6)
    entries = stage(entries.select("t", "rid", "n", "own", cap.alias("cap"), (cap < F.col("n")).alias("idle"), "map"), "ngram-entries")

    # Groups meet: each shingle's leader, of the fewest shingles of its own and so closest to most edited copies, and all other groups of its list. Members of a group meet its first.
    lead = entries.groupBy("t").agg(F.min(F.struct("idle", "own", "n", "cap", "rid", "map")).alias("x"), F.count(F.lit(1)).alias("c")).where("c > 1 and not x.idle")
    between = _pairs(entries.join(lead, "t").where((F.col("rid") != F.col("x.rid")) & _fits(percent)))
    reps = members.where("members > 1 and rid = g").select("g", F.col("map").alias("of_g"))
    within = members.where("members > 1 and rid <> g").join(reps, "g").where(_near("map", "of_g", 2 * F.col("n"), percent)).select(F.col("g").alias("a"), F.col("rid").alias("b"))
    found = _verified(between.unionByName(within), sets, percent)

    # Members of the groups of a list that isn't one component yet.
    named_by = components(found).withColumnRenamed("v", "rid")
    labels = stage(members.join(named_by, "rid", "left").withColumn("label", F.coalesce("label", "rid")), "ngram-labels")
    named = labels.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = entries.join(named, entries["rid"] == named["g"]).groupBy("t").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("idle").alias("idle"), F.max("cap").alias("cap"), F.min("n").alias("n"))
    mixed = mixed.where("low <> high and not idle").select("t")
    lists = entries.join(mixed, "t").withColumnRenamed("rid", "g").drop("map").join(labels.select("g", "rid", "map"), "g").select("t", "rid", "n", "own", "cap", "idle", "map", F.lit(False).alias("met"))
    lists, leaders = stage(lists, "ngram-lists"), LEADERS
    while True:
        lists = _open_lists(lists, named_by)
        if lists.isEmpty():
            return found
        order = Window.partitionBy("t").orderBy(F.col("first"), F.desc("size"), "idle", "own", "n", "rid")
        first = Window.partitionBy("t", "label").orderBy("idle", "own", "n", "rid")
        lead = lists.where("not met and label <> largest").withColumn("first", F.row_number().over(first)).withColumn("place", F.row_number().over(order)).where(F.col("place") <= leaders)
        lead = stage(lead.select("t", F.struct("n", "cap", "rid", "label", "map").alias("x")), "ngram-leaders")
        met = lists.join(lead, "t").where(~F.col("met") & (F.col("label") != F.col("x.label")) & _fits(percent))
        new = _verified(_pairs(met), sets, percent)
        if not new.isEmpty():
            found = found.unionByName(new)
            named_by = components(found).withColumnRenamed("v", "rid")
        done = lead.select("t", F.col("x.rid").alias("rid"), F.lit(True).alias("now"))
        lists = stage(lists.join(done, ["t", "rid"], "left").select("t", "rid", "n", "own", "cap", "idle", "map", (F.col("met") | F.col("now").isNotNull()).alias("met")), "ngram-lists")
        leaders *= MORE_LEADERS


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries with their component, its ``size`` in the list and the list's ``largest``, of lists in which a set outside the largest component hasn't met the others yet."""
    named = stage(lists.join(labels, "rid", "left").withColumn("label", F.coalesce("label", "rid")), "ngram-lists")
    sizes = stage(named.groupBy("t", "label").agg(F.count(F.lit(1)).alias("size"), F.min("met").alias("all_met")), "ngram-sizes")
    lists_of = sizes.groupBy("t").agg(F.max(F.struct("size", "label")).alias("top")).select("t", F.col("top.label").alias("largest"))
    left = sizes.join(lists_of, "t").where("label <> largest").groupBy("t", "largest").agg(F.min("all_met").alias("done")).where("not done").select("t", "largest")
    return stage(named.join(left, "t").join(sizes.select("t", "label", "size"), ["t", "label"]), "ngram-lists")


def similar_sets(docs: DataFrame, named: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The distinct sets ``(rid, sid, n)`` of ``named`` (sid, n, head, ...), made of the texts of ``docs``, and the links ``(a, b)`` between their rids, as in :func:`set_links`."""
    with scratch(docs.sparkSession) as keep:
        one = named.where("sid is not null").select("sid", "n", "head").dropDuplicates(["sid"])
        distinct = stage(one.withColumn("rid", F.monotonically_increasing_id()), "ngram-distinct")
        chosen = stage(_candidates(distinct, percent), "ngram-candidates")
        found = keep(set_links(_whole_sets(docs, chosen, shingle), percent), "ngram-links")
        return keep(distinct.select("rid", "sid", "n"), "ngram-distinct"), found


def join_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row.

    A document's set are the distinct hashes (64 bits) of its shingles of ``shingle`` words, A-Z in lower case; a shorter text is one shingle. Two documents link when 100 times what both share is at least ``percent``
    times what either has. ``component_id``: the smallest doc_id that links lead to, its own included. Null, empty and blank texts have 0 shingles, link with nothing and keep their own doc_id. Repeated rows get equal
    results; rows with a null doc_id take part, and a component of such rows alone has a null id. More columns are ignored.
    """
    named = stage(named_sets(docs, shingle, percent), "ngram-documents")
    distinct, found = similar_sets(docs, named, shingle, percent)
    labels = components(found).withColumnRenamed("v", "rid")
    least = named.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    sets = distinct.select("sid", "rid").join(labels, "rid", "left").select("sid", F.coalesce("label", "rid").alias("label")).join(least, "sid")
    sets = stage(sets, "ngram-components")
    ids = sets.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = sets.join(ids, "label").select("sid", "component_id")
    out = named.select("doc_id", "sid", F.col("n").alias("n_shingles")).join(of_set, "sid", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
