"""SimHash near-duplicates: fingerprints linked through BK-trees, then joined into components.

Two rules of what is near. :func:`near_duplicates` links fingerprints of three-word shingles that differ in two bits or fewer. Texts that share four fifths of their five-word shingles differ in up to 20
bits, so :func:`drop_near_duplicates` can link those too, exactly, by the join of shingle sets.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm import ngram_join
from tarnlake.llm.common import fold_case, free_name, row_key, scan_words, scratch, shingle_sets, stage, text_buffer, text_parts
from tarnlake.llm.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
#: The verified rule: words of a shingle and least Jaccard similarity in per cent.
SIMILAR_SHINGLE, SIMILAR_PERCENT = 5, 80
#: Fingerprints of one BK-tree. Larger groups are cut into shards of about this many, and every shard's tree meets every part of its group.
TREE_ROWS = 4_096
_BITS_AT_ONCE, _PART_BYTES = 1 << 16, 1 << 20


class BKTree:
    """Integers by Hamming distance: each child hangs under its distance to the parent."""

    def __init__(self, values):
        self.root: list | None = None
        for v in values:
            self.add(v)

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (value ^ node[0]).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """Members at ``radius`` bits or fewer. Follows only edges whose distance differs from this node's by ``radius`` at most."""
        out, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            member, children = open_nodes.pop()
            d = (value ^ member).bit_count()
            if d <= radius:
                out.append(member)
            if children:
                open_nodes += [children[e] for e in range(d - radius, d + radius + 1) if e in children]
        return out


def text_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every text, as unsigned integers. Bit 0 is the lowest."""
    from xxhash import xxh64_intdigest

    data = fold_case(data)
    starts, ends, first = scan_words(data, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    length = ends - starts
    begin = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int(begin[-1] + length[-1]), 0x20, np.uint8)
    word = np.repeat(np.arange(len(starts)), length)
    at = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
    joined[begin[word] + at] = data[starts[word] + at]
    del word, at
    text, stop = joined.tobytes(), begin + length
    n = np.diff(first)
    count = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    docs, done = np.flatnonzero(count), 0
    while done < len(docs):
        upto = done + max(1, int(np.searchsorted(np.cumsum(count[docs[done:]]), _BITS_AT_ONCE, side="right")))
        some = docs[done:upto]
        size = count[some]
        edge = np.cumsum(size) - size
        head = np.repeat(first[some] - edge, size) + np.arange(int(size.sum()))
        tail = head + np.repeat(np.minimum(n[some], shingle), size) - 1
        h = np.array([xxh64_intdigest(text[a:b], SEED) for a, b in zip(begin[head].tolist(), stop[tail].tolist(), strict=True)], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for i, (e, s) in enumerate(zip(edge.tolist(), size.tolist(), strict=True)):
            ones = bits[e : e + s].sum(axis=0, dtype=np.int32)
            out[some[i]] = np.packbits(2 * ones > s, bitorder="little").view("<u8")[0]
        done = upto
    return out


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``fp``, the fingerprint of ``text`` as a signed long (null text: 0)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = text_buffer(batch.column(batch.num_columns - 1))
            parts = [text_fingerprints(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle) for a, b in text_parts(offsets, _PART_BYTES)]
            fp = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp)], names=[*keep, "fp"])

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string")).mapInArrow(run, f"{fields}fp long")


def _masks(bits: list[int], radius: int) -> list[int]:
    """Of radius + 2 runs of ``bits``, every two as a mask (signed long): numbers that differ in ``radius`` of these bits or fewer agree under one of them."""
    n = radius + 2
    runs = [sum(1 << b for b in bits[len(bits) * i // n : len(bits) * (i + 1) // n]) for i in range(n)]
    return [m - (m >> 63 << 64) for m in dict.fromkeys(a | b for a, b in combinations(runs, 2))]


def _keyed(prints: DataFrame, masks: Column) -> DataFrame:
    return prints.select("fp", F.explode(masks).alias("mask")).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))


def _linked(radius: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            left, right = [], []
            for nodes, probes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mask = (1 << 64) - 1
                tree = BKTree(x & mask for x in nodes)
                root = {x & mask: x & mask for x in [*nodes, *(probes or ())]}

                def find(x, root=root):
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                for p in (x & mask for x in (nodes if probes is None else probes)):
                    for m in tree.within(p, radius):
                        a, b = find(p), find(m)
                        root[max(a, b)] = min(a, b)
                for x in root:
                    if (r := find(x)) != x:
                        left.append(x - (x >> 63 << 64))
                        right.append(r - (r >> 63 << 64))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _tree_rows(distinct: DataFrame, radius: int, tree_rows: int) -> DataFrame:
    """``(nodes, probes)`` for every BK-tree: what it holds, and what it is asked, null for its own nodes.

    Fingerprints within ``radius`` bits agree under one of the masks and meet there. A group of over ``tree_rows`` is taken apart by masks over the bits that its members don't agree in: for two
    bits, 16 bits are then free, so no group is larger than 65,536, whatever the data. Where that is still over ``tree_rows``, the group is cut into shards, and each shard's tree meets every part.
    Trees go to the tasks of their group: a broadcast would pass fingerprints of all documents through the driver.
    """
    every = _masks(list(range(64)), radius)
    count = lambda keyed: stage(keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-groups")
    keyed = _keyed(distinct, F.array(*map(F.lit, every)))
    sizes = count(keyed)
    members = keyed.join(sizes, ["mask", "value"])
    if not sizes.where(F.col("n") > tree_rows).isEmpty():
        # The key of a finer group has the bits of the group it comes from.
        finer = {m: [m | x for x in _masks([b for b in range(64) if not m >> b & 1], radius)] for m in every}
        large = members.where(F.col("n") > tree_rows).select("fp", F.create_map(*[x for m, f in finer.items() for x in (F.lit(m), F.array(*map(F.lit, f)))])[F.col("mask")].alias("masks"))
        again = _keyed(large, F.col("masks")).distinct()
        members = members.where(F.col("n") <= tree_rows).unionByName(again.join(count(again), ["mask", "value"]))
    members = members.withColumn("shards", F.ceil(F.col("n") / tree_rows)).withColumn("shard", F.pmod(F.xxhash64("fp"), "shards"))
    parts = stage(members.groupBy("mask", "value", "shards", "shard").agg(F.collect_list("fp").alias("nodes")), "simhash-trees")
    whole = parts.where("shards = 1 or size(nodes) > 1").select("nodes", F.lit(None).cast(parts.schema["nodes"].dataType).alias("probes"))
    large = parts.where("shards > 1")
    other = large.select("mask", "value", F.col("shard").alias("part"), F.col("nodes").alias("probes"))
    return whole.unionByName(large.join(other, ["mask", "value"]).where("part > shard").select("nodes", "probes"))


def links(distinct: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``(a, b)``: links that join the distinct fingerprints ``fp`` within ``radius`` bits into the same components as all such pairs would."""
    return _tree_rows(distinct.select("fp"), radius, tree_rows).mapInArrow(_linked(radius), "a long, b long").distinct()


def fingerprint_components(prints: DataFrame, order, radius: int = RADIUS, more: DataFrame | None = None) -> DataFrame:
    """``(fp, label, first)`` of every distinct ``fp``: its component, named by a fingerprint, and the smallest ``order`` in that component (null only if all are). ``more``: further links between fingerprints."""
    reps = stage(prints.groupBy("fp").agg(F.min(order).alias("first")), "fingerprints")
    edges = links(reps, radius)
    labels = components(edges if more is None else edges.union(more))
    named = reps.join(labels, reps["fp"] == labels["v"], "left").select("fp", F.coalesce("label", "fp").alias("label"), "first")
    named = stage(named, "fingerprints")
    joined = stage(named.where("label is not null").groupBy("label").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "components")
    return stage(named.join(joined, "label", "left").select("fp", "label", F.when(F.col("n").isNotNull(), F.col("least")).otherwise(F.col("first")).alias("first")), "components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row.

    Null, empty and blank texts have fingerprint zero and are linked like any other; repeated rows get equal results; rows with a null doc_id
    take part, and a component of such rows alone has a null id.
    """
    prints = stage(fingerprints(docs, ["doc_id"], shingle), "simhash")
    found = fingerprint_components(prints, F.col("doc_id"), radius)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def _marked(docs: DataFrame, key: str, shingle: int, percent: int) -> DataFrame:
    """``(doc_id, key, fp, sid, n, head)`` of every row: its fingerprint, and name, size and least hashes of its set of five-word shingles. Without words, the name is null."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for a, b in text_parts(offsets, _PART_BYTES):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                fp = pa.array(text_fingerprints(part, at, shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:2], fp, *ngram_join.named(shingle_sets(part, at, SIMILAR_SHINGLE), percent)], names=["doc_id", key, "fp", "sid", "n", "head"])

    fields = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, `{key}` binary"
    return docs.select("doc_id", key, F.col("text").cast("string")).mapInArrow(run, f"{fields}, fp long, sid binary, n long, head array<long>")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, percent: int | None = None) -> DataFrame:
    """The rows of ``docs`` with one of each component: that with the smallest doc_id (null last), ties to the smaller row key; of equal rows one stays.

    With ``percent``, texts whose sets of five-word shingles are at least that similar are linked too, exactly, by :mod:`tarnlake.llm.ngram_join`; a set's fingerprints are one component.
    """
    key, n = free_name(docs, "_key"), free_name(docs, "_n")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    with scratch(docs.sparkSession) as keep:
        more = None
        if percent is None:
            prints = stage(fingerprints(keyed, ["doc_id", key], shingle), "simhash")
        else:
            prints = stage(_marked(keyed, key, shingle, percent), "simhash")
            sets, similar = ngram_join.similar_sets(docs, prints, SIMILAR_SHINGLE, percent)
            one = stage(prints.where("sid is not null").groupBy("sid").agg(F.min("fp").alias("one")), "simhash-sets")
            of_set = sets.join(one, "sid").select("rid", "one")
            more = similar.join(of_set.toDF("a", "fp_a"), "a").join(of_set.toDF("b", "fp_b"), "b").select("fp_a", "fp_b")
            more = more.union(prints.join(one, "sid").where("fp <> one").select("fp", "one")).distinct()
        order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("key"))
        found = fingerprint_components(prints.select("fp", "doc_id", key), order, radius, more)
        stay = keep(found.groupBy("label").agg(F.first("first").alias("first")).select(F.col("first.key").alias(key)), "simhash-kept")
    kept = keyed.join(stay, key).withColumn(n, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    return kept.where(F.col(n) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
