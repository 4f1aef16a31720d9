"""Collocations against plain counting."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tarnlake.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, m int, piece string, n string"


def _plain(docs, least, longest, top, stands_for):
    """docs: (text, lang). Rows (lang, rank, phrase, a, l, r, n, score)."""
    out = []
    for lang in {x or "und" if x is None else x for _, x in docs}:
        f, n = Counter(), 0
        for text, own in docs:
            if ("und" if own is None else own) != lang:
                continue
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for k in range(1, longest + 1):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        found = [p for p, c in f.items() if len(p) > 1 and c >= least]
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows = []
        for p in found:
            if any(len(q) > len(p) and 100 * f[q] >= stands_for * f[p] and inside(p, q) for q in found):
                continue
            score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out, key=repr)


def _docs():
    rng = random.Random(3)
    words = ["A", "b", "cé", "Ä", "e\x0bf", "日本", "x-y", "the", "THE", "\x1f"]
    docs = [(rng.choice([".", ", ", "\n", " ", "!? "]).join(rng.choice([" ", "  ", "\t"]).join(rng.choices(words, [9, 5, 5, 1, 1, 2, 2, 5, 5, 1], k=rng.randrange(9))) for _ in range(6)), rng.choice(["en", "de", "", None])) for _ in range(60)]
    return docs + [docs[0]] * 5 + [(None, "en"), ("", None), (" \t.,", "fr"), ("one", "it"), ("long word " * 3_000, "en"), ("z" * 100_000 + " y", "en"), ("a b c", "und")]


@pytest.mark.parametrize("least, longest, top", [(3, 4, 7), (2, 4, 1_000), (5, 3, 3), (2, 2, 50)])
def test_collocations(spark, least, longest, top):
    docs = _docs()
    frame = spark.createDataFrame([(i, t, x, "p", 1, "q", "n") for i, (t, x) in enumerate(docs)], SCHEMA).repartition(3)
    got = phrases.collocations(frame, least, longest, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for _, t in got.dtypes} == {"string", "bigint"}
    want = _plain(docs, least, longest, top, 80)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 4


def test_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, "", 1, "", "")], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        phrases.collocations(spark.createDataFrame([], SCHEMA), longest=1)


def test_scores_past_64_bits(spark):
    big = 9 * 10**15
    score = spark.createDataFrame([(big, big, big + 1)], "a long, l long, r long").selectExpr(f"CAST(a AS DECIMAL(20, 0)) * CAST({phrases.SCALE} AS DECIMAL(7, 0)) div CAST(l + r AS DECIMAL(20, 0)) AS x").first()["x"]
    assert score == 2_000_000 * big // (2 * big + 1) == 999_999


def test_buckets_larger_than_memory():
    batches = (pa.RecordBatch.from_pydict({"lang": ["en"] * 50_000, "phrase": [f"{'w' * 40} {i + 50_000 * (b % 40)}" for i in range(50_000)], "m": [1] * 50_000}) for b in range(80))
    old, phrases.MEMORY = phrases.MEMORY, "64MB"
    try:
        out = list(phrases._added_up(2)(batches))
    finally:
        phrases.MEMORY = old
    assert sum(b.num_rows for b in out) == 2_000_000 and all(set(b.column(2).unique().to_pylist()) == {2} for b in out if b.num_rows)


def test_filter_has_no_false_negatives(spark):
    import numpy as np

    from tarnlake.llm import bitfilter

    h = np.random.default_rng(1).integers(0, 1 << 63, 10_000)
    rows = spark.createDataFrame([(int(x),) for x in h], "h long").repartition(3)
    bits = bitfilter.bits_for(len(h))
    words = np.frombuffer(bitfilter.broadcast_filter(rows, lambda b: b.column(0).to_numpy().view(np.uint64), bits).value, np.uint64)
    assert 64 * len(words) == bits and bitfilter.known(h.view(np.uint64), words).all()
    assert bitfilter.known(h.view(np.uint64) + np.uint64(1 << 40), words).mean() < 0.01
    none = bitfilter.broadcast_filter(rows.where("h < 0"), lambda b: b.column(0).to_numpy().view(np.uint64), bitfilter.bits_for(0))
    assert not any(none.value)
