"""The pipeline's stages on awkward tables, each against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarnlake.llm import langid
from tests.llm.test_lines_mixing_chat import _plain_dedup
from tests.llm.test_search import _plain_similar
from tests.llm.test_text_operators import _plain_contamination

#: Columns that clash with names of the operators' own, beside those of documents.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, key int, score string, _row string, n_hit string, mix_slot int, label string"
STAGES = dict(corpus_pipeline.STAGES)


def _sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def _docs():
    rng = random.Random(11)
    texts = [_sentence(rng, rng.randrange(5, 90)) for _ in range(30)]
    texts += ["\n".join(_sentence(rng, 3, 12) for _ in range(rng.randrange(1, 9))) for _ in range(30)]
    texts += [None, "", " \n\t", "12 34 !?", "é", "word " * 20_000, texts[3] + " more", texts[3], texts[40], "\n".join(texts[k] for k in (1, 2, 4)), "\n".join(texts[k] for k in (1, 2, 4))]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[7], None, None, 0), (None, None, None, None, None), (0, texts[8], "en", "s0", 1)]
    return [(*r, "k", 1, "s", "r", "h", 2, "l") for r in rows]


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture
def bench(spark, tmp_path):
    items = [(1, _docs()[2][1]), (2, "w1 w2 w3"), (None, _docs()[4][1]), (4, None), (5, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    return f"file://{tmp_path}", items


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_of_an_empty_table(spark, bench, name):
    out = STAGES[name](spark, _frame(spark, []), bench[0])
    assert out.count() == 0 and (name.startswith("mixing") or out.columns == _frame(spark, []).columns)


def test_language_stage(spark):
    docs = _frame(spark, _docs())
    out = STAGES["language ID"](spark, docs, "")
    assert out.columns == docs.columns
    marked = langid.identify(docs.select("doc_id", "text"), langid.train(docs)).where((F.col("lang_pred") != "und") & (F.col("score") >= corpus_pipeline.LEAST_SCORE))
    got = [tuple(r) for r in out.collect()]
    assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted(((r["doc_id"], r["text"]) for r in marked.collect()), key=repr)
    assert set(got) <= set(_docs()) and not any((r[1] or "").strip("0123456789 !?\n\t") == "" for r in got)


def test_line_stage(spark):
    rows = _docs()
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda x: (x[0] is None, x[0]))
    ties = {d for d, _ in order if sum(e == d for e, _ in order) > 1}
    rows = [r for r in rows if r[0] not in ties]  # which of two texts of one id is first follows a hash
    want = _plain_dedup([x for x in order if x[0] not in ties])
    out = STAGES["line dedup"](spark, _frame(spark, rows), "")
    assert out.columns == _frame(spark, []).columns
    expected = [(r[0], want[r[0], r[1]][0], *r[2:4], None if r[1] is None else len(want[r[0], r[1]][0]), *r[5:]) for r in rows if not want[r[0], r[1]][1] or want[r[0], r[1]][0].strip(" ")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_near_stage(spark):
    rows = [r for r in _docs() if r[0] is not None and r[0] > 0]
    out = STAGES["SimHash near-dedup"](spark, _frame(spark, rows), "")
    assert out.columns == _frame(spark, []).columns
    got = [tuple(r) for r in out.collect()]
    assert sorted(r[0] for r in got) == _plain_similar([(r[0], r[1]) for r in rows]) and set(got) <= set(rows)


def test_near_copies_are_found(spark):
    """Copies with a word in two hundred changed: recall against brute force over all pairs is 1, and unlike documents stay."""
    rng = random.Random(4)
    docs = []
    for f in range(20):
        base = [f"f{f}w{rng.randrange(600)}" for _ in range(rng.randrange(60, 400))]
        docs.append(" ".join(base))
        for _ in range(6):
            some = list(base)
            for _ in range(max(1, len(some) // 200)):
                some[rng.randrange(len(some))] = f"x{rng.randrange(10**6)}"
            docs.append(" ".join(some))
    rng.shuffle(docs)
    rows = [(i, t, "en", "s", len(t), "k", 1, "s", "r", "h", 2, "l") for i, t in enumerate(docs)]
    got = sorted(r["doc_id"] for r in STAGES["SimHash near-dedup"](spark, _frame(spark, rows), "").collect())
    assert got == _plain_similar(list(enumerate(docs))) and len(got) == 20


def test_decontamination_stage(spark, bench):
    folder, items = bench
    rows = _docs()
    out = STAGES["benchmark decontamination"](spark, _frame(spark, rows), folder)
    assert out.columns == _frame(spark, []).columns
    want = [r for r in rows if not _plain_contamination(r[1], items)[-1]]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr) and len(want) < len(rows)


def test_mixing_stage(spark):
    rows = _docs()
    out = STAGES["mixing sources to target weights"](spark, _frame(spark, rows), "")
    got = [r.asDict() for r in out.collect()]
    assert len({r["mix_index"] for r in got}) == len(rows)
    plain = lambda r: (r["doc_id"], r["text"], r["source"], r["n_hit"])
    assert sorted(map(plain, got), key=repr) == sorted(((r[0], r[1], r[3], r[9]) for r in rows), key=repr)


def test_stages_are_as_asked():
    assert list(STAGES) == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]
