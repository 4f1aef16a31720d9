"""Language ID, substring dedup, scoring and decontamination against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import common, decontam, langid, lm, substring
from tarnlake.sources.sinks import ConcurrentWrite
from tests.conftest import DATA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}" for i in range(40_000))


def _texts(seed=0, n=80, vocabulary=12):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(vocabulary)] + ["é", "Ünï", "A"]
    out = [rng.choice([" ", "\n", "\t "]).join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(n)]
    for _ in range(n // 2):
        a, b = rng.randrange(n), rng.randrange(n)
        part = WORD.findall(out[a])[3 : 3 + rng.randrange(10, 25)]
        out[b] += " " + "  ".join(part)
    return out


def test_words_and_hashes():
    texts = ["", " a", "b ", "ab", "a b c", "x" * 200, "x" * 199 + "y", "\n", "ab"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    starts, ends, first = common.scan_words(data, offsets)
    found = [[data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [WORD.findall(t) for t in texts]
    h = common.word_hashes(data, starts, ends)
    flat = [w for ws in found for w in ws]
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


def _plain_substring(docs):
    seen = {}
    for d, t in docs:
        w = WORD.findall(t or "")
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            seen[k] = min(seen.get(k, math.inf), math.inf if d is None else d)
    out = []
    for d, t in docs:
        w, gone = WORD.findall(t or ""), set()
        for i in range(len(w) - 12):
            if seen[tuple(w[i : i + 13])] < (math.inf if d is None else d):
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("ingests", [1, 3])
def test_substring_dedup(spark, ingests):
    docs = list(enumerate(_texts(), 5)) + [(2, None), (3, ""), (900, LONG), (901, "x " + LONG), (7, _texts()[2]), (7, _texts()[2]), (None, LONG[:4000]), (-4, " ".join(WORD.findall(LONG)[100:113]))]
    rows = [(d, t, "c", 1) for d, t in docs]
    got = substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string, batch string, bucket int").repartition(6), ingests=ingests).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(_plain_substring(docs), key=repr)
    assert any(r["n_removed"] for r in got)


def test_substring_dedup_of_nothing(spark):
    assert substring.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_compacts(spark):
    """Runs on disk stay; a compaction holds every fingerprint once, with its first file. The second batch is merged with the first, the third is too small to be, the fourth is merged with the third."""
    index, sets = substring.FingerprintIndex(), {"f1": [1, 5, 9], "f2": [5, 7], "f3": [9, 11], "f4": [1, 12]}
    hits, runs = {}, []
    for (name, prints), size in zip(sets.items(), (100, 100, 10, 10), strict=True):
        new = spark.createDataFrame([(0, name, bytearray(np.array(prints, np.uint64).tobytes()))], "bucket int, batch string, data binary")
        for r in index.ingest(new, size, 1).collect():
            hits.setdefault(r["batch"], set()).update(np.frombuffer(bytes(r["data"]), np.uint64).tolist())
        runs.append([r.size for r in index.runs])
    assert hits == {"f1": {1, 5, 9}, "f2": {5}, "f3": {9}, "f4": {1}} and runs == [[100], [200], [200, 10], [200, 20]]
    held = [r for run in index.runs for r in run.rows.collect()]
    entries = {int(e): r["names"][o] for r in held for e, o in zip(np.frombuffer(bytes(r["data"]), np.uint64), np.frombuffer(bytes(r["owners"]), np.uint32), strict=True)}
    assert entries == {1: "f1", 5: "f1", 9: "f1", 7: "f2", 11: "f3", 12: "f4"} and len(held) == 2


def test_runs_grow_like_a_log():
    """A thousand ingests of any sizes: what is written stays within n log n, and runs are few."""
    for draw in (lambda rng: 1, lambda rng: rng.randrange(1, 1_000), lambda rng: 10 ** rng.randrange(6)):
        rng, runs, written, total = random.Random(3), [], 0, 0
        for _ in range(1_000):
            size = draw(rng)
            total += size
            some = substring.merged_with(size, runs)
            size += sum(runs[i] for i in some)
            runs = [r for i, r in enumerate(runs) if i not in some] + [size]
            written += size
        assert sum(runs) == total and len(runs) <= math.log2(total) + 1 and written <= 2.5 * total * math.log2(total)
    assert substring.merged_with(1, [10**12]) == []


def test_runs_are_cut_finer(spark):
    """A run of two buckets met by a batch of eight gives what a run of eight gives."""
    from tarnlake.llm.batches import bucket_cells

    rng = np.random.default_rng(2)
    one, two = (np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2) // np.uint64(1 + k)) for k in (0, 1))
    two = np.unique(np.concatenate([two, one[::5]]))
    rows = lambda name, prints, buckets: spark.createDataFrame([(b, name, bytearray(prints[part].tobytes())) for b, part in bucket_cells(prints, buckets)], "bucket int, batch string, data binary")
    got = []
    for first in (2, 8):
        index = substring.FingerprintIndex()
        index.ingest(rows("f1", one, first), 50, first)
        hits = {}
        for r in index.ingest(rows("f2", two, 8), 50, 8).collect():
            hits.setdefault(r["batch"], []).extend(np.frombuffer(bytes(r["data"]), np.uint64).tolist())
        held = sorted((r["bucket"], bytes(r["data"])) for r in index.runs[0].rows.collect())
        got.append(({k: sorted(v) for k, v in hits.items()}, held))
    assert got[0] == got[1] and sorted(got[0][0]) == ["f1", "f2"] and len(got[0][1]) == 8


def test_scores(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lm, "WARM_STEPS", 30)
    monkeypatch.setattr(lm, "STEPS", 5)
    public = pytest.importorskip("public_tokenizers")
    docs = list(enumerate(_texts(3, 60))) + [(100, None), (101, " \n"), (102, LONG), (103, "ÉCOLE École école"), (4, "twice"), (4, "twice"), (None, "null id")]
    rows = [(d, t, 0.5, "n") for d, t in docs]
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string, score double, batch string").repartition(4), public.path("byte_bpe_multi_50k.tiktoken")).collect()
    low = lambda t: [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    counts = collections.Counter(w for d, t in docs if not held(d) for w in low(t))
    n, v = sum(counts.values()), len(counts)
    want = [(d, len(low(t)), sum(counts[w] > 0 for w in low(t)), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in low(t)), 6)) for d, t in docs]
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string"), public.path("byte_bpe_multi_50k.tiktoken")).count() == 0


def test_words_are_encoded_together():
    """As many ids for each word as it has by itself, white space beyond ASCII within or around it included; and few calls of the encoder."""
    public = pytest.importorskip("public_tokenizers")
    tokenizer = lm.Tokenizer(public.path("byte_bpe_multi_50k.tiktoken"))
    words = [f"w{i}" for i in range(2_500)]
    words[1_200:1_200] = ["a\u00a0", "b", "\u3000", "\u00a0c", "d\u2003e", "\x1f", "\x85f", "école", "\U0001f600", "g"]
    encode, calls = tokenizer.encoding.encode_ordinary, []
    want = [encode(" " + w) for w in words]
    tokenizer.encoding.encode_ordinary = lambda text: calls.append(text) or encode(text)
    ids, size = tokenizer.words(words)
    assert ids.tolist() == [i for x in want for i in x] and size.tolist() == list(map(len, want))
    assert len(calls) < 30
    assert [len(x) for x in tokenizer.words([])] == [0, 0]


def test_shared_words_are_encoded_once(monkeypatch):
    """A file's ids are those of its words one by one, whether files before it had the words or not; words that earlier files had aren't encoded again, as long as they fit."""
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_multi_50k.tiktoken")

    def file(*texts):
        data, offsets = common.text_buffer(pa.array(texts))
        return lm._Words(SimpleNamespace(data=data, offsets=offsets, ids=list(range(len(texts)))))

    files = [file("One two two", "three écoles \u00a0x"), file("two ONE  four", None, "\u3000"), file(), file("four one", "five"), file("five")]
    plain = lm.Tokenizer(path).encoding.encode_ordinary
    for most, want in ((1 << 20, [5, 2, 0, 1, 0]), (6, [5, 2, 0, 2, 1]), (4, [5, 4, 0, 1, 1])):
        monkeypatch.setattr(lm, "KNOWN", most)
        known, asked = lm._Known(path), []
        encode = known.tokenizer.words
        known.tokenizer.words = lambda words, encode=encode, asked=asked: asked.append(len(words)) or encode(words)
        for words in files:
            every = words.texts(np.arange(len(words.distinct)))
            ids, size = known.ids(words)
            assert ids.tolist() == [i for w in every for i in plain(" " + w)] and size.tolist() == [len(plain(" " + w)) for w in every]
        assert asked == want and len(known.hashes) <= most


def _small_model(tokens, first, counts):
    symbols = lm.Symbols(counts, size=20, shared=2)
    return lm.Attention(symbols.learn(symbols.pairs(tokens, first), classes=6))


def test_attention_is_a_distribution_and_learns():
    """Scores equal a plain token-by-token pass, and what may come next sums to one; training raises the score of a pattern that pairs don't tell."""
    rng = np.random.default_rng(1)
    tokens = np.concatenate([np.tile([a, 9, 9, b], 40) for a, b in ((1, 2), (3, 4), (5, 30))] + [[7]])
    tokens = np.concatenate([tokens, rng.integers(0, 64, 40)])
    first = np.array([0, 160, 320, 481, 482, 521])
    counts = np.bincount(tokens, minlength=64)
    model = _small_model(tokens, first, counts)
    s = model.symbols
    before = model.score(tokens, first)
    plain = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        total = 0.0
        for i in range(a, b):
            at = i - (i - a) % lm.STRIDE  # the window that scores token i
            begin = at - (lm.WINDOW - lm.STRIDE)
            x = np.array([[s.of[tokens[min(p, len(tokens)) - 1]] if p - 1 >= a else s.start for p in range(begin, begin + lm.WINDOW)]])
            logits = model._forward(x, 0)[0][i - begin].astype(float)
            p = np.exp(logits) / np.exp(logits).sum()
            every = p[s.class_of[s.of]] * np.exp(s.table.reshape(s.n + 1, s.n)[s.of[tokens[i - 1]] if i > a else s.start][s.of] + s.within)
            assert abs(every.sum() - 1) < 1e-5
            total += math.log10(every[tokens[i]])
        plain.append(total)
    assert np.allclose(before, plain, rtol=1e-4)
    model.fit(tokens, first, 120, 0.03)
    assert model.score(tokens, first)[:3].sum() > before[:3].sum() + 30


def test_attention_gradients():
    rng = np.random.default_rng(3)
    tokens, first = rng.integers(0, 40, 400), np.array([0, 130, 400])
    model = _small_model(tokens, first, np.bincount(tokens, minlength=40))
    x = rng.integers(0, 22, (3, lm.WINDOW))
    y, live = rng.integers(0, 6, x.shape), rng.random(x.shape) < 0.8
    _, grads = model.gradients(x, y, live)
    assert set(grads) == set(model.weights)
    for name, g in grads.items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        change = []
        for step in (1e-2, -1e-2):
            model.weights[name][i] += step
            change.append(model.gradients(x, y, live)[0])
            model.weights[name][i] -= step
        assert abs((change[0] - change[1]) / 2e-2 - g[i]) < 0.05 * abs(g[i]) + 1e-3, name


def test_weights_survive_the_sum():
    model = _small_model(np.arange(40), np.array([0, 40]), np.ones(40, np.int64))
    flat, total = model.flat(), np.zeros(model.flat().size)
    lm._added(lm._packed_sum(flat.astype(np.float64)), total)
    model.set_flat(total)
    assert np.array_equal(model.flat(), flat)


def test_model_beats_the_unigram(spark):
    """On a thousand texts, of which a fifth weren't learned from."""
    docs = spark.read.parquet(str(DATA.parent / "sf0.01/documents.parquet")).select("doc_id", "text")
    out = lm.score_texts(docs).where(lm.held_out(F.col("doc_id"))).agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert out[2] > 100 and out[0] > out[1]


def test_future_tokens_do_not_matter():
    tokens = np.random.default_rng(2).integers(0, 40, 500)
    model = _small_model(tokens, np.array([0, 500]), np.bincount(tokens, minlength=40))
    x = np.random.default_rng(0).integers(0, 22, (1, lm.WINDOW))
    y = x.copy()
    y[0, 20:] = 5
    a, b = model._forward(x, 0)[0], model._forward(y, 0)[0]
    assert np.allclose(a[:20], b[:20]) and not np.allclose(a[20:], b[20:])


def test_gru_gradients():
    rng, y = np.random.default_rng(0), np.array([0, 1, 2, 3, 0])
    x = rng.integers(0, 256, (7, 5)).astype(np.intp)

    def loss(weights):
        m = langid.ByteGRU(list("abcd"))
        m.weights = weights
        f, b = m._run("f", x, False)[0], m._run("b", x[::-1], False)[0]
        return -np.log(m._position_probabilities(f, b[::-1].copy())[:, y, np.arange(5)].astype(float)).mean()

    model, moments = langid.ByteGRU(list("abcd")), {}
    start = {k: v.copy() for k, v in model.weights.items()}
    model.train_step(x, y, moments, 1)
    for k in start:
        g = moments[k][0] / 0.1
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = ({n: v.copy() for n, v in start.items()} for _ in range(2))
        up[k][i] += 1e-2
        down[k][i] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g[i]) < 0.05 * abs(g[i]) + 1e-4


def _language_docs():
    rng = random.Random(2)
    vocabulary = {"xx": "aeiou", "yy": "äöüß", "zz": "bcdfg"}
    return [(i, " ".join("".join(rng.choice(v) for _ in range(4)) for _ in range(rng.randrange(3, 60))), k) for i, (k, v) in enumerate(list(vocabulary.items()) * 40)]


def test_language_id(spark):
    docs = _language_docs()
    extra = [(500, None, "xx"), (501, "12 34 !?", "xx"), (502, "", None), (503, docs[1][1] * 300, None), (504, "aeio", None), (None, docs[0][1], "xx"), (None, docs[0][1], "xx")]
    rows = [(d, t, lang, "s", 3) for d, t, lang in docs + extra]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, other int")
    out = langid.identify(frame, langid.train(frame))
    assert out.columns == ["doc_id", "text", "lang", "other", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] < 500]
    assert len(held) > 10 and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (500, 501, 502))
    assert by[503]["lang_pred"] == docs[1][2]
    twins = [r for r in got if r["doc_id"] is None]
    assert len(twins) == 2 and twins[0]["score"] == twins[1]["score"]


def test_every_language_is_learned(spark, monkeypatch):
    """70 languages, each with letters of its own; the last six have the fewest documents."""
    rng = random.Random(5)
    docs = []
    for k in range(70):
        letters = [chr(0x4E00 + 64 * k + i) for i in range(4)]
        docs += [(1_000 * k + i, "".join(rng.choice(letters) for _ in range(40)), f"l{k:02}") for i in range(40 if k < 64 else 20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.train(frame)
    assert model.languages == sorted({y for _, _, y in docs})
    rare = [r for r in langid.identify(frame, model).collect() if r["lang"] >= "l64"]
    assert sum(r["lang_pred"] == r["lang"] for r in rare) >= 0.8 * len(rare)
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 69)
    with pytest.raises(ValueError):
        langid.train(frame)


@pytest.mark.parametrize("ids", ["null", "one", "own"])
def test_sample_whatever_the_ids_are(spark, monkeypatch, ids):
    """More rows than the sample takes, with null, equal or own ids, thousands of copies of one text, and a language of one row: every language is learned, and equally for all ids."""
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 20)
    docs = _language_docs() * 2 + [(7, "aeio uoie", "xx")] * 3_000 + [(9, "日本語 日本", "ja")]
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5)
    frame = spark.createDataFrame([({"null": None, "one": one, "own": one + 5_000 * k}[ids], t, y) for k, (_, t, y) in enumerate(docs) if ids != "own" or zlib.crc32(str(one + 5_000 * k).encode()) % 5 or y == "ja"], "doc_id long, text string, lang string")
    if ids == "own":
        frame = frame.withColumn("doc_id", F.when(F.col("lang") == "ja", one).otherwise(F.col("doc_id")))
    model = langid.train(frame.repartition(3))
    assert model.languages == ["ja", "xx", "yy", "zz"]
    got = langid.identify(spark.createDataFrame([(d, t, y) for d, t, y in _language_docs()], "doc_id long, text string, lang string"), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)


def test_language_id_depends_on_text_alone(spark):
    model = langid.train(spark.createDataFrame(_language_docs(), "doc_id long, text string, lang string"))
    texts = [t for _, t, _ in _language_docs()[:20]] + ["é", "aeiou" * 5000]
    raw = [t.encode() for t in texts]
    together = model.text_probabilities(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    alone = np.concatenate([model.text_probabilities(np.frombuffer(r, np.uint8), np.array([0, len(r)])) for r in raw])
    assert np.allclose(together, alone, atol=1e-5) and np.allclose(together.sum(axis=1), 1, atol=1e-4)


def _plain_language(model, text):
    """Both recurrences byte by byte, in plain numbers: the mean of all positions' probabilities."""
    n, w, raw = model.hidden, {k: v.astype(float).tolist() for k, v in model.weights.items()}, text.encode()
    soft = lambda x: x / (1 + abs(x))

    def states(d, row):
        h, out = [0.0] * n, []
        for byte in row:
            a = [w[f"x{d}"][k][byte] for k in range(3 * n)]
            u = [sum(w[f"h{d}"][k][j] * h[j] for j in range(n)) for k in range(3 * n)]
            gate = [0.5 + 0.5 * soft(a[k] + u[k]) for k in range(2 * n)]
            new = [soft(a[2 * n + k] + gate[k] * u[2 * n + k]) for k in range(n)]
            h = [new[k] + gate[n + k] * (h[k] - new[k]) for k in range(n)]
            out.append(h)
        return out

    total = [0.0] * len(model.languages)
    for start in range(0, len(raw), langid.SEGMENT):
        stop = min(start + langid.SEGMENT, len(raw))
        begin = max(0, stop - langid.SEGMENT)
        row = list(raw[begin:stop]) + [0] * (langid.SEGMENT - (stop - begin))
        forward, backward = states("f", row), states("b", row[::-1])[::-1]
        for t in range(start - begin, stop - begin):
            both = forward[t] + backward[t]
            logits = [sum(a * b for a, b in zip(w["o"][k], both, strict=True)) + w["b"][k][0] for k in range(len(total))]
            top = [math.exp(x - max(logits)) for x in logits]
            total = [x + y / sum(top) for x, y in zip(total, top, strict=True)]
    return [x / len(raw) for x in total]


def test_language_probabilities_byte_by_byte(spark):
    model = langid.train(spark.createDataFrame(_language_docs(), "doc_id long, text string, lang string"))
    texts = [*[t for _, t, _ in _language_docs()[:4]], "é", "a" * 64, "bcd " * 30 + "äö"]
    raw = [t.encode() for t in texts]
    got = model.text_probabilities(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.allclose(got, [_plain_language(model, t) for t in texts], atol=1e-4)


def test_language_id_with_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.identify(frame, langid.train(frame)).first()["lang_pred"] == "und"
    assert langid.identify(frame.limit(0), langid.train(frame.limit(0))).count() == 0


@pytest.mark.parametrize("growth", [0, 2, 1_000])
def test_substring_index_across_sessions(spark, tmp_path, growth):
    """Batches that are ingested by an index opened anew each time give what one run over all gives, whichever batch has the smaller ids and however small the first one is."""
    docs = [(i * 7 % 83, t) for i, t in enumerate(_texts(21, 80))] + [(None, LONG[:3000]), (500, LONG[:3000]), (501, None)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    path = f"file://{tmp_path}/index"
    assert substring.SubstringIndex(spark, path).deduplicated().count() == 0
    parts = (docs[:2], [], docs[2:60], docs[60:])
    for part in parts:
        substring.SubstringIndex(spark, path, growth=growth).ingest(frame(part))
    index = substring.SubstringIndex(spark, path)
    got, want = sorted(map(tuple, index.deduplicated().collect()), key=repr), sorted(_plain_substring(docs), key=repr)
    assert got == want and sum(r[2] for r in got) > 100
    assert len(index.runs) == {0: 3, 2: 2 if index.runs[-1]["size"] * 2 < index.runs[0]["size"] else 1, 1_000: 1}[growth]
    names = [sorted(repr(r) for r in index.deduplicated(k).collect()) for k in range(4)]
    assert sorted(x for own in names for x in own) == sorted(repr(r) for r in index.deduplicated().collect())
    assert [len(x) for x in names] == [len(p) for p in parts] and names[-1] == sorted(repr(r) for r in index.deduplicated(-1).collect())
    broken = frame([(1, "a " * 40)]).select("doc_id", F.raise_error(F.lit("stop")).alias("text"))
    with pytest.raises(Exception, match="stop"):
        index.ingest(broken)
    assert sorted(map(tuple, substring.SubstringIndex(spark, path).deduplicated().collect()), key=repr) == got
    late = substring.SubstringIndex(spark, path)
    substring.SubstringIndex(spark, path).ingest(frame([(9_000, "z")]))
    with pytest.raises(ConcurrentWrite):
        late.ingest(frame([(9_001, "z")]))


def _plain_score(model, tokens):
    """log10 probability of one text's token ids, one token after another: class given the context, symbol given class and the symbol before, token given symbol."""
    w, sym, d = {k: v.astype(float) for k, v in model.weights.items()}, model.symbols, lm.WIDTH
    symbols = [int(sym.of[t]) for t in tokens]
    total = 0.0
    for i, token in enumerate(tokens):
        place = i % lm.STRIDE + lm.WINDOW - lm.STRIDE  # within its window
        base = i - place
        context = [symbols[base + k - 1] if base + k - 1 >= 0 else sym.start for k in range(place + 1)]
        e = [w["e"][s] + w["p"][k] for k, s in enumerate(context)]
        qkv = [x @ w["qkv"] for x in e]
        weight = [math.exp(min(30, max(-30, float(qkv[place][:d] @ x[d : 2 * d]) / d**0.5))) for x in qkv]
        mixed = sum(a * x[2 * d :] for a, x in zip(weight, qkv, strict=True)) / sum(weight)
        h = e[place] + mixed @ w["o"]
        top = h + np.maximum(h @ w["in"] + w["bi"], 0) @ w["out"]
        logits = np.clip(top @ w["u"] + w["bu"], -60, 60) + sym.class_table[context[place]]
        before = symbols[i - 1] if i else sym.start
        assert before == context[place]
        total += logits[sym.class_of[symbols[i]]] - math.log(np.exp(logits).sum()) + sym.table[before * sym.n + symbols[i]] + sym.within[token]
    return total / math.log(10)


def test_scores_token_by_token():
    """The batched score of texts of every length around a window's, against one token at a time; and it is a probability: over all next tokens it sums to one."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 90, n) for n in (1, 2, 7, 8, 23, 24, 25, 31, 32, 33, 60, 97)]
    tokens, first = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    counts = np.bincount(tokens, minlength=100).astype(float)
    symbols = lm.Symbols(counts, size=40, shared=3)
    symbols.learn(symbols.pairs(tokens, first), classes=12)
    model = lm.Attention(symbols)
    model.fit(tokens, first, 5, 0.03)
    got = model.score(tokens, first)
    assert np.allclose(got, [_plain_score(model, t) for t in texts], rtol=1e-3, atol=1e-3)
    start = texts[5][:6].tolist()
    one = sum(10 ** (_plain_score(model, [*start, t]) - _plain_score(model, start)) for t in range(100))
    assert abs(one - 1) < 1e-3


CONTENT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _content(t):
    return CONTENT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def _plain_contamination(text, items):
    windows = {}
    for item, t in items:
        x = _content(t)
        for i in range(max(1, len(x) - 12) if x else 0):
            windows.setdefault(tuple(x[i : i + 13]), set()).add(item)
    w, hit, ids = _content(text), set(), set()
    for n in {len(x) for x in windows}:
        for s in range(len(w) - n + 1):
            if (found := windows.get(tuple(w[s : s + n]))) is not None:
                hit.update(range(s, s + n))
                ids |= {str(x) for x in found if x is not None}
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("bound", [None, 0])
def test_decontamination(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", bound)
    base = _texts(5, 30, 400)
    items = [(1, base[0]), (1, base[0]), (22, " ".join(_content(base[1])[:20])), (3, "Ünï short ITEM"), (4, None), (5, "!!"), (None, "null id item"), (6, "a a a a"), (2, base[0] + " more")]
    docs = list(enumerate(base + _texts(6, 30, 400))) + [(200, "x " * 50 + "ünï Short item"), (201, "Ünï-SHORT/item, É"), (202, None), (203, ""), (204, LONG + " null id item " + LONG), (205, "a a a a a a"), (206, base[0]), (206, base[0]), (None, "short item"), (207, " ".join(["pad"] * 57) + " null id item"), (208, " ".join(["pad"] * 58) + " null id item")]
    frame = spark.createDataFrame([(d, t, "w", "k", 9) for d, t in docs], "doc_id long, text string, n_words string, key string, _found int").repartition(4)
    out = decontam.mark_contamination(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == ["doc_id", "text", "key", "_found", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in out.collect()), key=repr)
    assert got == sorted(((d, *_plain_contamination(t, items)) for d, t in docs), key=repr)
    assert sum(r[-1] for r in got) > 5


def test_decontamination_of_a_window_that_many_items_share(spark):
    """Ids are joined to windows once a document has them, so occurrences carry a number each, not every item's id."""
    items = [(i, "one two three four") for i in range(400)] + [(1_000, "five six")]
    docs = [(d, "one two three four " * 50 + "x " * d) for d in range(30)] + [(99, "five six one two three")]
    out = decontam.mark_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in out.collect())
    assert got == sorted((d, *_plain_contamination(t, items)) for d, t in docs)


def test_decontamination_of_nothing(spark):
    docs, items = "doc_id long, text string", "item_id long, text string"
    assert decontam.mark_contamination(spark.createDataFrame([], docs), spark.createDataFrame([(1, "a b")], items)).count() == 0
    r = decontam.mark_contamination(spark.createDataFrame([(1, "a b")], docs), spark.createDataFrame([], items)).first()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (2, 0, False)


@pytest.mark.parametrize("block", [5, 64])
def test_decontamination_across_blocks(spark, block):
    """Windows that touch two blocks count their words once, and rows that repeat get equal results."""
    items = [(i, t) for i, t in enumerate(_texts(8, 30))] + [(90, "A"), (91, "v1 v2 v3")]
    docs = [(i, t) for i, t in enumerate(_texts(9, 40) + [items[3][1] * 3, LONG])] + [(700, items[5][1])] * 2
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, own int").repartition(3)
    out = decontam.mark_contamination(frame, spark.createDataFrame(items, "item_id long, text string"), block=block)
    assert sorted(map(tuple, out.drop("text", "own").collect())) == sorted((d, *_plain_contamination(t, items)) for d, t in docs)


@pytest.mark.parametrize("words", [4_000, 40_000])
def test_decontamination_of_two_words(spark, words):
    """Every word of the document is the prefix of many windows. Places, not windows, are gathered."""
    rng = random.Random(words)
    items = [(i, " ".join(rng.choice("ab") for _ in range(40))) for i in range(40)]
    docs = [(1, " ".join(rng.choice("ab") for _ in range(words))), (2, "a " * words), (3, items[7][1])]
    out = decontam.mark_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, out.drop("text").collect())) == sorted((d, *_plain_contamination(t, items)) for d, t in docs)


def test_only_ascii_is_lowered(spark):
    """Every character beyond ASCII, alone and beside capitals, stays as it is."""
    points = [c for c in map(chr, range(0x80, 0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["".join(points[i : i + 64]) + "AZ[`az" for i in range(0, len(points), 64)] + [c + "I\u0307Q" for c in points if c.lower() != c or c.upper() != c]
    rows = spark.createDataFrame([(t,) for t in [*texts, "", "ABC xyz", "\u03a3A\u03a3"]], "t string").repartition(8)
    for r in rows.select("t", common.lower_ascii(F.col("t")).alias("low")).collect():
        assert r["low"] == r["t"].translate({65 + i: 97 + i for i in range(26)})
