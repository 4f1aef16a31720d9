"""Line dedup, mixing and preference formatting against plain Python."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnlake.llm import chat, line_dedup, mixing

DOCS = "doc_id long, text string, key string, n_lines string"


def _plain_dedup(docs):
    """docs: distinct (doc_id, text) in order."""
    seen, out = {}, {}
    for d, text in docs:
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if all(not x.strip(" ") for x in w):
                continue
            if w in seen:
                gone |= {i, i + 1, i + 2}
            seen.setdefault(w, (d, i))
        out[d, text] = (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


def test_line_dedup(spark):
    rng = random.Random(1)
    docs = [(i, "\n".join(rng.choice("abc") + rng.choice(["", " "]) for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "a\na\na\na"), (104, "z" * 50_000 + "\ny\nx"), (105, "z" * 50_000 + "\ny\nx\nw"), (106, "\n".join(map(str, range(3_000))) + "\n" + "\n".join(map(str, range(3_000))))]
    want = _plain_dedup(docs)
    rows = [(d, t, "k", "n") for d, t in docs] + [(*docs[3], "copy", "n")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS).repartition(3))
    assert got.columns == ["doc_id", "text", "key", "n_lines", "n_removed"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        source = dict(docs)[r["doc_id"]]
        assert (r["text"], r["n_removed"]) == want[r["doc_id"], source]
        assert r["n_lines"] == (0 if source is None else source.count("\n") + 1)


def test_line_dedup_of_null_ids_and_nothing(spark):
    text = "p\nq\nr"
    got = line_dedup.dedup_lines(spark.createDataFrame([(None, text, "", ""), (7, text, "", "")], DOCS)).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {None: 3, 7: 0}
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 10_000), min_size=1, max_size=12), st.sampled_from([8, 64, 100, 1024]))
def test_pfair_deviation(weights, period):
    slots = mixing.quanta({k: float(v) for k, v in weights.items()}, period)
    n = sum(slots.values())
    assert n == max(period, 4 * len(weights)) and all(c >= 1 for c in slots.values())
    table = mixing.pfair_slots(slots)
    assert sorted(t for ts in table.values() for t in ts) == list(range(n))
    for s, ts in table.items():
        had, marks = 0, set(ts)
        for t in range(n):
            had += t in marks
            assert abs(had - (t + 1) * slots[s] / n) < 1


def _plain_mix(counts, slots, blocks_of):
    """Earliest deadline first over as many slots as it takes, source by source."""
    n, out, next_ = sum(slots.values()), {}, dict.fromkeys(slots, 0)
    t = 0
    while any(next_[s] < blocks_of[s] for s in slots):
        ready = [(-(-(next_[s] + 1) * n // c), s) for s, c in slots.items() if next_[s] * n // c <= t]
        _, s = min(ready)
        if next_[s] < blocks_of[s]:
            out[s, next_[s]] = t
        next_[s] += 1
        t += 1
    return out


def test_mix_equals_simulation(spark):
    counts = {"a": 700, "b": 90, "c": 211, "": 5}
    rows = [(i * 10 + k, s or None, f"t{i}", 1, 2) for k, (s, n) in enumerate(counts.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, mix_slot int, _hash int").repartition(5)
    out = mixing.mix_sources(docs, block_rows=8, period=64)
    assert out.columns == ["doc_id", "source", "text", "_hash", "mix_block", "mix_slot", "mix_index"]
    got = out.collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows) and len({r["mix_index"] for r in got}) == len(rows)
    slots = mixing.quanta({s: n**0.5 for s, n in counts.items()}, 64)
    want = _plain_mix(counts, slots, {s: -(-n // 8) for s, n in counts.items()})
    assert {(r["source"] or "", r["mix_block"]): r["mix_slot"] for r in got} == want
    assert all(r["mix_index"] // 8 == r["mix_slot"] for r in got)


def test_default_mix_equals_simulation(spark):
    """The query's own path, against one slot after another: of the blocks whose window is open, that which must be placed first."""
    from fractions import Fraction

    counts = {"a": 700, "b": 90, "c": 211, "": 5}
    rows = [(i * 10 + k, s or None, f"t{i}") for k, (s, n) in enumerate(counts.items()) for i in range(n)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5), block_rows=8).collect()
    weights = {s: Fraction(n**0.5) for s, n in counts.items()}
    share = {s: w / sum(weights.values()) for s, w in weights.items()}
    blocks, done, want, t = {s: -(-n // 8) for s, n in counts.items()}, dict.fromkeys(counts, 0), {}, 0
    while any(done[s] < blocks[s] for s in counts):
        open_ = [(math.ceil((done[s] + 1) / share[s]), s) for s in counts if done[s] < blocks[s] and math.floor(done[s] / share[s]) <= t]
        if open_:
            deadline, s = min(open_)
            assert t < deadline
            want[s, done[s]] = t
            done[s] += 1
        t += 1
    assert {(r["source"] or "", r["mix_block"]): r["mix_slot"] for r in got} == want
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows) and len({r["mix_index"] for r in got}) == len(rows)


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.floats(1e-6, 1e6), min_size=1, max_size=12))
def test_exact_deviation(weights):
    """Against the weights themselves, while no source has ended; every block once and in order."""
    shares, n = mixing.exact_shares(weights)
    had = dict.fromkeys(shares, 0)
    for at, (s, i, t) in zip(range(3_000), mixing.exact_slots(shares, dict.fromkeys(shares, 10**9)), strict=False):
        assert t == at and i == had[s]
        had[s] += 1
        assert all(abs(had[x] * n - (t + 1) * c) < n for x, c in shares.items())


def test_exact_deviation_over_many_slots():
    """A million slots, weights that no short period fits."""
    shares, n = mixing.exact_shares({"a": 1 / 3, "b": 2**0.5, "c": 1e-4, "d": 0.1})
    had = dict.fromkeys(shares, 0)
    for t, (s, i, at) in zip(range(1_000_000), mixing.exact_slots(shares, dict.fromkeys(shares, 10**9)), strict=False):
        assert t == at and i == had[s]
        had[s] += 1
        if t % 97 == 0:
            assert all(abs(had[x] * n - (t + 1) * c) < n for x, c in shares.items())


@pytest.mark.parametrize(("counts", "power"), [({"a": 4_200, "b": 4_200, "c": 4_200}, 0.5), ({"big": 6_000} | {f"s{k}": 1 for k in range(300)}, 0.9)])
def test_mix_keeps_the_weights(spark, counts, power):
    """Blocks of one row, over several periods of 1,024 slots: each source is within a block of its unrounded weight until it ends."""
    rows = [(f"{s}{i}", s, "t") for s, n in counts.items() for i in range(n)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id string, source string, text string"), power=power, block_rows=1).select("source", "mix_slot").collect()
    assert len({r["mix_slot"] for r in got}) == len(rows)
    total = sum(n**power for n in counts.values())
    for s, n in counts.items():
        slots, w = sorted(r["mix_slot"] for r in got if r["source"] == s), n**power / total
        assert len(slots) == n and all(abs(i + 1 - (t + 1) * w) < 1 + 1e-9 for i, t in enumerate(slots))


def test_mix_edges(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.mix_sources(spark.createDataFrame([], schema)).count() == 0
    same = [(None, "a", None)] * 4 + [(1, "b", "t")]
    assert mixing.mix_sources(spark.createDataFrame(same, schema), {"a": 3, "b": 1, "unused": 9}).count() == 5
    with pytest.raises(ValueError):
        mixing.mix_sources(spark.createDataFrame(same, schema), {"a": 1})
    with pytest.raises(ValueError):
        mixing.quanta({"a": 0.0})


TURNS = "pair_id long, rejected boolean, turn long, role string, text string, prompt string"


def _plain_pair(chosen, rejected):
    render = lambda ts: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in ts)
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return n, render(chosen[:n]), render(chosen[n:]), render(rejected[n:])


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), st.sampled_from(["a", "b", "ü\n"])), max_size=5)] * 2), min_size=8, max_size=20))
def test_preferences(spark, pairs):
    rows = [(p, bad, i, r, t, "x") for p, sides in enumerate(pairs) for bad, ts in zip((False, True), sides, strict=True) for i, (r, t) in enumerate(ts)]
    got = {r["pair_id"]: r for r in chat.format_preferences(spark.createDataFrame(rows + rows[:3], TURNS)).collect()}
    for p, (c, r) in enumerate(pairs):
        if c or r:
            x = got.pop(p)
            assert (x["n_prompt_turns"], x["prompt"], x["chosen"], x["rejected"]) == _plain_pair(c, r)
            for side, turns in (("chosen", c), ("rejected", r)):
                assert "".join(s["text"] for s in x[f"{side}_segments"]) == x[side]
                assert [s["text"] for s in x[f"{side}_segments"] if s["learn"]] == [f"{t}<|im_end|>\n" for role, t in turns[x["n_prompt_turns"] :] if role == "assistant"]
    assert not got


def test_preferences_with_nulls(spark):
    rows = [(1, False, None, None, None, ""), (1, True, 0, "user", "q", ""), (None, True, 0, "user", "q", ""), (2, None, 0, "user", "q", ""), (3, False, 0, "user", "q", "")]
    got = {r["pair_id"]: r for r in chat.format_preferences(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(got) == {1, 3} and got[3]["rejected"] == "" and got[3]["n_prompt_turns"] == 0
    assert got[1]["chosen"] == "<|im_start|>\n<|im_end|>\n"
    assert chat.format_preferences(spark.createDataFrame([], TURNS)).count() == 0


def test_tokenized_masks(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    rows = [(1, bad, i, r, t, "") for bad, last in ((False, "good é"), (True, "bad <|endoftext|>")) for i, (r, t) in enumerate([("user", "hi there"), ("assistant", last), ("user", "more")])]
    r = chat.tokenize_preferences(chat.format_preferences(spark.createDataFrame(rows, TURNS)), path).first()
    tokenizer = chat._tokenizer(path)
    for side, last in (("chosen", "good é"), ("rejected", "bad <|endoftext|>")):
        ids, labels = r[f"{side}_ids"], r[f"{side}_labels"]
        assert tokenizer.decode(ids, skip_special_tokens=False) == r["prompt"] + r[side]
        assert tokenizer.decode([x for x in labels if x != chat.IGNORED], skip_special_tokens=False) == f"{last}<|im_end|>\n"
        assert all(b in (a, chat.IGNORED) for a, b in zip(ids, labels, strict=True))


def test_tokenizing_nothing_and_nulls(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    pairs = chat.format_preferences(spark.createDataFrame([(1, False, 0, None, None, "")], TURNS))
    assert chat.tokenize_preferences(pairs.where("pair_id = 2"), path).count() == 0
    r = chat.tokenize_preferences(pairs.selectExpr("* except (prompt)", "cast(null as string) as prompt"), path).first()
    assert r["rejected_ids"] == [] == r["rejected_labels"] and r["chosen_ids"] and set(r["chosen_labels"]) == {chat.IGNORED}
