"""Conversation repair against every possible audit, and chunks against whole conversations."""

import hashlib
import random
import re
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.llm import repair

GOOD = re.compile(r"(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def _every_repair(turns, kinds):
    """All repairs with up to two inserts in a row, as (cost, audit, repaired turns)."""

    def runs():
        return [()] + [(x,) for x in "ua"] + list(product("ua", repeat=2))

    def after(i):
        if i == len(turns):
            return [(5 * len(r), "I" * len(r), [(NAMES[x], "") for x in r]) for r in runs()]
        (role, text), (initial, must_go, cut_off) = turns[i], kinds[i]
        edits = [(2, "D", [])]
        if not must_go:
            edits += [(5 * cut_off, "K", [(role, text)])] + [(1 + 5 * cut_off, "R", [(n, text)]) for n in NAMES.values()]
        assert initial == role[:1]
        return [(5 * len(r) + c + cost, "I" * len(r) + e + audit, [(NAMES[x], "") for x in r] + kept + rest) for r in runs() for c, e, kept in edits for cost, audit, rest in after(i + 1)]

    return min((x for x in after(0) if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in x[2]))), key=lambda x: x[:2])


@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.booleans(), st.booleans()), max_size=3))
@settings(max_examples=25, deadline=None)
def test_repair_is_the_cheapest(rows):
    turns = [(r, f"t{i}") for i, (r, _, _) in enumerate(rows)]
    kinds = [(r[:1], gone, cut) for r, gone, cut in rows]
    assert repair.repair(turns, kinds) == _every_repair(turns, kinds)


@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from([False, False, True]), st.booleans()), max_size=30), st.lists(st.integers(0, 30), max_size=4))
def test_chunks_give_what_the_whole_gives(kinds, cuts):
    cost, layer, pointers = repair._layers(kinds, 0)
    total, end = repair._best_end(cost, layer)
    edges = sorted({0, len(kinds), *(c for c in cuts if c <= len(kinds))})
    parts, at, joined, backs, chunks = 0, repair._first(0), 0, [], []
    for a, b in zip(edges, edges[1:], strict=False):
        sums = [repair._layers(kinds[a:b], s) for s in range(4)]
        costs = [-1 if x is None else c + x[0] for c, last, _ in sums for x in last]
        ranks = [-1 if x is None else x[1] for _, last, _ in sums for x in last]
        more, at, back = repair._join_chunks(at, costs, ranks)
        joined += more
        backs.append(back)
        chunks.append(sums)
        parts += 1
    assert repair._best_end(joined, at) == (total, end)
    codes, state = [], end
    for back, sums in zip(backs[::-1], chunks[::-1], strict=True):
        start = back[state][0]
        codes = repair._walk_back(sums[start][2], state)[0] + codes
        state = start
    assert codes == repair._walk_back(pointers, end)[0]


SCHEMA = "conv_id long, turn long, role string, text string, chunk long, cid string, whole string, gone int"


def _plain(rows):
    """conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, seen, kinds, blank, duplicate, truncated = [r[1:] for r in own], set(), [], 0, 0, 0
        for role, text in turns:
            words = text.strip(repair.SPACE)
            is_blank, again = not words, (role, text) in seen
            seen.add((role, text))
            cut = not is_blank and words[-1] not in ".!?"
            kinds.append((role[:1], is_blank or again, cut))
            blank += is_blank
            duplicate += again and not is_blank
            truncated += cut and not again
        at = [r[0] for r in own if r[0] is not None]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        cost, audit, kept = repair.repair(turns, kinds)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (max(at) - min(at) + 1 - len(set(at)) if at else 0, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def _rows():
    rng = random.Random(5)
    roles, texts = ["system", "user", "user", "assistant", "assistant", "tool", "", None], ["Yes.", "No!", "cut", "", " \t", None, "é?", "a.b", "ok. \n"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for c in range(40) for _ in range(rng.randrange(1, 9))]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(6)] + [(100, t, "user", f"n{t % 7}.") for t in range(300)] + [(101, 1, "user", "x" * 2_000_000)] + [(101, 1, "user", "x" * 2_000_000)] * 2
    rows += [(102, None, None, None)] * 3 + [(103, -5, "user", "a."), (103, 1 << 40, "assistant", "b.")]
    return rows


def test_awkward_conversations(spark):
    rows = _rows()
    want = _plain(rows)
    frame = spark.createDataFrame([(*r, 1, "c", "w", 2) for r in rows], SCHEMA).repartition(5)
    for size in (2, repair.CHUNK_TURNS):
        pieces = repair.repair_conversations(frame, size)
        got = repair.digest(pieces).collect()
        assert len(got) == len(want)
        assert {r["conv_id"]: tuple(r[c] for c in (*repair.COUNTS, "audit", "repaired_sha256")) for r in got} == want
    assert pieces.where("whole").count() > 0


def test_conversations_without_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.digest(repair.repair_conversations(empty)).count() == 0
    gone = spark.createDataFrame([(7, 1, "user", "a."), (8, 2, "user", "b.")], "conv_id long, turn long, role string, text string").withColumn("dropped", F.lit(True))
    for r in repair.digest(repair.repair_conversations(gone)).collect():
        assert [r[c] for c in repair.COUNTS] == [0] * 6 and r["audit"] == "" and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_damage(spark):
    from zlib import crc32

    rows = [(c, t, "assistant", "a. b! c?") for c in range(12) for t in [*range(12), None]] + [(None, 3, None, None)]
    got = sorted(((r["conv_id"], r["turn"], r["role"], r["text"], r["dropped"]) for r in repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        fault = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fault == 4 else role, "" if fault <= 1 else re.sub("[.!?]", "", text) if fault == 2 else text, fault == 0)
        want += [row] * (1 + (fault == 3))
    assert got == sorted(want, key=repr)
