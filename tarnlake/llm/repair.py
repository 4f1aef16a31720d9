"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

A turn is kept, given the role user or assistant, or deleted, and turns may be inserted anywhere. A run of inserts and the edit of the turn after it are one macro edit, whose code is a run of ``I`` and one of ``D``,
``K`` and ``R``. No code is a prefix of another, so audits of equally many turns compare code by code. The dynamic program keeps for each role state of a layer the least cost, the rank of its audit among the layer's
and a pointer to the state before; audits are written out only once the last layer is done. A layer is a handful of small numbers, so layers are shared between conversations.

A stretch of turns is summed up by 16 costs and ranks, from each state to each. So a conversation of any length is cut into chunks that tasks work on apart, and only sums are brought together.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import row_key, stage

#: White space, and what ends a sentence.
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
RELABEL, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: A chunk ends at so many turns or characters of text.
CHUNK_TURNS, CHUNK_TEXT = 4_096, 1 << 20
#: What a turn's text is.
BLANK, WHOLE, TRUNCATED = 0, 1, 2
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

#: States are the initial of the last role so far; none at the start. What may follow each, and the inserts that end a conversation in it.
STATES = ("", "s", "u", "a")
AFTER = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
CLOSING = {"": 0, "s": 2, "u": 1, "a": 0}
NAMES = {"u": "user", "a": "assistant"}
_AT = {s: i for i, s in enumerate(STATES)}


def _inserted(state: str) -> str:
    """The initial of the turn that an insert puts after ``state``. Its role is given, as is that of a relabelled turn."""
    return AFTER[state][-1]


@lru_cache(None)
def _macros(kind: tuple) -> tuple[tuple[int, str, int, int], ...]:
    """``(state before, code, state after, cost)`` of every macro edit of a turn of this kind: its role's initial, whether it must go, and whether it is cut off."""
    initial, must_go, cut_off = kind
    out = []
    for before in STATES:
        state = before
        for run in range(3):  # a third insert comes back to a state that fewer reach
            code, cost = "I" * run, INSERT * run
            out.append((_AT[before], f"{code}D", _AT[state], cost + DELETE))
            if not must_go:
                if initial in AFTER[state]:
                    out.append((_AT[before], f"{code}K", _AT[initial], cost + CUT_OFF * cut_off))
                out.append((_AT[before], f"{code}R", _AT[_inserted(state)], cost + RELABEL + CUT_OFF * cut_off))
            state = _inserted(state)
    return tuple(out)


def _ranked(ways: dict[int, tuple]) -> tuple[int, tuple, tuple]:
    """``ways``: for each state the least (cost, rank before, code or rank after, state before). The least cost, the layer relative to it, and (state before, code) of each state."""
    least = min(w[0] for w in ways.values())
    order = {s: i for i, s in enumerate(sorted(ways, key=lambda s: ways[s][1:3]))}
    layer = tuple((ways[s][0] - least, order[s]) if s in ways else None for s in range(len(STATES)))
    return least, layer, tuple((ways[s][3], ways[s][2]) if s in ways else None for s in range(len(STATES)))


@lru_cache(1 << 16)
def _step(layer: tuple, kind: tuple) -> tuple[int, tuple, tuple]:
    ways: dict[int, tuple] = {}
    for before, code, after, cost in _macros(kind):
        if layer[before] is not None:
            way = (layer[before][0] + cost, layer[before][1], code, before)
            if after not in ways or way < ways[after]:
                ways[after] = way
    return _ranked(ways)


def _first(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in range(len(STATES)))


def _layers(kinds: list[tuple], start: int) -> tuple[int, tuple, list[tuple]]:
    """The cost so far, the last layer relative to it, and each layer's pointers."""
    cost, layer, pointers = 0, _first(start), []
    for kind in kinds:
        more, layer, back = _step(layer, kind)
        cost += more
        pointers.append(back)
    return cost, layer, pointers


def _walk_back(pointers: list[tuple], end: int) -> tuple[list[str], int]:
    """The macro edits that lead to the state ``end``, and the state that they start from."""
    codes = []
    for back in reversed(pointers):
        end, code = back[end]
        codes.append(code)
    return codes[::-1], end


def _best_end(cost: int, layer: tuple) -> tuple[int, int]:
    """The least cost of a whole conversation and the state that it ends in."""
    return min((cost + x[0] + INSERT * CLOSING[STATES[s]], x[1], s) for s, x in enumerate(layer) if x is not None)[::2]


def _applied(codes: list[str], turns: list[tuple[str, str]], start: int, closing: bool) -> tuple[str, list[tuple[str, str]]]:
    """The audit and the repaired turns (role, text)."""
    state, out, audit = STATES[start], [], "".join(codes)

    def insert():
        nonlocal state
        state = _inserted(state)
        out.append((NAMES[state], ""))

    for code, (role, text) in zip(codes, turns, strict=True):
        for _ in code[:-1]:
            insert()
        if code[-1] == "K":
            state = role[0]
            out.append((role, text))
        elif code[-1] == "R":
            state = _inserted(state)
            out.append((NAMES[state], text))
    if closing:
        more = CLOSING[state]
        audit += "I" * more
        for _ in range(more):
            insert()
    return audit, out


def repair(turns: list[tuple[str, str]], kinds: list[tuple]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, audit and repaired turns of one conversation held in memory. ``kinds``: as in :func:`_macros`."""
    cost, layer, pointers = _layers(kinds, 0)
    total, end = _best_end(cost, layer)
    codes, _ = _walk_back(pointers, end)
    return total, *_applied(codes, turns, 0, True)


class _Stretch:
    """Turns of one conversation in order, and what is counted over them."""

    def __init__(self, conv):
        self.conv, self.turns, self.fits, self.numbers, self.size = conv, [], [], [], 0

    def add(self, turn, role, text, fit) -> None:
        self.turns.append((role, text))
        self.fits.append(fit)
        if turn is not None and (not self.numbers or self.numbers[-1] != turn):
            self.numbers.append(turn)
        self.size += len(text)

    def kinds(self, repeated) -> list[tuple]:
        return [(role[:1], fit == BLANK or i in repeated, fit == TRUNCATED) for i, ((role, _), fit) in enumerate(zip(self.turns, self.fits, strict=True))]

    def repeated(self) -> set[int]:
        seen: set = set()
        return {i for i, x in enumerate(self.turns) if x in seen or seen.add(x)}


def _faults(kinds: list[tuple], fits) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated turns, each counted once by its first fault, and neighbours whose roles may not meet."""
    blank = sum(f == BLANK for f in fits)
    duplicate = sum(k[1] for k in kinds) - blank
    truncated = sum(k[2] and not k[1] for k in kinds)
    return blank, duplicate, truncated, sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False))


def _gaps(low, high, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


_TURNS = "array<struct<role: string, text: string>>"
_PIECE = f"conv_id {{conv}}, chunk long, whole boolean, audit string, repaired {_TURNS}, " + ", ".join(f"{c} long" for c in COUNTS)


def _cut(names: list[str], chunk_turns: int):
    """Sorted turns into whole conversations, repaired, and chunks of those that another task may have turns of, or that are long."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId() << 32, 0
        current, opened, first = None, False, True
        rows: list[dict] = []

        def end(open_: bool) -> dict:
            nonlocal made
            made += 1
            x = current
            row = dict.fromkeys(names) | {"conv_id": x.conv, "chunk": task + made, "whole": not open_}
            if open_:
                n = x.numbers
                return row | {"turns": [{"role": r, "text": t} for r, t in x.turns], "fits": bytes(x.fits), "low": n[0] if n else None, "high": n[-1] if n else None, "numbers": len(n)}
            kinds = x.kinds(x.repeated())
            cost, audit, out = repair(x.turns, kinds)
            n = x.numbers
            return row | dict(zip(COUNTS, (_gaps(n[0] if n else None, n[-1] if n else None, len(n)), *_faults(kinds, x.fits), cost), strict=True)) | {"audit": audit, "repaired": [{"role": r, "text": t} for r, t in out]}

        def flush():
            nonlocal rows
            done, rows = rows, []
            return pa.Table.from_pylist(done, schema=schema).combine_chunks().to_batches()

        schema, held = None, 0
        for batch in batches:
            if schema is None:
                turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
                kinds = {"conv_id": batch.schema.field(0).type, "whole": pa.bool_(), "audit": pa.string(), "repaired": turn, "turns": turn, "fits": pa.binary()}
                schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])
            for conv, turn, role, text, fit, dropped in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if current is None or conv != current.conv:
                    if current is not None:
                        held += current.size
                        rows.append(end(opened or first))
                        first = False
                    current, opened = _Stretch(conv), False
                elif len(current.turns) >= chunk_turns or current.size >= CHUNK_TEXT:
                    held += current.size
                    rows.append(end(True))
                    current, opened = _Stretch(conv), True
                if held >= 4 * CHUNK_TEXT or len(rows) >= CHUNK_TURNS:
                    yield from flush()
                    held = 0
                if not dropped:
                    current.add(turn, role, text, fit)
        if current is not None:
            rows.append(end(True))
            yield from flush()

    return run


def _sums(batches):
    """A chunk's costs and ranks from each state to each, its faults, and the initials at its ends."""
    import pyarrow as pa

    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("costs", "ranks", "blank", "duplicate", "truncated", "illegal", "ends")}
        for initials, fits, gone in zip(*[c.to_pylist() for c in batch.columns[-3:]], strict=True):
            gone = set(gone or ())
            kinds = [(r, f == BLANK or i in gone, f == TRUNCATED) for i, (r, f) in enumerate(zip(initials, fits, strict=True))]
            costs, ranks = [], []
            for start in range(len(STATES)):
                cost, layer, _ = _layers(kinds, start)
                costs += [-1 if x is None else cost + x[0] for x in layer]
                ranks += [-1 if x is None else x[1] for x in layer]
            for name, value in zip(out, (costs, ranks, *_faults(kinds, fits), [kinds[0][0], kinds[-1][0]] if kinds else []), strict=True):
                out[name].append(value)
        kept = batch.schema.names[:-3]
        longs = pa.list_(pa.int64())
        arrays = [pa.array(out["costs"], longs), pa.array(out["ranks"], longs), *[pa.array(out[n], pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")], pa.array(out["ends"], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *arrays], names=[*kept, *out])


def _join_chunks(layer: tuple, costs: list[int], ranks: list[int]) -> tuple[int, tuple, tuple]:
    """The layer after one more chunk: as :func:`_step`, with the chunk's sums for macro edits."""
    ways: dict[int, tuple] = {}
    for before, x in enumerate(layer):
        if x is not None:
            for after in range(len(STATES)):
                if costs[4 * before + after] >= 0:
                    way = (x[0] + costs[4 * before + after], x[1], ranks[4 * before + after], before)
                    if after not in ways or way < ways[after]:
                        ways[after] = way
    return _ranked(ways)


def _routes(batches):
    """From a conversation's chunks in order: the states between which each runs in the best repair, and on its last chunk what is counted over all."""
    import pyarrow as pa

    names = ["chunk", "start", "end", "last", *COUNTS]
    kinds = {"last": pa.bool_(), "start": pa.int32(), "end": pa.int32()}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])

    def finish():
        total, end = _best_end(cost, layer)
        states = [end]
        for back in reversed(pointers):
            states.append(back[states[-1]][0])
        states.reverse()
        out = {"chunk": chunks, "start": states[:-1], "end": states[1:], "last": [False] * (len(chunks) - 1) + [True]}
        for c, v in zip(COUNTS, (_gaps(low, high, distinct), *faults, total), strict=True):
            out[c] = [None] * (len(chunks) - 1) + [v]
        return pa.RecordBatch.from_pydict(out, schema=schema)

    current, chunks = None, []
    for batch in batches:
        for x in batch.to_pylist():
            if x["cid"] != current:
                if chunks:
                    yield finish()
                current, chunks, pointers, layer, cost = x["cid"], [], [], _first(0), 0
                faults, low, high, distinct, last = [0] * 4, None, None, 0, None
            more, layer, back = _join_chunks(layer, x["costs"], x["ranks"])
            cost += more
            chunks.append(x["chunk"])
            pointers.append(back)
            faults = [a + x[c] for a, c in zip(faults, COUNTS[1:5], strict=True)]
            if x["ends"]:
                if last is not None:
                    faults[3] += last + x["ends"][0] not in ("su", "ua", "au")
                last = x["ends"][1]
            if x["low"] is not None:
                distinct += x["numbers"] - (high == x["low"])
                low, high = x["low"] if low is None else low, x["high"]
    if chunks:
        yield finish()


def _pieces(batches):
    """Each chunk's part of the audit and of the repaired turns."""
    import pyarrow as pa

    for batch in batches:
        audits, repaired = [], []
        for turns, fits, gone, start, end, last in zip(*[c.to_pylist() for c in batch.columns[-6:]], strict=True):
            gone, turns = set(gone or ()), [(t["role"], t["text"]) for t in turns]
            kinds = [(r[:1], f == BLANK or i in gone, f == TRUNCATED) for i, ((r, _), f) in enumerate(zip(turns, fits, strict=True))]
            codes, _ = _walk_back(_layers(kinds, start)[2], end)
            audit, out = _applied(codes, turns, start, last)
            audits.append(audit)
            repaired.append([{"role": r, "text": t} for r, t in out])
        kept = batch.columns[:-6]
        turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays([*kept, pa.array(audits, pa.string()), pa.array(repaired, turn)], names=[*batch.schema.names[:-6], "audit", "repaired"])


def _cid(conv: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("v"), F.col(conv).cast("string")), F.lit("n"))


def damage(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped)``: turns damaged by crc32(``conv_id:turn``) % 20, null cells as one space.

    0: ``dropped``, which only keeps the conversation's id; 1: the text is emptied; 2: it loses its ``[.!?]``; 3: the turn comes twice; 4: its role is user. More columns are ignored.
    """
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), cell("role").alias("role"), cell("text").alias("text"), (F.crc32(F.concat(cell("conv_id"), F.lit(":"), cell("turn")).cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") <= 1, "").when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") == 0).alias("dropped"), copies.alias("copy")).drop("copy")


def repair_conversations(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """Repairs every conversation of ``(conv_id, turn, role, text)``; rows marked in an optional boolean column ``dropped`` only name their conversation.

    Turns follow ``turn`` (null first), then role and text. Returns pieces ``(conv_id, chunk, whole, audit, repaired, gaps, blank, duplicate, truncated, illegal, cost)``: ``audit`` is the cheapest edits, ``repaired`` the
    turns (role, text) that they leave. A conversation is one ``whole`` piece, or several that follow each other by ``chunk``, the last with the counts, which are null on the others: long ones are, and those at the
    edges of tasks. Roles end up as ``(s?(ua)+)?`` in initials; of audits of one cost the least in ASCII order is taken. Null role or text is one space, and so a blank turn. A null conv_id is a conversation of its
    own. Without turns all counts are 0. ``gaps`` stops at 2^63 - 1. More columns are ignored.
    """
    conv = turns.schema["conv_id"].dataType.simpleString()
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), cell("role").alias("role"), cell("text").alias("text"), dropped.alias("dropped"))
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    rows = rows.select("conv_id", "turn", "role", "text", F.when(last == "", BLANK).when(last.isin(*ENDS), WHOLE).otherwise(TRUNCATED).alias("fit"), "dropped")
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 16)).sortWithinPartitions("conv_id", "turn", "role", "text")
    fields = _PIECE.format(conv=conv) + f", turns {_TURNS}, fits binary, low long, high long, numbers long"
    cut = stage(dealt.mapInArrow(_cut([f.split()[0] for f in ("conv_id", "chunk", "whole", "audit", "repaired", *COUNTS, "turns", "fits", "low", "high", "numbers")], chunk_turns), fields), "repair-chunks")
    names = ["conv_id", "chunk", "whole", "audit", "repaired", *COUNTS]
    parts = cut.where(~F.col("whole"))

    items = parts.select(_cid().alias("cid"), "chunk", F.posexplode("turns").alias("i", "t")).select("cid", "chunk", "i", row_key(F.col("t.role"), F.col("t.text")).alias("key"))
    place = F.struct("chunk", "i")
    firsts = items.groupBy("cid", "key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    gone = stage(items.join(firsts, ["cid", "key"]).where(place > F.col("first")).groupBy("chunk").agg(F.collect_set("i").alias("gone")), "repair-repeats")

    small = parts.select("chunk", _cid().alias("cid"), "low", "high", "numbers", F.transform("turns", lambda t: F.substring(t["role"], 1, 1)).alias("initials"), "fits")
    small = small.join(gone, "chunk", "left").select("cid", "chunk", "low", "high", "numbers", "initials", "fits", "gone")
    sums = small.mapInArrow(_sums, "cid string, chunk long, low long, high long, numbers long, costs array<long>, ranks array<long>, blank long, duplicate long, truncated long, illegal long, ends array<string>")
    sums = sums.repartition("cid").sortWithinPartitions("cid", "chunk")
    routes = stage(sums.mapInArrow(_routes, "chunk long, start int, end int, last boolean, " + ", ".join(f"{c} long" for c in COUNTS)), "repair-routes")

    joined = parts.select("conv_id", "chunk", "turns", "fits").join(routes, "chunk").join(gone, "chunk", "left")
    joined = joined.select("conv_id", "chunk", *COUNTS, "turns", "fits", "gone", "start", "end", "last")
    pieces = joined.mapInArrow(_pieces, f"conv_id {conv}, chunk long, " + ", ".join(f"{c} long" for c in COUNTS) + f", audit string, repaired {_TURNS}")
    return cut.where("whole").select(*names).unionByName(pieces.withColumn("whole", F.lit(False)).select(*names))


def _digest(counts: int):
    """One row per conversation from its pieces in order. Texts pass one hash function piece by piece and are not gathered."""

    def run(batches):
        import pyarrow as pa

        schema, row, key = None, None, None
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(1), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for cid, conv, audit, text, empty, *numbers in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row is None or cid != key:
                    if row is not None:
                        yield finish(row, schema)
                    row, key = {"conv": conv, "audit": [], "sha": hashlib.sha256(), "any": False, "counts": [None] * counts}, cid
                row["audit"].append(audit)
                if not empty:
                    row["sha"].update(("\n" * row["any"] + text).encode())
                    row["any"] = True
                if numbers[0] is not None:
                    row["counts"] = numbers
        if row is not None:
            yield finish(row, schema)

    def finish(row, schema):
        import pyarrow as pa

        cells = [row["conv"], *row["counts"], "".join(row["audit"]), row["sha"].hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(cells, schema, strict=True)], schema=schema)

    return run


def digest(pieces: DataFrame) -> DataFrame:
    """One row per conversation from :func:`repair_conversations`: conv_id, the counts, the whole audit, and the SHA-256 of the repaired ``role:text``, joined by newlines."""
    conv = pieces.schema["conv_id"].dataType.simpleString()
    text = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.where("whole").select("conv_id", *COUNTS, "audit", F.sha2(text.cast("binary"), 256).alias("repaired_sha256"))
    parts = pieces.where("not whole").select(_cid().alias("cid"), "conv_id", "chunk", "audit", text.alias("text"), (F.size("repaired") == 0).alias("empty"), *COUNTS)
    parts = parts.repartition("cid").sortWithinPartitions("cid", "chunk").select("cid", "conv_id", "audit", "text", "empty", *COUNTS)
    fields = f"conv_id {conv}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return whole.unionByName(parts.mapInArrow(_digest(len(COUNTS)), fields))
