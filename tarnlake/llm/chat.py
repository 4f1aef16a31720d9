"""Preference formatting of chat pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers of the chat template.
START, END = "<|im_start|>", "<|im_end|>"

IGNORED = -100


def _head(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(f"{END}\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _segments(turns: Column) -> Column:
    """Pieces of a completion in order, each with whether a model learns from it: what an assistant says and its end marker."""
    return F.flatten(
        F.transform(turns, lambda t: F.array(F.struct(_head(t).alias("text"), F.lit(False).alias("learn")), F.struct(_body(t).alias("text"), (t["role"] == "assistant").alias("learn"))))
    )


def format_preferences(turns: DataFrame) -> DataFrame:
    """One row per pair from rows (pair_id, rejected boolean, turn, role, text); more columns are ignored.

    The longest common prefix of turns, equal in role and text, is rendered once as ``prompt``; what follows on either side is a completion,
    as text and as segments with their loss mask. Within a side, rows follow turn (null first), then role and text; repeated rows count
    once; null role or text is empty. A missing side is an empty completion with no common prefix. Rows with a null pair_id or side belong to no pair.
    """
    cell = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sides = (
        turns.where(F.col("pair_id").isNotNull() & F.col("rejected").isNotNull())
        .groupBy("pair_id")
        .agg(*[F.array_sort(F.collect_set(F.when(F.col("rejected") == bad, cell))).alias(name) for name, bad in (("c", False), ("r", True))])
    )
    sides = sides.select("pair_id", *[F.transform(x, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(x) for x in ("c", "r")])
    shorter = F.least(F.size("c"), F.size("r"))
    common = F.when(shorter > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(shorter, F.lit(1))), F.lit(0), lambda n, i: F.when((n == i - 1) & (F.element_at("c", i) == F.element_at("r", i)), i).otherwise(n))).otherwise(0)
    rest = lambda x: F.slice(x, F.col("n_prompt_turns") + 1, F.greatest(F.size(x) - F.col("n_prompt_turns"), F.lit(0)))
    out = sides.withColumn("n_prompt_turns", common)
    out = out.select("pair_id", "n_prompt_turns", _rendered(F.slice("c", 1, F.col("n_prompt_turns"))).alias("prompt"), rest("c").alias("c"), rest("r").alias("r"))
    return out.select(
        "pair_id",
        "n_prompt_turns",
        "prompt",
        *[F.size(x).alias(f"n_{name}_turns") for x, name in (("c", "chosen"), ("r", "rejected"))],
        *[_rendered(F.col(x)).alias(name) for x, name in (("c", "chosen"), ("r", "rejected"))],
        *[_segments(F.col(x)).alias(f"{name}_segments") for x, name in (("c", "chosen"), ("r", "rejected"))],
    )


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True
    return out


def tokenize_preferences(pairs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Adds ``chosen_ids``, ``chosen_labels``, ``rejected_ids`` and ``rejected_labels``: prompt and completion in ids of the given tokenizer.

    Labels repeat the ids where the mask has a model learn, and are -100 elsewhere, the whole prompt included. Segments are encoded one by
    one, so no token spans a mask's edge. ``tokenizer_file`` must be readable on every executor.
    """

    def encode(batches):
        import pyarrow as pa

        tokenizer = _tokenizer(tokenizer_file)
        ids = lambda texts: [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        for batch in batches:
            prompts = ids([x or "" for x in batch.column("prompt").to_pylist()])
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for side in ("chosen", "rejected"):
                segments = batch.column(f"{side}_segments").to_pylist()
                flat = iter(ids([s["text"] for x in segments for s in x]))
                full, labels = [], []
                for prompt, x in zip(prompts, segments, strict=True):
                    a, b = list(prompt), [IGNORED] * len(prompt)
                    for s in x:
                        piece = next(flat)
                        a += piece
                        b += piece if s["learn"] else [IGNORED] * len(piece)
                    full.append(a)
                    labels.append(b)
                columns[f"{side}_ids"], columns[f"{side}_labels"] = (pa.array(x, pa.list_(pa.int32())) for x in (full, labels))
            yield pa.RecordBatch.from_pydict(columns)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return pairs.mapInArrow(encode, fields + "".join(f", {side}_{x} array<int>" for side in ("chosen", "rejected") for x in ("ids", "labels")))


def mask_spans(segments: Column) -> Column:
    """A completion's loss mask as text: the characters of each segment, with ``+`` before those that a model learns from."""
    return F.array_join(F.transform(segments, lambda s: F.concat(F.when(s["learn"], "+").otherwise(""), F.length(s["text"]).cast("string"))), " ")
