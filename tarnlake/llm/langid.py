"""Language identification: a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import free_name, others, text_buffer

#: Units of a direction; more for over 64 languages, with the square root of their number.
HIDDEN = 8
#: Bytes of a segment; both directions start afresh in each. Segments that run side by side.
SEGMENT, LANES = 64, 4096
#: Bounds of the training sample: documents of each language (expected), fewer where over 100 languages share SAMPLE_TOTAL, and segments of a document.
SAMPLE_DOCS, SAMPLE_TOTAL, SAMPLE_SEGMENTS = 600, 60_000, 3
#: Every language is learned. More labels than this can't be languages, and are an error.
MAX_LANGUAGES = 2_000
STEPS, BATCH, RATE = 400, 256, 0.02
UNDETERMINED = "und"


def _soft(x: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place. The network's squashing function; a gate is half of one plus it."""
    np.abs(x, out=tmp)
    tmp += 1
    np.divide(x, tmp, out=x)
    return x


class ByteGRU:
    """Two GRUs, one from each end, and a softmax over languages at every byte.

    Weights of a direction: ``x`` (3 * hidden, 256), the bytes' share in reset gate, update gate and candidate; ``h`` (3 * hidden, hidden).
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        self.weights = {f"{k}{d}": draw(3 * hidden, n, s=s) for d in "fb" for k, n, s in (("x", 256, 0.5), ("h", hidden, 0.3))}
        self.weights |= {"o": draw(len(languages), 2 * hidden, s=0.3), "b": np.zeros((len(languages), 1), np.float32)}

    def _run(self, d: str, x: np.ndarray, keep: bool):
        """States after each step, (steps, hidden, lanes), and what backpropagation needs if ``keep``."""
        n, (steps, lanes), wx, wh = self.hidden, x.shape, self.weights[f"x{d}"], self.weights[f"h{d}"]
        states, h, tape = np.empty((steps, n, lanes), np.float32), np.zeros((n, lanes), np.float32), []
        a, u, tmp, diff = (np.empty((k * n, lanes), np.float32) for k in (3, 3, 2, 1))
        for t in range(steps):
            np.take(wx, x[t], axis=1, out=a, mode="clip")
            np.matmul(wh, h, out=u)
            gates, cand = a[: 2 * n], a[2 * n :]
            gates += u[: 2 * n]
            _soft(gates, tmp)
            gates *= 0.5
            gates += 0.5
            if keep:
                before, free = h.copy(), u[2 * n :].copy()
            u[2 * n :] *= gates[:n]
            cand += u[2 * n :]
            _soft(cand, tmp[:n])
            np.subtract(h, cand, out=diff)
            diff *= gates[n:]
            h = np.add(cand, diff, out=states[t])
            if keep:
                tape.append((before, free, a.copy()))
        return states, tape

    def _position_probabilities(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        n, w = self.hidden, self.weights
        logits = np.matmul(w["o"][:, :n], forward)
        logits += np.matmul(w["o"][:, n:], backward)
        logits += w["b"]
        logits -= logits.max(axis=-2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=-2, keepdims=True)
        return logits

    def train_step(self, x: np.ndarray, y: np.ndarray, moments: dict, step: int, rate: float = RATE) -> float:
        """One Adam step on bytes (steps, lanes) with a language index for each lane. Backpropagation runs through all steps. Returns the loss."""
        n, (steps, lanes), w = self.hidden, x.shape, self.weights
        fwd, tape_f = self._run("f", x, True)
        bwd, tape_b = self._run("b", x[::-1], True)
        p = self._position_probabilities(fwd, bwd[::-1])
        loss = float(-np.log(np.maximum(p[:, y, np.arange(lanes)], 1e-9)).mean())
        p[:, y, np.arange(lanes)] -= 1
        p /= steps * lanes
        both = np.concatenate([fwd, bwd[::-1]], axis=1)
        grads = {"o": np.einsum("tcl,thl->ch", p, both), "b": p.sum(axis=(0, 2))[:, None]}
        back = np.matmul(w["o"].T, p)
        for d, tape, out, seen in (("f", tape_f, back[:, :n], x), ("b", tape_b, back[::-1, n:], x[::-1])):
            gh, gx, carry = np.zeros_like(w[f"h{d}"]), np.empty((steps, 3 * n, lanes), np.float32), np.zeros((n, lanes), np.float32)
            for t in reversed(range(steps)):
                before, free, a = tape[t]
                r, z, c = a[:n], a[n : 2 * n], a[2 * n :]
                dh = carry + out[t]
                dc = dh * (1 - z) * (1 - np.abs(c)) ** 2
                g = np.concatenate([dc * free, dh * (before - c)])
                g *= 0.5 * (1 - np.abs(2 * a[: 2 * n] - 1)) ** 2
                gx[t, : 2 * n], gx[t, 2 * n :] = g, dc
                g = np.concatenate([g, dc * r])
                gh += g @ before.T
                carry = dh * z + w[f"h{d}"].T @ g
            flat = seen.ravel()
            grads[f"h{d}"], grads[f"x{d}"] = gh, np.stack([np.bincount(flat, gx[:, k].ravel(), 256) for k in range(3 * n)]).astype(np.float32)
        for k, g in grads.items():
            m, v = moments.setdefault(k, (np.zeros_like(w[k]), np.zeros_like(w[k])))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return loss

    def fit(self, segments: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 11) -> ByteGRU:
        """Train on rows of bytes (rows, segment). Languages are drawn equally often."""
        rng, moments = np.random.default_rng(seed), {}
        by = [np.flatnonzero(labels == i) for i in range(len(self.languages))]
        by = [b for b in by if len(b)]
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(b, -(-batch // len(by))) for b in by])
            self.train_step(np.ascontiguousarray(segments[rows].T).astype(np.intp), labels[rows], moments, step, RATE * min(1.0, 2 * (1 - step / (steps + 1))))
        return self

    def text_probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, languages): the mean over all bytes of a text of their probabilities. Rows of empty texts are zero."""
        size = np.diff(offsets)
        parts = -(-size // SEGMENT)
        text = np.repeat(np.arange(len(size)), parts)
        part = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = offsets[:-1][text] + part * SEGMENT
        stop = np.minimum(start + SEGMENT, offsets[1:][text])
        begin = np.maximum(stop - SEGMENT, offsets[:-1][text])  # the last segment of a text reaches back, and counts its new bytes only
        out = np.zeros((len(size), len(self.languages)))
        for i in range(0, len(text), LANES):
            b, lo, hi = begin[i : i + LANES], (start - begin)[i : i + LANES], (stop - begin)[i : i + LANES]
            x = np.empty((SEGMENT, len(b)), np.intp)
            for t in range(SEGMENT):
                x[t] = data[np.minimum(b + t, len(data) - 1)]
                x[t] *= t < hi
            fwd, bwd = self._run("f", x, False)[0], self._run("b", x[::-1], False)[0]
            pooled = np.zeros((len(self.languages), len(b)), np.float32)
            for t in range(SEGMENT):
                p = self._position_probabilities(fwd[t], bwd[SEGMENT - 1 - t])
                p *= (lo <= t) & (t < hi)
                pooled += p
            for k in range(len(self.languages)):
                out[:, k] += np.bincount(text[i : i + LANES], pooled[k], len(size))
        return out / np.maximum(size, 1)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame) -> ByteGRU | None:
    """A network that learned the languages of ``docs`` from a bounded sample of its rows that aren't held out; None if no such row has a language.

    The sample: up to SAMPLE_DOCS distinct texts of each language (SAMPLE_TOTAL of all, if that is less), picked by a hash of the text whatever the ids are, and one at least; SAMPLE_SEGMENTS segments
    from evenly spaced places of each text.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").alias("y"), F.col("text").cast("string").alias("text"))
    known = known.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(3), "text"), 1))
    counts = known.groupBy("y").agg(F.count(F.lit(1)).alias("count"), F.min("h").alias("least")).limit(MAX_LANGUAGES + 1).collect()
    if not counts:
        return None
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages; is lang a language?")
    each = min(SAMPLE_DOCS, SAMPLE_TOTAL // len(counts))
    # Twice as many as wanted pass by hash, and always the least hash; of those the least stay.
    upto = [(r["y"], max(r["least"], min((1 << 63) - 1, (2 * each << 63) // r["count"]))) for r in counts]
    sample = known.join(F.broadcast(docs.sparkSession.createDataFrame(upto, known.select("y", F.col("h").alias("upto")).schema)), "y").where(F.col("h") <= F.col("upto"))
    b = F.col("text").cast("binary")
    places = F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_SEGMENTS - 1)), lambda i: F.substring(b, F.floor(i * F.greatest(F.length(b) - SEGMENT, F.lit(0)) / SAMPLE_SEGMENTS).cast("int") + 1, F.lit(SEGMENT)))
    distinct = sample.select("y", "h", places.alias("s")).groupBy("y", "h").agg(F.first("s").alias("s"))
    ranked = distinct.withColumn("at", F.row_number().over(Window.partitionBy("y").orderBy("h")))
    rows = ranked.where(F.col("at") <= each).orderBy("h", "y").collect()
    languages = sorted(r["y"] for r in counts)
    place = {y: i for i, y in enumerate(languages)}
    pairs = [(bytes(s), place[r["y"]]) for r in rows for s in dict.fromkeys(map(bytes, r["s"])) if s]
    segments = np.array([np.frombuffer(s.ljust(SEGMENT, b"\0"), np.uint8) for s, _ in pairs]).reshape(-1, SEGMENT)
    return ByteGRU(languages, max(HIDDEN, 2 * math.isqrt(len(languages)) - HIDDEN)).fit(segments, np.array([y for _, y in pairs])) if pairs else None


def identify(docs: DataFrame, model: ByteGRU | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text alone.

    Null text, text without a letter, and any text where there was nothing to learn from: ``und`` with score 0. Repeated rows get equal
    results; other columns pass through, but for any of these two names.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.col(f"`{c}`") for c in others(docs, "lang_pred", "score")])
    text, letter = free_name(docs, "_text"), free_name(docs, "_letter")
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        model = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(batch.num_columns - 2))
            ok = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool) & (model is not None)
            names, scores = np.full(len(ok), UNDETERMINED, dtype=object), np.zeros(len(ok))
            if ok.any():
                p = model.text_probabilities(data, offsets)
                names[ok] = np.array(model.languages, dtype=object)[p.argmax(axis=1)][ok]
                scores[ok] = np.minimum(p.max(axis=1), 1.0)[ok]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(names, pa.string()), pa.array(scores)], names=[*batch.schema.names[:-2], "lang_pred", "score"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields)
    return docs.withColumn(text, F.col("text").cast("string")).withColumn(letter, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, f"{fields}lang_pred string, score double")
