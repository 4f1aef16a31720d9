"""Language-model scoring: a causal self-attention model over subword ids, beside an exact word unigram.

The model learns from every training row. Subword counts and counts of neighbouring subwords cover the whole training corpus and are its starting point; the attention network, which corrects
them by what stands before, is trained on every window of every file of texts, in rounds of local steps whose weights are averaged.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.batches import TextBatch, bucket_cells, buckets_for, from_planes, to_planes, write_batches
from tarnlake.llm.common import fold_case, scan_words, stage, word_hashes

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Words for BPE: what white space leaves, each after a blank.
_PIECES = r"\s?\S+|\s+"
#: What such a cut may part a word at, beside the blanks between words that are encoded together; and how many of these are.
_ODD, _TOGETHER = re.compile(r"[^\S ]"), 1000
#: Words whose ids a Python worker remembers.
KNOWN = 1 << 20
#: Window of the model, and tokens of it that are scored.
WINDOW, STRIDE = 32, 24
#: Sizes of the network; classes of the next token, symbols for frequent tokens, and symbols (each a class, too) that the other tokens share.
WIDTH, INNER, CLASSES, SYMBOLS, SHARED = 16, 32, 64, 2048, 4
#: Weight, in tokens, of what a symbol or class says of the next token without regard to the one before.
PRIOR = 5.0
#: Files and steps that the first round takes, only to start from. The rounds after it, one at each of these rates, share out all windows of every file, in steps of BATCH windows; small files make STEPS steps a round.
WARM_FILES, WARM_STEPS, WARM_RATE = 4, 300, 0.04
STEPS, BATCH, RATES = 40, 64, (0.03, 0.02, 0.012, 0.006)
_LANES = 96
_LN10 = float(np.log(10))


class Tokenizer:
    """A public byte-level BPE file. The id after the last one ends a text."""

    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("file", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for piece, i in ranks.items() if b" " in piece]] = True

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has. No word holds a blank.

        Words are encoded many at a time, parted by blanks: only the first token of a word has one. A word with white space beyond ASCII, at which the pattern may cut another way beside others, is encoded by itself.
        """
        parts, at = [], 0
        odd = [i for i, w in enumerate(words) if _ODD.search(w)] if _ODD.search(" ".join(words)) else []
        for i in [*odd, len(words)]:
            for j in range(at, i, _TOGETHER):
                parts.append(self.encoding.encode_ordinary(" " + " ".join(words[j : min(j + _TOGETHER, i)])))
            if i < len(words):
                parts.append(self.encoding.encode_ordinary(" " + words[i]))
            at = i + 1
        ids = np.fromiter(itertools.chain.from_iterable(parts), np.int32)
        return ids, np.diff(np.flatnonzero(np.append(self.opens[ids], True)))


class _Known:
    """Ids of words that were encoded before, by the words' hashes, so that files that share words encode each once. It stops taking words at KNOWN."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer(path)
        self.hashes, self.begin, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def ids(self, words: _Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a file's distinct words one after another, and how many each has."""
        at = np.searchsorted(self.hashes, words.distinct)
        old = at < len(self.hashes)
        old[old] = self.hashes[at[old]] == words.distinct[old]
        new = np.flatnonzero(~old)
        ids, size = self.tokenizer.words(words.texts(new))
        pool = np.concatenate([self.pool, ids])
        begin, sizes = np.empty((2, len(old)), np.int64)
        begin[old], sizes[old] = self.begin[at[old]], self.size[at[old]]
        begin[new], sizes[new] = len(self.pool) + np.cumsum(size) - size, size
        if len(new) and len(self.hashes) + len(new) <= KNOWN:
            self.hashes, self.begin, self.size = (np.insert(x, at[new], y[new]) for x, y in ((self.hashes, words.distinct), (self.begin, begin), (self.size, sizes)))
            self.pool = pool
        return pool[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())], sizes


@functools.lru_cache(1)
def _known(path: str) -> _Known:
    return _Known(path)


class Symbols:
    """What the network reads and predicts: the most frequent tokens are symbols of their own, the others share a few by frequency.

    Symbols fall into classes by the symbols that stand next to them; a token is scored as class given the context, times symbol given class and the symbol before, times token
    given symbol. Tables of pairs are counts over the whole training corpus.
    """

    def __init__(self, counts: np.ndarray, size: int = SYMBOLS, shared: int = SHARED):
        by = np.lexsort((np.arange(len(counts)), -counts))
        self.own, rest = min(size, len(by)), by[size:]
        self.of = np.empty(len(counts), np.int64)
        self.of[by[: self.own]] = np.arange(self.own)
        mass = np.cumsum(counts[rest] + 0.5)
        share = (mass - (counts[rest] + 0.5) / 2) / mass[-1] if len(rest) else mass
        self.of[rest] = self.own + np.minimum((share * shared).astype(np.int64), shared - 1)
        self.shared, self.n = shared, self.own + shared
        self.start = self.n
        whole = np.bincount(self.of, counts + 0.5, self.n)
        self.within = np.where(self.of < self.own, 0.0, np.log((counts + 0.5) / whole[self.of]))

    def before(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The symbol before each; the start symbol before a text's first."""
        out = np.empty_like(symbols)
        out[1:] = symbols[:-1]
        out[first[:-1]] = self.start
        return out

    def pairs(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Counts of (symbol before, symbol), flat."""
        symbols = self.of[tokens]
        return np.bincount(self.before(symbols, first) * self.n + symbols, minlength=(self.n + 1) * self.n)

    def _classes(self, m: np.ndarray, classes: int, dims: int = 24, rounds: int = 12, seed: int = 0) -> np.ndarray:
        """A class for each symbol: centres among the largest principal parts of what symbols have before and after them."""
        m = m[: self.own, : self.own]
        after, before = (np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1)) for x in (m, m.T))
        f = np.hstack([after, before])
        x = f @ np.random.default_rng(seed).standard_normal((f.shape[1], 2 * dims)).astype(np.float32)
        for _ in range(2):
            x = f @ (f.T @ np.linalg.qr(x)[0])
        q = np.linalg.qr(x)[0]
        u, s, _ = np.linalg.svd(q.T @ f, full_matrices=False)
        place = (q @ u)[:, :dims] * s[:dims]
        weight = m.sum(axis=0) + m.sum(axis=1) + 1e-3
        centres = place[np.argsort(-weight, kind="stable")[: classes - self.shared]].copy()
        for _ in range(rounds):
            near = (np.square(centres).sum(axis=1) - 2 * place @ centres.T).argmin(axis=1)
            for k in np.unique(near):
                centres[k] = np.average(place[near == k], axis=0, weights=weight[near == k])
        return near

    def learn(self, pairs: np.ndarray, classes: int = CLASSES, prior: float = PRIOR) -> Symbols:
        """Classes, and logarithms of class given the symbol before and of symbol given that and its class."""
        m = pairs.reshape(self.n + 1, self.n).astype(np.float32)
        self.classes = classes
        self.class_of = np.concatenate([self._classes(m, classes), np.arange(classes - self.shared, classes)])
        member = np.zeros((self.n, classes), np.float32)
        member[np.arange(self.n), self.class_of] = 1
        total = m.sum(axis=0, dtype=np.float64) + 0.5
        by_class = m @ member
        share = total @ member
        # A class that no symbol fell into has a floor in place of no probability.
        self.class_table = np.log(np.maximum((by_class + prior * share / share.sum()) / (by_class.sum(axis=1, keepdims=True) + prior), 1e-20)).astype(np.float32)
        m += (prior * total / share[self.class_of]).astype(np.float32)
        m /= by_class[:, self.class_of] + np.float32(prior)
        self.table = np.log(m, out=m).ravel()
        return self


class Attention:
    """One causal self-attention head and a small feed-forward layer, correcting what the symbol before says of the next token's class."""

    def __init__(self, symbols: Symbols, seed: int = 5):
        rng, d = np.random.default_rng(seed), WIDTH
        self.symbols = symbols
        draw = lambda *shape, s=0.3: (rng.standard_normal(shape) * s).astype(np.float32)
        self.weights = {"e": draw(symbols.n + 1, d, s=0.5), "p": draw(WINDOW, d, s=0.1), "qkv": draw(d, 3 * d), "o": draw(d, d), "in": draw(d, INNER), "bi": np.zeros(INNER, np.float32), "out": draw(INNER, d), "u": draw(d, symbols.classes, s=0.05), "bu": np.zeros(symbols.classes, np.float32)}
        self.ones = np.ones(max(WINDOW, symbols.classes), np.float32)
        self.cells = np.arange((symbols.n + 1) * d).reshape(-1, d)
        self.zeros = np.zeros((INNER, 1), np.float32)
        self.causal = np.tri(WINDOW, dtype=np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def set_flat(self, values: np.ndarray) -> None:
        self._view(values.astype(np.float32))

    def _view(self, values: np.ndarray) -> None:
        """Make all weights views of one array."""
        at = 0
        for name, w in self.weights.items():
            self.weights[name] = values[at : at + w.size].reshape(w.shape)
            at += w.size

    def _joined(self) -> np.ndarray:
        """Queries times keys, and beside them values times "o", as one product each."""
        d, qkv = WIDTH, self.weights["qkv"]
        out = np.empty((d, 2 * d), np.float32)
        np.matmul(qkv[:, :d] * np.float32(d**-0.5), qkv[:, d : 2 * d].T, out=out[:, :d])
        np.matmul(qkv[:, 2 * d :], self.weights["o"], out=out[:, d:])
        return out

    def _ready(self) -> tuple[np.ndarray, ...]:
        """What scoring makes once of all windows: embeddings and their products, of every symbol and of every place, whose sums are those of a token. Embeddings end with a zero and values with a one."""
        w, joined = self.weights, self._joined()
        beside = lambda x, last: np.concatenate([x @ joined[:, :WIDTH], x, np.zeros((len(x), 1), np.float32), x @ joined[:, WIDTH:], np.full((len(x), 1), last, np.float32)], axis=1)
        return beside(w["e"], 1), beside(w["p"], 0)

    def _forward(self, x: np.ndarray, skip: int, ready: tuple | None = None) -> tuple:
        """x: symbols (lanes, window). Logits of the class after each position from ``skip`` on, and what backpropagation needs. ``ready`` (:meth:`_ready`) spares the products of embeddings that many windows share.

        A token's embedding is its own key, as queries are multiplied by the keys' weights, too; what attention mixes are values that went through "o".
        """
        w, d, n = self.weights, WIDTH, len(x)
        if ready:
            both = ready[0].take(x, axis=0)
            both += ready[1]
            q, e, v = both[:, skip:, :d], both[:, :, d : 2 * d], both[:, :, 2 * d + 1 :]
        else:
            e = w["e"].take(x, axis=0)
            e += w["p"]
            joined = self._joined()
            qv = (e.reshape(-1, d) @ joined).reshape(n, WINDOW, 2 * d)
            q, v = qv[:, skip:, :d], qv[:, :, d:]
        a = np.matmul(q, e.transpose(0, 2, 1))
        np.clip(a, -30, 30, out=a)
        np.exp(a, out=a)
        a *= self.causal[skip:]
        # A last column of ones stands for the biases.
        if ready:
            h = np.matmul(a, v)
            h *= 1 / h[:, :, d:]
            h += both[:, skip:, d : 2 * d + 1]
            h, mixed, joined = h.reshape(-1, d + 1), None, None
        else:
            a *= 1 / (a @ self.ones[:WINDOW])[:, :, None]
            mixed = np.matmul(a, v)
            h = np.ones((n * (WINDOW - skip), d + 1), np.float32)
            np.add(mixed, e[:, skip:], out=h.reshape(n, -1, d + 1)[:, :, :d])
        inner = h @ np.vstack([w["in"], w["bi"]])
        np.clip(inner, 0, np.inf, out=inner)
        top = inner @ np.hstack([w["out"], self.zeros])
        top += h
        logits = top @ np.vstack([w["u"], w["bu"]])
        if not max(top.max(), -top.min()) * (np.abs(w["u"]).sum(axis=0) + np.abs(w["bu"])).max() < 60:
            np.clip(logits, -60, 60, out=logits)
        logits += self.symbols.class_table.take(x[:, skip:].ravel(), axis=0)
        return logits, (e, joined, q, v, a, mixed, h, inner, top)

    def gradients(self, x: np.ndarray, y: np.ndarray, live: np.ndarray, loss: bool = True) -> tuple[float | None, dict[str, np.ndarray]]:
        """Loss (if asked for) on windows of symbols and the classes that follow, where ``live``, and its gradients."""
        w, d, n = self.weights, WIDTH, len(x)
        p, (e, joined, q, v, a, mixed, h, inner, top) = self._forward(x, 0)
        np.exp(p, out=p)  # logits are from -110 to 60
        whole, weight = p @ self.ones[: p.shape[1]], live.ravel() * np.float32(1 / max(1, np.count_nonzero(live)))
        own = np.arange(0, p.size, p.shape[1]) + y.ravel()
        loss = float(-(np.log(np.maximum(p.ravel()[own] / whole, 1e-9)) * weight).sum()) if loss else None
        p *= (weight / whole)[:, None]
        p.ravel()[own] -= weight
        last = (p.T @ top).T
        g = {"u": last[:d], "bu": last[d]}
        dtop = p @ w["u"].T
        g["out"] = inner.T @ dtop
        di = dtop @ w["out"].T
        di *= inner > 0
        first = (di.T @ h).T
        g["in"], g["bi"] = first[:d], first[d]
        dh = di @ w["in"].T
        dh += dtop
        dm = dh.reshape(n, WINDOW, d)
        ds = np.matmul(dm, v.transpose(0, 2, 1))
        ds -= ((dm * mixed) @ self.ones[:d])[:, :, None]
        ds *= a
        dqv = np.empty((n, WINDOW, 2 * d), np.float32)
        np.matmul(ds, e, out=dqv[:, :, :d])
        np.matmul(a.transpose(0, 2, 1), dm, out=dqv[:, :, d:])
        dqv = dqv.reshape(-1, 2 * d)
        # Gradients of the two joined products, and of their factors.
        both = (dqv.T @ e.reshape(-1, d)).T
        qk, vo = both[:, :d], both[:, d:]
        query, key, value = (w["qkv"][:, i : i + d] for i in (0, d, 2 * d))
        g["qkv"] = np.concatenate([qk @ key * np.float32(d**-0.5), qk.T @ query * np.float32(d**-0.5), vo @ w["o"].T], axis=1)
        g["o"] = value.T @ vo
        de = dqv @ joined.T
        de += dh
        de += np.matmul(ds.transpose(0, 2, 1), q).reshape(-1, d)
        g["p"] = (np.ones(n, np.float32) @ de.reshape(n, -1)).reshape(WINDOW, d)
        g["e"] = np.zeros_like(w["e"])
        np.add.at(g["e"].reshape(-1), self.cells.take(x, axis=0).ravel(), de.ravel())
        return loss, g

    def _windows(self, first: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every window: the place of its first scored token, the number and the end of its text. At a stride of WINDOW, each token is in one window."""
        size = np.diff(first)
        parts = -(-(size + stride - STRIDE) // stride)
        text = np.repeat(np.arange(len(size)), parts)
        begin = first[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * stride
        return begin, text, first[1:][text]

    def _padded(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Every text after as many start symbols as stand before its first scored token in a window, seen as the windows that begin at each place."""
        pad = WINDOW - STRIDE + 1
        own = np.ones(len(symbols) + pad * len(first) + WINDOW, bool)
        own[(first + pad * np.arange(len(first)))[:, None] + np.arange(pad)] = False
        own[-WINDOW:] = False
        out = np.full(len(own), self.symbols.start, np.int32)
        out[own] = symbols
        return np.lib.stride_tricks.sliding_window_view(out, WINDOW)

    def _inputs(self, padded: np.ndarray, begin: np.ndarray, text: np.ndarray) -> np.ndarray:
        """What stands before each place of a window; the start symbol before a text's first token."""
        return padded[begin + (WINDOW - STRIDE + 1) * text].astype(np.int64)

    def fit(self, tokens: np.ndarray, first: np.ndarray, steps: int, rate: float, part: int = 0, moments: dict | None = None) -> dict:
        """Adam steps on windows of the texts that ``first`` cuts ``tokens`` into. The windows are evenly spaced; ``part`` moves them on by as many places. Returns the moments."""
        windows = self._windows(first)
        n = len(windows[0])
        return self._steps(tokens, first, windows, (np.arange(steps * BATCH) * max(1, n // (steps * BATCH)) + part) % n, rate, part, moments)

    def fit_share(self, tokens: np.ndarray, first: np.ndarray, rate: float, part: int, moments: dict | None = None) -> dict:
        """Adam steps on every window whose number modulo the number of rounds is ``part``; others follow where that makes fewer than STEPS steps. So all rounds together take every token."""
        windows, rounds = self._windows(first, WINDOW), len(RATES)
        n = len(windows[0])
        order = np.concatenate([np.arange((part + i) % rounds, n, rounds) for i in range(rounds)])
        return self._steps(tokens, first, windows, np.resize(order, max(len(range(part % rounds, n, rounds)), STEPS * BATCH)), rate, part, moments)

    def _steps(self, tokens: np.ndarray, first: np.ndarray, windows: tuple, spots: np.ndarray, rate: float, part: int, moments: dict | None) -> dict:
        moments = {} if moments is None else moments
        begin, text, stop = windows
        symbols = self.symbols.of[tokens]
        classes = self.symbols.class_of[symbols]
        spots = np.random.default_rng(part).permutation(spots)
        at = begin[spots, None] - (WINDOW - STRIDE) + np.arange(WINDOW)
        live = (at >= first[text[spots], None]) & (at < stop[spots, None])
        x, y = self._inputs(self._padded(symbols, first), begin[spots], text[spots]), classes.take(at, mode="clip")
        weights = self.flat()
        self._view(weights)
        # Sums of gradients and of their squares, each step's at 0.9 and 0.99 of the one before: ten and a hundred times their means.
        m, s = moments.setdefault("sums", (np.zeros_like(weights), np.zeros_like(weights)))
        change = np.empty_like(weights)
        for i in range(0, len(spots), BATCH):
            _, grads = self.gradients(x[i : i + BATCH], y[i : i + BATCH], live[i : i + BATCH], loss=False)
            t = moments["step"] = moments.get("step", 0) + 1
            grad = np.concatenate([grads[name].ravel() for name in self.weights])
            m *= 0.9
            m += grad
            grad *= grad
            s *= 0.99
            s += grad
            np.sqrt(s, out=grad)
            root = (0.01 / (1 - 0.99**t)) ** 0.5
            grad += 1e-8 / root
            np.divide(m, grad, out=change)
            change *= rate * 0.1 / (1 - 0.9**t) / root
            weights -= change
        return moments

    def score(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of each text. Windows overlap; every token is scored once, after WINDOW - STRIDE tokens of context at least where there are any."""
        begin, text, stop = self._windows(first)
        symbols = self.symbols.of[tokens]
        classes = self.symbols.class_of[symbols]
        value = self.symbols.table[self.symbols.before(symbols, first) * self.symbols.n + symbols] + self.symbols.within[tokens]
        ready, padded = self._ready(), self._padded(symbols, first)
        for i in range(0, len(begin), _LANES):
            b, t, e = begin[i : i + _LANES], text[i : i + _LANES], stop[i : i + _LANES]
            logits, _ = self._forward(self._inputs(padded, b, t), WINDOW - STRIDE, ready)
            at = (b[:, None] + np.arange(STRIDE)).ravel()
            live = at < np.repeat(e, STRIDE)
            own = logits.ravel()[np.arange(0, logits.size, logits.shape[1]) + classes.take(at, mode="clip")]
            np.exp(logits, out=logits)
            own -= np.log(logits @ self.ones[: logits.shape[1]])
            value[at[live]] += own[live]
        return np.add.reduceat(value, first[:-1]) / _LN10


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _is_training(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


class _Words:
    """The lower-cased words of a file: distinct hashes in order, where each is first, and which one every word is."""

    def __init__(self, batch: TextBatch):
        self.data = fold_case(batch.data)
        self.starts, self.ends, self.first = scan_words(self.data, batch.offsets)
        self.distinct, self.example, self.which = np.unique(word_hashes(self.data, self.starts, self.ends), return_index=True, return_inverse=True)
        self.learned = np.array([_is_training(x) for x in batch.ids], bool)
        self.training = np.repeat(self.learned, np.diff(self.first))

    def texts(self, some: np.ndarray) -> list[str]:
        """Some of the distinct words. None holds a blank, so that blanks part them where they are decoded together."""
        if not len(some):
            return []
        starts, ends = self.starts[self.example[some]], self.ends[self.example[some]]
        upto = np.cumsum(ends - starts + 1)
        at = np.repeat(ends + 1 - upto, ends - starts + 1) + np.arange(upto[-1])
        text = self.data.take(at, mode="clip")
        text[upto - 1] = 0x20
        return text.tobytes().decode("utf-8").split(" ")[:-1]


def _tokens(words: _Words, ids: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, each with the end id, and where each text begins (one more than texts)."""
    begin = np.cumsum(size) - size
    length = size[words.which]
    upto = np.concatenate([[0], np.cumsum(length)])
    first = upto[words.first] + np.arange(len(words.first))
    out = np.full(int(first[-1]), end, np.int64)
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    place = np.arange(upto[-1]) + np.repeat(doc, length)
    out[place] = ids[np.repeat(begin[words.which] - upto[:-1], length) + np.arange(upto[-1])]
    return out, first


def _keep(batch: TextBatch, kind: str, *arrays: np.ndarray) -> None:
    """Put arrays of small numbers beside a file. A repeated task writes the same bytes."""
    import pyarrow as pa

    data = np.array([len(arrays), *map(len, arrays)], "<u4").tobytes() + b"".join((x >> shift).astype(np.uint8).tobytes() for x in map(np.asarray, arrays) for shift in (0, 8, 16, 24))
    with batch.store.open_output_stream(f"{batch.path}.{kind}") as out:
        out.write(len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True))


def _kept(folder: str, name: str, kind: str) -> list[np.ndarray]:
    """What :func:`_keep` put beside a file, which isn't opened itself."""
    import pyarrow as pa
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{name}.{kind}") as source:
        data = source.read()
    data = np.frombuffer(pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True), np.uint8)
    sizes = data[4 : 4 + 4 * int(data[:4].view("<u4")[0])].view("<u4").astype(np.int64)
    edge = 4 + 4 * len(sizes) + np.concatenate([[0], np.cumsum(4 * sizes)])
    return [_from_bytes(data[i:j].reshape(4, -1)) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def _from_bytes(planes: np.ndarray) -> np.ndarray:
    """Numbers below 2^32 of their lowest bytes, their second ones and so on."""
    out = planes[0].astype(np.uint32)
    for i, plane in enumerate(planes[1:], 1):
        if plane.any():
            out |= plane.astype(np.uint32) << np.uint32(8 * i)
    return out.astype(np.int64)


def _kept_tokens(folder: str, name: str, training: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a file one after another, and where each text begins (one more than texts); with ``training``, without texts that are held out."""
    tokens, size, learned = _kept(folder, name, "ids")
    if training:
        some = learned > 0
        tokens, size = tokens[np.repeat(some, size)], size[some]
    return tokens, np.concatenate([[0], np.cumsum(size)])


_SUM = "data binary"


def _packed_sum(values: np.ndarray) -> pd.DataFrame:
    some = np.flatnonzero(values)
    return pd.DataFrame({"data": [zlib.compress(some.astype("<u4").tobytes() + values[some].astype("<f8").tobytes(), 1)]})


def _added(rows: pd.DataFrame, total: np.ndarray) -> None:
    for x in rows["data"]:
        x = zlib.decompress(x)
        n = len(x) // 12
        total[np.frombuffer(x[: 4 * n], "<u4")] += np.frombuffer(x[4 * n :], "<f8")


def _tree_sum(parts: DataFrame, size: int, tasks: int) -> np.ndarray:
    """The sum of arrays of ``size`` numbers, one of each of about ``tasks`` tasks (:func:`_packed_sum`). Sixteen at a time are added, so no task and not the driver sees more."""

    def add(batches):
        total = np.zeros(size)
        for rows in batches:
            _added(rows, total)
        yield _packed_sum(total)

    while tasks > 1:
        tasks = -(-tasks // 16)
        parts = parts.repartition(tasks).mapInPandas(add, _SUM)
    total = np.zeros(size)
    _added(parts.toPandas(), total)
    return total


def score_texts(docs: DataFrame, tokenizer_file: str = TOKENIZER) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs`` (doc_id, text; more columns are ignored).

    Learns from rows whose crc32 of doc_id modulo 5 isn't 1, a null doc_id included. Words are cut at ASCII white space, with A-Z lower-cased; each text ends with an end token. ``base_score``
    sums log10((c + 0.5) / (N + 0.5 (V + 1))) over a text's tokens, with counts over all training rows; ``score`` is the attention model's log10 probability
    of the text's subword ids and end. Null, empty and blank texts are the end token alone. Repeated rows get equal results, and each counts.

    Counts of words, subwords and pairs of subwords are over all training rows. The network starts from WARM_FILES files and then trains on every window of every file, a share of them each round: tasks take the same
    weights, make their steps file by file, and the weights they end with are averaged. What the driver gets is a few arrays of fixed size a round.
    """
    spark = docs.sparkSession
    folder, manifest = write_batches(docs)
    buckets = buckets_for(manifest.agg(F.sum("bytes")).first()[0] or 0)
    n_files = manifest.count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_files // 4))
    files = manifest.select("batch").repartition(tasks, "batch")
    end = Tokenizer(tokenizer_file).end

    def requests(batches):
        known, subwords = _known(tokenizer_file), np.zeros(end + 1)
        for rows in batches:
            for name in rows["batch"]:
                batch = TextBatch(folder, name)
                words = _Words(batch)
                ids, size = known.ids(words)
                tokens, first = _tokens(words, ids, size, end)
                _keep(batch, "ids", tokens, np.diff(first), words.learned)
                _keep(batch, "words", words.which, np.diff(words.first))
                count = np.bincount(words.which[words.training], minlength=len(words.distinct)).astype(np.int64)
                subwords += np.bincount(ids, np.repeat(count, size), end + 1)
                subwords[end] += words.learned.sum()
                out = [("words", b, name, words.distinct[p].tobytes(), to_planes(count[p])) for b, p in bucket_cells(words.distinct, buckets)]
                yield pd.DataFrame(out, columns=["kind", "bucket", "batch", "data", "counts"])
        yield _packed_sum(subwords).assign(kind="subwords", bucket=-1, batch=None, counts=None)[["kind", "bucket", "batch", "data", "counts"]]

    def totals(rows: pd.DataFrame) -> pd.DataFrame:
        """Each word's count over all files, sent back to the files that have it; and a row with the bucket's share of N and V."""
        parts = [np.frombuffer(x, np.uint64) for x in rows["data"]]
        distinct, which = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, which, np.concatenate([from_planes(x) for x in rows["counts"]]).astype(np.int64))
        edge = np.cumsum([0, *map(len, parts)])
        out = [("counts", rows["bucket"].iloc[0], b, to_planes(total[which[edge[i] : edge[i + 1]]]), 0, 0) for i, b in enumerate(rows["batch"])]
        out.append(("sizes", rows["bucket"].iloc[0], None, None, int(total.sum()), int((total > 0).sum())))
        return pd.DataFrame(out, columns=["kind", "bucket", "batch", "data", "n", "v"])

    asked = stage(files.mapInPandas(requests, "kind string, bucket int, batch string, data binary, counts binary"), "word-requests", partition_by="kind")
    answered = stage(asked.where("kind = 'words'").groupBy("bucket").applyInPandas(totals, "kind string, bucket int, batch string, data binary, n long, v long"), "word-counts", partition_by="kind")
    n, v = answered.where("kind = 'sizes'").agg(F.sum("n"), F.sum("v")).first()
    counts = _tree_sum(asked.where("kind = 'subwords'").select("data"), end + 1, tasks)
    ends = int(counts[end])
    n, v = (n or 0) + ends, (v or 0) + (ends > 0)
    symbols = Symbols(counts)
    sent = spark.sparkContext.broadcast(symbols)

    def pairs(batches):
        total = np.zeros((sent.value.n + 1) * sent.value.n)
        for rows in batches:
            for name in rows["batch"]:
                tokens, first = _kept_tokens(folder, name, training=True)
                if len(first) > 1:
                    total += sent.value.pairs(tokens, first)
        yield _packed_sum(total)

    model = Attention(symbols.learn(_tree_sum(files.mapInPandas(pairs, _SUM), (symbols.n + 1) * symbols.n, tasks)))
    shared = spark.sparkContext.broadcast(model)

    def trained(weights, rate: float, part: int):
        """Weights after a task's files, times their tokens; the tokens come last."""

        def run(batches):
            model, moments, weight = Attention(shared.value.symbols), {}, 0
            model.set_flat(weights.value)
            for rows in batches:
                for name in rows["batch"]:
                    tokens, first = _kept_tokens(folder, name, training=True)
                    if len(first) > 1:
                        moments = model.fit_share(tokens, first, rate, part, moments) if part else model.fit(tokens, first, WARM_STEPS, rate, part, moments)
                        weight += len(tokens)
            if weight:
                yield _packed_sum(np.append(model.flat().astype(np.float64) * weight, weight))

        return run

    warm = manifest.select("batch").orderBy("batch").limit(WARM_FILES).repartition(1)
    for part, (some, tasks_, rate) in enumerate([(warm, 1, WARM_RATE), *[(files, tasks, rate) for rate in RATES]]):
        weights = spark.sparkContext.broadcast(model.flat())
        total = _tree_sum(some.mapInPandas(trained(weights, rate, part), _SUM), model.flat().size + 1, tasks_)
        if total[-1]:
            model.set_flat(total[:-1] / total[-1])
    final = spark.sparkContext.broadcast(model.flat())

    def scores(files: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        model = Attention(shared.value.symbols)
        model.set_flat(final.value)
        got = dict(answers[["bucket", "data"]].itertuples(index=False))
        for name in files["batch"]:
            batch = TextBatch(folder, name)
            which, n_words = _kept(folder, name, "words")
            c = np.concatenate([from_planes(got[b]) for b in sorted(got)]) if got else np.zeros(0, np.uint64)
            c = c.astype(np.float64)
            scale = n + 0.5 * (v + 1)
            doc = np.repeat(np.arange(len(batch.ids)), n_words)
            base = np.bincount(doc, np.log10((c + 0.5) / scale)[which], len(batch.ids)) + np.log10((ends + 0.5) / scale)
            known = np.bincount(doc, (c > 0)[which], len(batch.ids)) + (ends > 0)
            out.append(pd.DataFrame({"doc_id": pd.array(batch.ids, "Int64"), "n_tokens": n_words + 1, "n_known": known.astype(np.int64), "train_tokens": n, "base_score": base, "score": model.score(*_kept_tokens(folder, name))}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    # A task opens about two files, however few bytes the answers are.
    last = max(spark.sparkContext.defaultParallelism, -(-n_files // 2))
    replies = answered.where("kind = 'counts'").select("batch", "bucket", "data").repartition(last, "batch")
    return manifest.repartition(last, "batch").groupBy("batch").cogroup(replies.groupBy("batch")).applyInPandas(scores, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
