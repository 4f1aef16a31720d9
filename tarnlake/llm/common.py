"""Helpers that the training-data operators share: staging, row keys, word scanning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.plans.staging import clean_shared, scratch, shared_dir
from tarnlake.plans.staging import staged as stage

__all__ = ["clean_shared", "scratch", "shared_dir", "stage"]

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[65:91] += 32
#: Odd multiplier of the polynomial byte hash, and the finaliser's constants.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ROLL = np.uint64(0xD6E8FEB86659FD93)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def row_key(*cols: str | Column) -> Column:
    """128-bit key of a row's content. Equal rows share it; null and empty differ."""
    cells = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string") if isinstance(c, str) else c.cast("string")), F.lit("n")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x01", *cells)))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` is far faster than ``translate``; it is used where it leaves every character beyond ASCII as it is."""
    beyond = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when((F.octet_length(text) == F.length(text)) | (F.lower(beyond) == beyond), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def others(df: DataFrame, *new: str) -> list[str]:
    """Columns of ``df`` that an operator passes on beside its own ``new`` ones. One with a new column's name is replaced."""
    taken = {n.lower() for n in new}
    return [c for c in df.columns if c.lower() not in taken]


def packed(df: DataFrame, *used: str) -> DataFrame:
    """The columns ``used``, and all others in one struct ``_row``, so that no column clashes with an operator's own. :func:`unpacked` undoes it."""
    rest = [F.col(f"`{c}`") for c in others(df, *used)] or [F.lit(0).alias("_none")]
    return df.select(*used, F.struct(*rest).alias("_row"))


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns that a table had before :func:`packed`, with ``new`` values for some."""
    kept = {c.lower() for c in df.columns} - {"_row"}
    return df.select(*[new.get(c, F.col(c) if c.lower() in kept else F.col(f"_row.`{c}`")).alias(c) for c in columns])


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than rows) of an Arrow string or binary array; null is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(wide).fill_null(b"" if wide == pa.large_binary() else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_parts(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of texts, in order, of about ``limit`` bytes each and at least one text."""
    out, done = [], 0
    while done < len(offsets) - 1:
        upto = max(done + 1, int(np.searchsorted(offsets, offsets[done] + limit, side="right")) - 1)
        out.append((done, upto))
        done = upto
    return out


def scan_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word (one more than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def fold_case(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased in UTF-8 bytes; other bytes stay."""
    return _TO_LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes, whatever its place: polynomial prefix sums, then :func:`mix`."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base = np.uint64((int(mix(np.array([seed + 1], np.uint64))[0]) * 2 + int(_BASE)) & 0xFFFFFFFFFFFFFFFF)
    length = ends - starts
    out = np.zeros(len(starts), np.uint64)
    top = int(length.max())
    order = np.argsort(-length, kind="stable")
    starts, live = starts[order], len(order)
    sorted_length = -length[order]
    acc = np.zeros(len(order), np.uint64)
    for i in range(min(top, 64)):
        live = int(np.searchsorted(sorted_length, -i, side="left"))
        acc[:live] = acc[:live] * base + (data[starts[:live] + i].astype(np.uint64) + np.uint64(1))
    for j in np.flatnonzero(-sorted_length > 64):
        value = int(acc[j])
        for byte in data[starts[j] + 64 : starts[j] - sorted_length[j]].tolist():
            value = (value * int(base) + byte + 1) & 0xFFFFFFFFFFFFFFFF
        acc[j] = value
    out[order] = acc
    return mix(out ^ length.astype(np.uint64))


def rolling_hashes(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of every n consecutive word hashes, in order."""
    size, out = len(hashes) - n + 1, np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    p = _ROLL + np.uint64(2 * salt)
    for j in range(n if size > 0 else 0):
        out = out * p + hashes[j : j + size]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text. A shorter text is one shingle; one without words has none."""
    data = fold_case(data)
    starts, ends, first = scan_words(data, offsets)
    words = word_hashes(data, starts, ends)
    rolled, n = rolling_hashes(words, shingle), np.diff(first)
    return [np.unique(rolled[a : a + k - shingle + 1]) if k >= shingle else rolling_hashes(words[a : a + k], int(k))[:1] if k else words[:0] for a, k in zip(first[:-1].tolist(), n.tolist(), strict=True)]
