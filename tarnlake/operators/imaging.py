"""Decoding, area scaling and hashing of images, in Arrow-batched Python."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.codecs import Codecs, Unsupported

#: Decoders that need no library, by format. Each returns rows x columns x 3 bytes in the order blue, green, red.
DECODERS: dict[str, Callable[[bytes], np.ndarray]] = {}
#: Rows of an image that scaling holds as sums at a time.
STRIP_ROWS = 64
#: Bytes of pixels of small images that are scaled together.
STACK_BYTES = 1 << 18


def decoder(kind: str):
    def add(f):
        DECODERS[kind] = f
        return f

    return add


@decoder("png")
def _png(data: bytes) -> np.ndarray:
    """PNG of 8 bits a channel, not interlaced: grey, colour, palette, with or without alpha."""
    at, body, palette, head = 8, b"", None, None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += chunk
        at += 12 + size
    w, h, depth, colour, _, _, interlace = head
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    if depth != 8 or interlace:
        raise Unsupported("only PNG of 8 bits a channel without interlacing")
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    above = np.zeros(w * channels, np.uint8)
    for y in range(h):
        kind, line = lines[y, 0], lines[y, 1:]
        if kind == 0:
            row = line
        elif kind == 2:
            row = line + above
        elif kind == 1:
            row = np.cumsum(line.reshape(-1, channels), axis=0, dtype=np.uint8).ravel()
        else:
            row = _unfiltered(int(kind), line, above, channels)
        out[y] = above = row
    pixels = out.reshape(h, w, channels)
    if colour == 3:
        return palette[pixels[:, :, 0]][:, :, ::-1].copy()
    return (np.repeat(pixels[:, :, :1], 3, axis=2) if channels < 3 else pixels[:, :, 2::-1]).copy()


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A line whose bytes were stored as differences from the mean (3) or the best predictor (4) of their neighbours."""
    row, up = [0] * step + [0] * len(line), [0] * step + above.tolist()
    for i, x in enumerate(line.tolist(), step):
        a, b, c = row[i - step], up[i], up[i - step]
        if kind == 3:
            guess = (a + b) // 2
        else:
            left, top, corner = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if left <= top and left <= corner else b if top <= corner else c
        row[i] = (x + guess) & 255
    return np.array(row[step:], np.uint8)


@decoder("ppm")
def _ppm(data: bytes) -> np.ndarray:
    _, w, h, top, pixels = data.split(maxsplit=4)
    if top != b"255":
        raise Unsupported("only PPM of 8 bits a channel")
    pixels = data[len(data) - int(w) * int(h) * 3 :]
    return np.frombuffer(pixels, np.uint8).reshape(int(h), int(w), 3)[:, :, ::-1].copy()


@decoder("bmp")
def _bmp(data: bytes) -> np.ndarray:
    """BMP of 24 bits a pixel, stored from the bottom or the top."""
    start, w, h, bits = struct.unpack("<I", data[10:14])[0], *struct.unpack("<ii", data[18:26]), struct.unpack("<H", data[28:30])[0]
    if bits != 24:
        raise Unsupported("only BMP of 24 bits a pixel")
    stride = (w * 3 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)[:, : w * 3].reshape(abs(h), w, 3)
    return (rows[::-1] if h > 0 else rows).copy()


def decode(data: bytes, codecs: Codecs | None = None) -> np.ndarray:
    """Pixels of an encoded image; see :meth:`Codecs.decode`."""
    return (codecs or Codecs()).decode(data)


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Each new pixel is the mean of what it covers, rounded half up. Exact: all sums are whole numbers.

    The image is read once in strips of STRIP_ROWS rows. A strip's sums along its rows are taken between the new columns' edges, then running sums down the columns between the new rows' edges, so no more than a strip is
    held beside the image and the result. Edges lie on multiples of the old side in units of 1 / new side.
    """
    if height < 1 or width < 1:
        raise ValueError("a side would vanish")
    old_height, old_width, depth = image.shape
    edges = np.arange(width + 1, dtype=np.int64) * old_width
    column, part = edges // width, edges % width
    inside = np.minimum(column, old_width - 1)
    area = old_height * old_width
    out = np.empty((height, width, depth), np.uint8)
    total, last, done = np.zeros((width, depth), np.int64), np.zeros((width, depth), np.int64), 1
    for top in range(0, old_height, STRIP_ROWS):
        strip = image[top : top + STRIP_ROWS].astype(np.int64)
        ahead = np.zeros((len(strip), old_width + 1, depth), np.int64)
        np.cumsum(strip, axis=1, out=ahead[:, 1:])
        sums = np.diff(ahead[:, column] * width + strip[:, inside] * part[:, None], axis=1)
        ahead = np.concatenate([np.zeros((1, width, depth), np.int64), np.cumsum(sums, axis=0)]) * height
        while done <= height and (row := done * old_height // height - top) < len(strip):
            upto = total + ahead[row] + sums[row] * (done * old_height % height)
            out[done - 1] = (2 * (upto - last) + area) // (2 * area)
            last, done = upto, done + 1
        total = total + ahead[-1]
    if done <= height:
        out[done - 1] = (2 * (total - last) + area) // (2 * area)
    return out


def fit_within(image: np.ndarray, limit: int) -> np.ndarray:
    """Scaled down, aspect kept and sides truncated, if a side is over the limit."""
    h, w = image.shape[:2]
    if h <= limit and w <= limit:
        return image
    return area_resize(image, limit, int(w * (limit / h))) if h > w else area_resize(image, int(h * (limit / w)), limit)


def process(data: bytes, limit: int, codecs: Codecs | None = None) -> dict:
    """Everything that is stored of a downloaded image."""
    image = decode(data, codecs)
    small = fit_within(image, limit)
    pixels = small.tobytes()
    return {"original_size": list(image.shape[:2]), "resized_size": list(small.shape[:2]), "hashsum_original": hashlib.md5(data).hexdigest(), "hashsum_resized": hashlib.md5(pixels).hexdigest(), "image": pixels}


def fit_alike(images: list[bytes], height: int, width: int, limit: int) -> list[tuple[tuple[int, int], bytes]]:
    """Size and pixels of images of one size, scaled together as :func:`fit_within` does one, up to STACK_BYTES of them at a time."""
    out, some = [], max(1, STACK_BYTES // max(1, height * width * 3))
    for i in range(0, len(images), some):
        part = images[i : i + some]
        stack = np.frombuffer(b"".join(part), np.uint8).reshape(len(part), height, width, 3)
        small = fit_within(stack.transpose(1, 2, 0, 3).reshape(height, width, 3 * len(part)), limit)
        h, w = small.shape[:2]
        out += [((h, w), x.tobytes()) for x in small.reshape(h, w, len(part), 3).transpose(2, 0, 1, 3)]
    return out


def resize_stored(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with stored pixels scaled to the limit, and their size and hash. Rows within it, rows whose pixels don't fill their size, and rows of which a side would vanish stay as they are.

    Images of one size in a batch are scaled together, so rows that lie by size cost least.
    """

    def small(size: pd.Series, image: pd.Series) -> pd.DataFrame:
        out, alike = [(None, None)] * len(size), {}
        for i, (s, data) in enumerate(zip(size, image, strict=True)):
            if s is None or data is None or len(s) != 2 or int(s[0]) * int(s[1]) * 3 != len(data) or max(s) <= limit:
                continue
            alike.setdefault((int(s[0]), int(s[1])), []).append(i)
        for (h, w), at in alike.items():
            try:
                made = fit_alike([image.iloc[i] for i in at], h, w, limit)
            except ValueError:  # a side would vanish
                continue
            for i, x in zip(at, made, strict=True):
                out[i] = x
        return pd.DataFrame(out, columns=["size", "image"])

    made = F.pandas_udf(small, "size array<long>, image binary")("resized_size", "image")
    out = rows.withColumn("_new", made)
    new = {"resized_size": F.coalesce("_new.size", "resized_size"), "image": F.coalesce("_new.image", "image"), "hashsum_resized": F.coalesce(F.md5("_new.image"), "hashsum_resized")}
    return out.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in rows.columns])
