"""Image formats by their first bytes, and who decodes them.

A format has decoders in the order in which they were registered. Each is loaded in a task when its first image of that format comes, so a missing library costs nothing where no such image is met. What no decoder here
can take is undecided, not broken: its bytes are kept, and a later run with another decoder settles it.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

import numpy as np

Decoder = Callable[[bytes], np.ndarray]

# What files of each format begin with; for ISO media files and RIFF, from which byte on.
MAGIC: dict[str, tuple[tuple[int, bytes], ...]] = {
    "png": ((0, b"\x89PNG\r\n\x1a\n"),),
    "jpeg": ((0, b"\xff\xd8\xff"),),
    "gif": ((0, b"GIF87a"), (0, b"GIF89a")),
    "tiff": ((0, b"II*\x00"), (0, b"MM\x00*"), (0, b"II+\x00"), (0, b"MM\x00+")),
    "bmp": ((0, b"BM"),),
    "ppm": ((0, b"P6"),),
    "pnm": ((0, b"P1"), (0, b"P2"), (0, b"P3"), (0, b"P4"), (0, b"P5"), (0, b"P7")),
    "webp": ((8, b"WEBP"),),
    "jpeg2000": ((0, b"\x00\x00\x00\x0cjP  "), (0, b"\xff\x4f\xff\x51")),
    "avif": ((4, b"ftypavif"), (4, b"ftypavis")),
    "heif": ((4, b"ftypheic"), (4, b"ftypheix"), (4, b"ftypmif1")),
    "jpegxl": ((0, b"\xff\x0a"), (0, b"\x00\x00\x00\x0cJXL ")),
    "exr": ((0, b"\x76\x2f\x31\x01"),),
    "hdr": ((0, b"#?RADIANCE"),),
}


class Undecided(Exception):
    """An image of a known format that no decoder here can take."""

    def __init__(self, kind: str, why: str = ""):
        super().__init__(f"no decoder for {kind}" + (f": {why}" if why else ""))
        self.kind = kind


class Unsupported(Exception):
    """Raised by a decoder for a variant of its format that it doesn't know; the next one is asked."""


def format_of(data: bytes) -> str | None:
    """The format that the bytes begin like; None for anything else."""
    return next((kind for kind, marks in MAGIC.items() if any(data.startswith(m, at) for at, m in marks)), None)


def with_pillow() -> Decoder:
    """Pillow, for what it was built with."""
    from io import BytesIO

    from PIL import Image, UnidentifiedImageError

    def read(data: bytes) -> np.ndarray:
        try:
            with Image.open(BytesIO(data)) as image:
                return np.asarray(image.convert("RGB"), np.uint8)[:, :, ::-1].copy()
        except UnidentifiedImageError as error:
            raise Unsupported(str(error)) from error

    return read


def with_opencv() -> Decoder:
    import cv2

    def read(data: bytes) -> np.ndarray:
        image = cv2.imdecode(np.frombuffer(data, np.uint8), cv2.IMREAD_COLOR)
        if image is None:
            raise ValueError("OpenCV can't read it")
        return image

    return read


class Codecs:
    """Decoders by format. ``more`` maps formats to factories: callables, or names ``package.module:function``; they come before those that are built in and are what a task gets."""

    def __init__(self, more: dict[str, list | str | Callable] | None = None):
        self.factories: dict[str, list] = {}
        for kind, makers in (more or {}).items():
            if kind not in MAGIC:
                raise ValueError(f"{kind} is no known image format; known are {', '.join(MAGIC)}")
            self.factories[kind] = list(makers) if isinstance(makers, list | tuple) else [makers]
        self._loaded: dict[str, list[Decoder]] = {}

    def __getstate__(self):
        return self.factories

    def __setstate__(self, factories):
        self.factories, self._loaded = factories, {}

    def decoders(self, kind: str) -> list[Decoder]:
        """Those that can be loaded here."""
        if kind not in self._loaded:
            from tarnlake.operators.imaging import DECODERS

            out = []
            for maker in [*self.factories.get(kind, []), *([lambda: DECODERS[kind]] if kind in DECODERS else []), with_pillow, with_opencv]:
                try:
                    if isinstance(maker, str):
                        module, _, name = maker.partition(":")
                        maker = getattr(import_module(module), name)
                    out.append(maker())
                except ImportError:
                    continue
            self._loaded[kind] = out
        return self._loaded[kind]

    def knows(self, kind: str) -> bool:
        return bool(self.decoders(kind))

    def decode(self, data: bytes) -> np.ndarray:
        """Rows x columns x 3 bytes: blue, green, red. ValueError for what is no image or a broken one, :class:`Undecided` for one that nobody here can tell about."""
        kind = format_of(data)
        if kind is None:
            raise ValueError("Corrupted Image")
        why = ""
        for decoder in self.decoders(kind):
            try:
                image = np.asarray(decoder(data))
            except Unsupported as error:
                why = str(error)
                continue
            except Exception as error:
                raise ValueError(f"Corrupted Image: {error}") from error
            if image.ndim != 3 or image.shape[2] != 3 or image.dtype != np.uint8:
                raise ValueError(f"the decoder of {kind} gave {image.shape} of {image.dtype}")
            return image
        raise Undecided(kind, why)
