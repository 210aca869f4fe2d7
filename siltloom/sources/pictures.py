"""Pictures from files: PNG bytes to pixel arrays and back, without an imaging library.

All colour types of 8 bits (and palettes and grey of fewer) are read, without interlacing; what cannot be read is a row with
what failed, never a lost one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from siltloom.common import map_rows
from siltloom.sources.files import source_files

_MARK = b"\x89PNG\r\n\x1a\n"
#: Samples per pixel by colour type, and the weights of a colour's lightness.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
LIGHT = (0.299, 0.587, 0.114)
IMAGE = "struct<pixels: array<double>, height: int, width: int>"


def _chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = len(_MARK)
    while at + 8 <= len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        body = data[at + 8 : at + 8 + size]
        if len(body) < size:
            raise ValueError("the file breaks off")
        yield data[at + 4 : at + 8], body
        at += size + 12


def _unfiltered(raw: bytes, height: int, stride: int, step: int) -> np.ndarray:
    """The rows of a picture with their filters undone; ``step`` bytes lie between a byte and the one left of it."""
    rows = np.zeros((height + 1, stride + step), dtype=np.uint8)  # a row of zeros above, a pixel of zeros to the left
    for y in range(height):
        kind = raw[y * (stride + 1)]
        line = np.frombuffer(raw, dtype=np.uint8, count=stride, offset=y * (stride + 1) + 1)
        up, now = rows[y], rows[y + 1]
        if kind == 0:
            now[step:] = line
        elif kind == 2:
            now[step:] = line + up[step:]
        elif kind == 1:
            now[step:] = np.add.accumulate(np.pad(line, (0, -stride % step)).reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)[:stride]
        elif kind in (3, 4):
            for x in range(stride):
                a, b, c = int(now[x]), int(up[x + step]), int(up[x])
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((a, b, c), key=lambda v: abs(p - v))
                now[x + step] = (int(line[x]) + guess) & 255
        else:
            raise ValueError(f"unknown filter {kind}")
    return rows[1:, step:]


def decode_png(data: bytes) -> np.ndarray:
    """Height by width by samples; a palette is looked up.  Raises ValueError for anything else than such a picture."""
    if not data.startswith(_MARK):
        raise ValueError("no PNG")
    head, palette, body = None, None, []
    for name, part in _chunks(data):
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"PLTE":
            palette = np.frombuffer(part, dtype=np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            body.append(part)
    if head is None:
        raise ValueError("no header")
    width, height, depth, colour, _, _, interlaced = head
    if interlaced or colour not in _SAMPLES or depth not in (1, 2, 4, 8) or depth < 8 and colour not in (0, 3):
        raise ValueError("a form that is not read")
    samples = _SAMPLES[colour]
    stride = -(-width * samples * depth // 8)
    try:
        raw = zlib.decompress(b"".join(body))
    except zlib.error as e:
        raise ValueError(str(e)) from None
    if len(raw) < height * (stride + 1):
        raise ValueError("too few pixels")
    rows = _unfiltered(raw, height, stride, max(1, samples * depth // 8))
    if depth < 8:
        bits = np.unpackbits(rows, axis=1).reshape(height, -1, depth)
        rows = (bits * (1 << np.arange(depth)[::-1])).sum(2)[:, :width]
        if colour == 0:
            rows = rows * (255 // ((1 << depth) - 1))
    pixels = rows.reshape(height, width, samples)
    return palette[pixels[:, :, 0]] if colour == 3 else pixels


def encode_png(pixels: np.ndarray) -> bytes:
    """A grey picture (height by width) or one of three samples, of whole numbers from 0 to 255."""
    pixels = np.asarray(pixels, dtype=np.uint8)
    height, width = pixels.shape[:2]
    raw = b"".join(b"\x00" + row.tobytes() for row in pixels)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    return _MARK + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def grey(pixels: np.ndarray) -> np.ndarray:
    """The lightness of each pixel; a sample of transparency is left out."""
    return pixels[:, :, :3] @ np.array(LIGHT) if pixels.shape[2] >= 3 else pixels[:, :, 0].astype(float)


def decoded_images(files: DataFrame) -> DataFrame:
    """(path, image, failed): the lightness of every picture as the struct that the image functions take."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, data in rows:
            try:
                light = grey(decode_png(bytes(data or b"")))
            except ValueError as e:
                yield path, None, str(e)
                continue
            yield path, {"pixels": light.reshape(-1).tolist(), "height": light.shape[0], "width": light.shape[1]}, None

    return map_rows(files.select("path", "content"), run, f"path string, image {IMAGE}, failed string", block=64)


def image_files(spark: SparkSession, root: str, pattern: str = "*.png") -> DataFrame:
    """The pictures below a folder, decoded."""
    return decoded_images(source_files(spark, root, pattern))
