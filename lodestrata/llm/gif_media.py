"""Media columns for GIF: LZW streams, palettes, disposal, transparency, timed frames, colour histograms.

``decode`` reads any GIF87a/89a: global and local palettes, interlace, transparency, all four
disposal methods. LZW code widths depend only on how many codes came since the last clear code, so a
whole run of codes is cut out of the bits with NumPy and only the dictionary is walked code by code.
``encode_samples`` stores bytes losslessly as 8-bit grey samples in frames of 192 columns.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import bounded_batches, cut_rows

COLUMNS, FRAME_ROWS, DELAY_CS, BINS = 192, 64, 4, 16
PART_BYTES = 2 << 20
_GREY = bytes(np.repeat(np.arange(256, dtype=np.uint8), 3))
_CLEAR, _END, _MOST = 256, 257, 4096


MOST_POINTS = 1 << 26  # 256 MB of canvas


class GifError(ValueError):
    """Bytes that are not a whole GIF."""


def _widths(size: int, n: int) -> np.ndarray:
    """Bits of the i-th code after a clear code, for a minimum code size."""
    entries = (1 << size) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.minimum(12, np.floor(np.log2(entries)).astype(np.int64) + 1)


_RUN = 4200  # codes cut out at once; a run without a clear code goes on at 12 bits
_WIDTHS = {size: _widths(size, _RUN) for size in range(2, 9)}
_OFFSETS = {size: np.concatenate([[0], np.cumsum(w)]) for size, w in _WIDTHS.items()}


def lzw_pack(samples: bytes) -> bytes:
    """The LZW stream of 8-bit samples: dictionary up to 4096 entries, then a clear code."""
    runs, codes = [], []
    if samples:
        table: dict[int, int] = {}
        get, put, new, p = table.get, codes.append, _END + 1, samples[0]
        for b in memoryview(samples)[1:]:
            k = p << 8 | b
            c = get(k)
            if c is None:
                put(p)
                table[k] = new
                new += 1
                p = b
                if new == _MOST:
                    put(_CLEAR)
                    runs.append(codes)
                    codes, table, new = [], {}, _END + 1
                    get, put = table.get, codes.append
            else:
                p = c
        put(p)
    codes.append(_END)
    runs.append(codes)
    flat = np.concatenate([np.array([_CLEAR], "<u2"), *(np.array(run, "<u2") for run in runs)])
    widths = np.concatenate([[9], *(_WIDTHS[8][: len(run)] for run in runs)])
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return np.packbits(bits[np.arange(16) < widths[:, None]], bitorder="little").tobytes()


def lzw_unpack(data: bytes, size: int, n: int) -> bytes:
    """The first ``n`` samples of an LZW stream with a minimum code size."""
    if size not in _WIDTHS:
        raise GifError(f"minimum code size {size}")
    clear, end = 1 << size, (1 << size) + 1
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.uint32)
    base = [bytes([i]) for i in range(clear)] + [b"", b""]
    widths, offsets = _WIDTHS[size], _OFFSETS[size]
    out, made, bit, last, table, prev, full = [], 0, 0, len(data) * 8, base.copy(), b"", False
    while made < n:
        if full:  # the dictionary is full and no clear code has come
            at = bit + 12 * np.arange(_RUN)
            wide = np.full(_RUN, 12)
        else:
            at, wide = bit + offsets[:-1], widths
        known = int(np.searchsorted(at + wide, last, side="right"))
        if not known:
            break
        at, wide = at[:known], wide[:known]
        byte = at >> 3
        codes = ((raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (at & 7).astype(np.uint32)) & ((1 << wide) - 1).astype(np.uint32)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else known
        put, grow, room = out.append, table.append, _MOST - len(table)
        for c in codes[:stop].tolist():
            if c < len(table):
                entry = table[c]
                if prev and room > 0:
                    grow(prev + entry[:1])
                    room -= 1
            elif prev and c == len(table):
                entry = prev + prev[:1]
                grow(entry)
                room -= 1
            else:
                raise GifError(f"code {c} before its entry")
            put(entry)
            prev = entry
            made += len(entry)
        if stop == known:
            if known < len(wide) or at[-1] + wide[-1] >= last or full and known < _RUN:
                break
            bit, full = int(at[-1] + wide[-1]), True
            continue
        if codes[stop] == end:
            break
        bit, table, prev, full = int(at[stop] + wide[stop]), base.copy(), b"", False
    samples = b"".join(out)
    if len(samples) < n:
        raise GifError(f"{len(samples)} of {n} samples")
    return samples[:n]


def _sub_blocks(data: bytes) -> bytes:
    whole = len(data) // 255 * 255
    parts = [b"\xff" + data[i : i + 255] for i in range(0, whole, 255)]
    if rest := data[whole:]:
        parts.append(bytes([len(rest)]) + rest)
    return b"".join(parts) + b"\0"


def encode_samples(payload: bytes, columns: int = COLUMNS, frame_rows: int = FRAME_ROWS, delay_cs: int = DELAY_CS) -> bytes:
    """A GIF whose frames hold ``payload`` as grey samples; its length is a positive multiple of ``columns``."""
    rows = len(payload) // columns
    if not rows or len(payload) % columns:
        raise ValueError("the payload is no positive multiple of the columns")
    out = [b"GIF89a", struct.pack("<HHBBB", columns, min(rows, frame_rows), 0xF7, 0, 0), _GREY]
    for top in range(0, rows, frame_rows):
        n = min(frame_rows, rows - top)
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, delay_cs, 0) + b"\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, columns, n, 0) + b"\x08")
        out.append(_sub_blocks(lzw_pack(payload[top * columns : (top + n) * columns])))
    return b"".join([*out, b"\x3b"])


@dataclass
class Frame:
    """One timed frame: its rectangle, rules, and the whole canvas (RGBA) as shown until the next frame is drawn."""

    left: int
    top: int
    width: int
    height: int
    delay_ms: int
    disposal: int
    shown: np.ndarray

    def histogram(self, bins: int = BINS) -> list[int]:
        """Counts of red, then green, then blue in ``bins`` equal steps, over the canvas' opaque points."""
        points = self.shown.reshape(-1, 4)
        seen = points[:, 3] > 0
        if not seen.all():
            points = points[seen]
        steps = [np.bincount(points[:, c], minlength=256).reshape(bins, -1).sum(1) for c in range(3)]
        return np.concatenate(steps).tolist()


def _rows_of(height: int) -> np.ndarray:
    """The rows of an interlaced image in the order in which they are stored."""
    return np.concatenate([np.arange(a, height, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])


def decode(data: bytes, most_points: int = MOST_POINTS) -> Iterator[Frame]:
    """The frames of a GIF, one at a time. A canvas or frame of more than ``most_points`` is an error, as is any cut or wrong part."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise GifError("no GIF header")
    wide, high, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    if wide * high > most_points:
        raise GifError(f"a canvas of {wide} x {high}")
    at = 13

    def palette(bits: int) -> np.ndarray:
        nonlocal at
        n = 3 << (bits + 1)
        if at + n > len(data):
            raise GifError("a cut palette")
        out = np.frombuffer(data, np.uint8, n, at).reshape(-1, 3)
        at += n
        return out

    def blocks() -> bytes:
        nonlocal at
        parts = []
        while True:
            if at >= len(data):
                raise GifError("a cut block")
            n = data[at]
            at += 1
            if not n:
                return b"".join(parts)
            if at + n > len(data):
                raise GifError("a cut block")
            parts.append(data[at : at + n])
            at += n

    common = palette(flags & 7) if flags & 0x80 else None
    canvas, rule = np.zeros((high, wide, 4), np.uint8), (0, 0, None)
    while True:
        if at >= len(data):
            raise GifError("no trailer")
        kind = data[at]
        at += 1
        if kind == 0x3B:
            return
        if kind == 0x21:
            label = data[at : at + 1]
            at += 1
            body = blocks()
            if label == b"\xf9" and len(body) >= 4:
                mark, delay, clear = struct.unpack_from("<BHB", body)
                rule = (mark >> 2 & 7, delay * 10, clear if mark & 1 else None)
        elif kind == 0x2C:
            if at + 9 > len(data):
                raise GifError("a cut image")
            left, top, w, h, mark = struct.unpack_from("<HHHHB", data, at)
            at += 9
            if w * h > most_points:
                raise GifError(f"an image of {w} x {h}")
            colours = palette(mark & 7) if mark & 0x80 else common
            if colours is None:
                raise GifError("no palette")
            size = data[at] if at < len(data) else 0
            at += 1
            samples = np.frombuffer(lzw_unpack(blocks(), size, w * h), np.uint8).reshape(h, w)
            indices = samples
            if mark & 0x40:
                indices = np.empty_like(samples)
                indices[_rows_of(h)] = samples
            disposal, delay, clear = rule
            before = canvas.copy() if disposal == 3 else None
            if indices.size and int(indices.max()) >= len(colours):
                colours = np.concatenate([colours, np.zeros((256 - len(colours), 3), np.uint8)])
            own_h, own_w = max(0, min(h, high - top)), max(0, min(w, wide - left))
            area = canvas[top : top + own_h, left : left + own_w]
            painted = indices[:own_h, :own_w]
            colours = np.concatenate([colours, np.full((len(colours), 1), 255, np.uint8)], axis=1)
            if clear is None:
                area[:] = colours[painted]
            else:
                opaque = painted != clear
                area[opaque] = colours[painted[opaque]]
            yield Frame(left, top, w, h, delay, disposal, canvas)
            if disposal == 2:
                area[:] = 0
            elif disposal == 3:
                canvas = before
            rule = (0, 0, None)
        else:
            raise GifError(f"block {kind:#x}")


FRAMES = "array<struct<number:int,left:int,top:int,width:int,height:int,delay_ms:int,disposal:int,histogram:array<int>>>"


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` and ``media``: each whole text's UTF-8, padded with spaces, as a GIF.

    Null and empty texts become one row of spaces; null ids and repeated rows stay; long texts take as
    many frames as they need; an empty table gives an empty one; other columns aren't read.
    """
    bounded_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for part in cut_rows(batch, 1, PART_BYTES):
                texts = [t.as_py() for t in part.column(1)]
                media = [encode_samples(t.ljust(max(1, -(-len(t) // COLUMNS)) * COLUMNS)) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    return picked.mapInArrow(run, f"id {dict(picked.dtypes)['id']}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def media_columns(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """``id_col``, ``frames`` (rectangle, timing, disposal, colour histogram of each), ``samples`` (the red channel of each frame's rectangle as shown) and ``error``.

    Null media give null frames and samples; bytes that are no whole GIF give an ``error`` and nulls.
    Repeated rows are decoded each for itself; other columns aren't read.
    """
    bounded_batches(media.sparkSession)
    picked = media.select(F.col(id_col).alias("id"), F.col(media_col).alias("media"))
    names = ("number", "left", "top", "width", "height", "delay_ms", "disposal", "histogram")
    shape = pa.list_(pa.struct([(n, pa.list_(pa.int32()) if n == "histogram" else pa.int32()) for n in names]))

    def one(data: bytes | None):
        if data is None:
            return None, None, None
        frames, samples = [], []
        try:
            for i, f in enumerate(decode(data)):
                frames.append(dict(zip(names, (i, f.left, f.top, f.width, f.height, f.delay_ms, f.disposal, f.histogram()), strict=True)))
                samples.append(f.shown[f.top : f.top + f.height, f.left : f.left + f.width, 0].tobytes())
        except GifError as e:
            return None, None, str(e)
        return frames, b"".join(samples), None

    def run(batches):
        for batch in batches:
            for part in cut_rows(batch, 1, PART_BYTES):
                frames, samples, errors = zip(*(one(m.as_py()) for m in part.column(1)), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(frames, shape), pa.array(samples, pa.binary()), pa.array(errors, pa.string())], ["id", "frames", "samples", "error"])

    return picked.mapInArrow(run, f"id {dict(picked.dtypes)['id']}, frames {FRAMES}, samples binary, error string").withColumnRenamed("id", id_col)
