"""Media columns: Netpbm and BMP images as NumPy arrays, area-resized by integral images, cut into NPY tiles with difference hashes."""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 32
TILE = 16
WIDTH = 64
_TOKEN = re.compile(rb"(?:\s|#[^\n]*\n)*([0-9]+)")
_BAND = 256


def _header(data: bytes, at: int, n: int) -> tuple[list[int], int]:
    out = []
    for _ in range(n):
        m = _TOKEN.match(data, at)
        if not m:
            raise ValueError("bad header")
        out.append(int(m.group(1)))
        at = m.end()
    return out, at


def _scaled(values: np.ndarray, most: int) -> np.ndarray:
    if not 0 < most < 65536 or (values > most).any():
        raise ValueError("bad sample")
    return values.astype(np.uint8) if most == 255 else ((values.astype(np.int64) * 510 + most) // (2 * most)).astype(np.uint8)


def decode_netpbm(data: bytes) -> np.ndarray:
    """uint8 (height, width) or (height, width, 3) of a P1 to P6 image; samples are scaled to 255, set bits of bitmaps are black."""
    kind = data[1:2]
    if data[:1] != b"P" or kind not in b"123456" or not kind:
        raise ValueError("not Netpbm")
    bitmap, colour, plain = kind in b"14", kind in b"36", kind in b"123"
    head, at = _header(data, 2, 2 if bitmap else 3)
    w, h = head[:2]
    if not w or not h:
        raise ValueError("bad size")
    shape = (h, w, 3) if colour else (h, w)
    n = w * h * (3 if colour else 1)
    if plain:
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        values = np.array([int(c) for c in re.findall(rb"[01]", body)[:n]] if bitmap else [int(x) for x in body.split()[:n]], np.int64)
        if len(values) < n:
            raise ValueError("too short")
        return ((1 - values) * 255).astype(np.uint8).reshape(shape) if bitmap else _scaled(values, head[2]).reshape(shape)
    at += 1
    if bitmap:
        row = (w + 7) // 8
        raw = np.frombuffer(data, np.uint8, row * h, at).reshape(h, row)
        return (1 - np.unpackbits(raw, axis=1)[:, :w]) * np.uint8(255)
    values = np.frombuffer(data, np.uint8 if head[2] < 256 else ">u2", n, at)
    return _scaled(values, head[2]).reshape(shape)


def decode_bmp(data: bytes) -> np.ndarray:
    """uint8 (height, width) if the palette or image is grey, else (height, width, 3), of an uncompressed BMP of 1, 4, 8, 24 or 32 bits."""
    if data[:2] != b"BM":
        raise ValueError("not BMP")
    offset, size, w, h, _, bits, packing = struct.unpack_from("<I I i i H H I", data, 10)
    if w <= 0 or h == 0 or packing or bits not in (1, 4, 8, 24, 32):
        raise ValueError("unsupported BMP")
    row = (w * bits + 31) // 32 * 4
    raw = np.frombuffer(data, np.uint8, row * abs(h), offset).reshape(abs(h), row)
    if h > 0:
        raw = raw[::-1]
    if bits >= 24:
        return np.ascontiguousarray(raw[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1])
    used = struct.unpack_from("<I", data, 46)[0] or 1 << bits
    palette = np.frombuffer(data, np.uint8, used * 4, 14 + size).reshape(used, 4)[:, 2::-1]
    if bits == 8:
        index = raw[:, :w]
    elif bits == 4:
        index = np.stack([raw >> 4, raw & 15], axis=2).reshape(abs(h), -1)[:, :w]
    else:
        index = np.unpackbits(raw, axis=1)[:, :w]
    if (index >= used).any():
        raise ValueError("bad palette index")
    grey = (palette[:, 0] == palette[:, 1]) & (palette[:, 1] == palette[:, 2])
    return palette[:, 0][index] if grey.all() else palette[index]


def decode_image(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_netpbm(image: np.ndarray) -> bytes:
    kind = b"P6" if image.ndim == 3 else b"P5"
    return kind + b"\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + image.tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    h, w = image.shape[:2]
    bits = 24 if image.ndim == 3 else 8
    rows = (image[:, :, ::-1].reshape(h, w * 3) if bits == 24 else image)[::-1]
    rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 4)))
    palette = b"" if bits == 24 else np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).copy()
    if bits == 8:
        palette[:, 3] = 0
        palette = palette.tobytes()
    at = 54 + len(palette)
    return b"BM" + struct.pack("<IHHI", at + rows.size, 0, 0, at) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, bits, 0, rows.size, 0, 0, 0, 0) + palette + rows.tobytes()


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """float64 means over the areas that the pixels of the new size cover, by differences of the integral image.

    Between whole pixels the integral image is linear in each direction, so
    fractional areas are exact as well; sizes may grow or shrink.
    The image is read in bands of rows, so the integral image of a large one is never held at once.
    """
    h, w = image.shape[:2]

    def along(total: np.ndarray, n: int, m: int) -> np.ndarray:
        """Differences of running sums (n + 1, ...) at m + 1 evenly spaced places, fractions included."""
        num = np.arange(m + 1) * n
        low = np.minimum(num // m, n - 1)
        share = ((num - low * m) / m).reshape(-1, *[1] * (total.ndim - 1))
        at = total[low]
        at = at + (total[low + 1] - at) * share
        return at[1:] - at[:-1]

    def running(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x) + 1, *x.shape[1:]))
        np.cumsum(x, axis=0, dtype=np.float64, out=out[1:])
        return out

    bands = [along(running(np.swapaxes(image[y : y + _BAND], 0, 1)), w, width) for y in range(0, h, _BAND)]
    columns = np.concatenate(bands, axis=1)  # (width, h, ...): sums over the new columns
    cells = along(running(np.swapaxes(columns, 0, 1)), h, height)
    return cells / (h * w / (height * width))


def to_bytes(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values + 0.5 + 1e-9), 0, 255).astype(np.uint8)


def difference_hash(image: np.ndarray) -> int:
    """64 bits as a signed integer: whether each of 8 x 9 area means of the grey image is greater than its right neighbour."""
    grey = image @ np.array([0.299, 0.587, 0.114]) if image.ndim == 3 else image
    small = np.round(area_resize(grey, 8, 9), 6)
    bits = np.packbits((small[:, :-1] > small[:, 1:]).ravel())
    return int(bits.view(">i8")[0])


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(array), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def _npy_head(shape: tuple[int, ...]) -> bytes:
    return npy(np.zeros(shape, np.uint8))[: -int(np.prod(shape))]


def _tile_rows(batches: Iterator[pa.RecordBatch], side: int, tile: int) -> Iterator[pa.RecordBatch]:
    heads: dict[tuple[int, ...], bytes] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out: list[tuple] = []
            for ident, data in zip(part.column(0).to_pylist(), part.column(1)):
                try:
                    image = decode_image(data.as_buffer().to_pybytes() if data.is_valid else b"")
                except (ValueError, struct.error) as e:
                    out.append((ident, None, None, None, None, None, None, str(e)[:80] or "bad image"))
                    continue
                small = to_bytes(area_resize(image, side, side))
                code = difference_hash(image)
                for y in range(0, side, tile):
                    for x in range(0, side, tile):
                        cell = np.ascontiguousarray(small[y : y + tile, x : x + tile])
                        if cell.shape not in heads:
                            heads[cell.shape] = _npy_head(cell.shape)
                        out.append((ident, image.shape[1], image.shape[0], code, y // tile, x // tile, heads[cell.shape] + cell.tobytes(), None))
            types = [batch.schema.types[0], pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
            names = ["media_id", "width", "height", "dhash", "tile_row", "tile_col", "npy", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def media_tiles(media: DataFrame, id_col: str = "media_id", content_col: str = "content", *, side: int = SIDE, tile: int = TILE) -> DataFrame:
    """(media_id, width, height, dhash, tile_row, tile_col, npy, error): the tiles of each image, each a complete NPY file.

    Images are resized to ``side`` by ``side`` pixels; grey ones give two
    dimensions, others three. ``dhash`` is of the image as it came. What is no
    image that can be decoded, null and empty content included, gives one row with
    the reason in ``error`` and nulls. A null id is kept; repeated rows give their
    tiles each; equal neighbours count as not greater in the hash; an empty table
    gives no row; other columns are ignored.
    """
    rows = media.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{content_col}`").cast("binary"))
    return rows.mapInArrow(
        lambda it: _tile_rows(it, side, tile), "media_id bigint, width int, height int, dhash bigint, tile_row int, tile_col int, npy binary, error string"
    )


def save_tiles(tiles: DataFrame, folder: str) -> DataFrame:
    """Writes each tile to ``folder``/{media_id}_{tile_row}_{tile_col}.npy on a file system all executors share; (path, bytes) of each.

    Rows without a tile, those of images with an error, are left out; a null id is
    written as None; of repeated rows the last one written stays; an empty table
    writes nothing; other columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes = [], []
            for ident, y, x, data in zip(*(c.to_pylist() for c in batch.columns)):
                paths.append(f"{folder}/{ident}_{y}_{x}.npy")
                with open(paths[-1], "wb") as f:
                    f.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return tiles.where("npy IS NOT NULL").select("media_id", "tile_row", "tile_col", "npy").mapInArrow(rows, "path string, bytes bigint")


def _rendered_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text bytes as pixels, 64 to a row, in one of four formats by the id."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            content = []
            for ident, text in zip(part.column(0).to_pylist(), part.column(1)):
                raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid and len(text.as_buffer()) else np.zeros(1, np.uint8)
                kind = (ident or 0) % 4
                unit = WIDTH * (3 if kind % 2 else 1)
                image = np.pad(raw, (0, -len(raw) % unit)).reshape(-1, WIDTH, 3) if kind % 2 else np.pad(raw, (0, -len(raw) % unit)).reshape(-1, WIDTH)
                content.append(encode_netpbm(image) if kind < 2 else encode_bmp(image))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(content, pa.binary())], names=["media_id", "content"])


def rendered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(media_id, content): an image of each whole text, as the test tables have no images: PGM, PPM or grey or coloured BMP."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("binary"))
    return rows.mapInArrow(_rendered_rows, "media_id bigint, content binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_tiles(rendered(spark.read.parquet(f"{sf_dir}/documents.parquet")))
