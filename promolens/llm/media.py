"""Media columns: Netpbm and BMP decoding, integral-image resizing, NPY tiles, difference hashes."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame

from promolens.llm.common import doc_texts, map_rows

#: Samples a row of a stored text, and the tile from which the difference hash is taken.
WIDTH, TILE = 64, (8, 9)
#: Rows summed at once, so that a huge image needs no integral image of its whole size.
BLOCK_ROWS = 4096


def encode_pgm(payload: bytes, width: int = WIDTH) -> bytes:
    """Lossless 8-bit grey Netpbm (P5) of a payload that is a positive multiple of width."""
    return b"P5\n%d %d\n255\n" % (width, len(payload) // width) + payload


_HEADER = re.compile(rb"P([56])(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)\s")


def decode_netpbm(stored: bytes) -> np.ndarray:
    """P5 or P6 with 8-bit samples as (rows, columns[, 3]); ValueError for anything else."""
    m = _HEADER.match(stored)
    if not m or not 0 < int(m[4]) < 256:
        raise ValueError("not an 8-bit P5 or P6 image")
    depth, width, height = 1 if m[1] == b"5" else 3, int(m[2]), int(m[3])
    if len(stored) - m.end() < width * height * depth:
        raise ValueError("image data is cut short")
    out = np.frombuffer(stored, np.uint8, width * height * depth, m.end())
    return out.reshape((height, width) if depth == 1 else (height, width, 3))


def encode_bmp(grey: np.ndarray) -> bytes:
    """8-bit palette BMP, rows from the bottom up, padded to four bytes."""
    height, width = grey.shape
    row = (width + 3) // 4 * 4
    body = np.zeros((height, row), np.uint8)
    body[:, :width] = grey[::-1]
    palette = b"".join(bytes((k, k, k, 0)) for k in range(256))
    at = 14 + 40 + len(palette)
    return struct.pack("<2sIHHI", b"BM", at + body.size, 0, 0, at) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8, 0, body.size, 2835, 2835, 256, 0) + palette + body.tobytes()


def decode_bmp(stored: bytes) -> np.ndarray:
    """Uncompressed 8-bit (palette) or 24-bit BMP; ValueError for anything else."""
    if len(stored) < 54 or stored[:2] != b"BM":
        raise ValueError("not a BMP")
    at, head = struct.unpack_from("<I", stored, 10)[0], struct.unpack_from("<IiiHHI", stored, 14)
    size, width, height, _, bits, packed = head
    if packed or bits not in (8, 24):
        raise ValueError("only uncompressed 8 and 24 bit BMP")
    row = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(stored, np.uint8, row * abs(height), at).reshape(abs(height), row)
    rows = rows[::-1] if height > 0 else rows
    if bits == 24:
        return rows[:, : width * 3].reshape(abs(height), width, 3)[:, :, ::-1]
    used = struct.unpack_from("<I", stored, 46)[0] or 256
    palette = np.frombuffer(stored, np.uint8, used * 4, 14 + size).reshape(used, 4)[:, 2::-1]
    out = palette[np.minimum(rows[:, :width], used - 1)]
    return out[:, :, 0] if (out == out[:, :, :1]).all() else out


def decode(stored: bytes) -> np.ndarray:
    return decode_bmp(stored) if stored[:2] == b"BM" else decode_netpbm(stored)


def area_resize(image: np.ndarray, shape: tuple[int, int] = TILE) -> np.ndarray:
    """Area means on a grid, from integral images of row blocks with exact fractional edges."""
    grey = image if image.ndim == 2 else image.mean(axis=2)
    height, width = grey.shape
    rows, cols = (np.linspace(0, n, k + 1) for n, k in zip((height, width), shape, strict=True))

    def at(table: np.ndarray, where: np.ndarray) -> np.ndarray:
        low = np.minimum(np.floor(where).astype(int), table.shape[0] - 1)
        high = np.minimum(low + 1, table.shape[0] - 1)
        return table[low] + (where - low)[:, None] * (table[high] - table[low])

    edges, above = np.zeros((shape[0] + 1, width + 1)), np.zeros(width + 1)
    for top in range(0, height, BLOCK_ROWS):
        block = grey[top : top + BLOCK_ROWS].astype(np.float64)
        integral = np.zeros((block.shape[0] + 1, width + 1))
        integral[1:, 1:] = block.cumsum(0).cumsum(1)
        integral += above
        inside = (rows >= top) & (rows <= top + block.shape[0])
        edges[inside] = at(integral, rows[inside] - top)
        above = integral[-1]
    corners = at(edges.T, cols).T
    sums = corners[1:, 1:] - corners[:-1, 1:] - corners[1:, :-1] + corners[:-1, :-1]
    return sums / ((rows[1] - rows[0]) * (cols[1] - cols[0]))


def npy_tile(tile: np.ndarray) -> bytes:
    """The tile as an NPY file of unsigned bytes."""
    out = io.BytesIO()
    np.save(out, np.clip(np.floor(tile + 0.5), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def difference_hash(tile: np.ndarray) -> str:
    """A bit for each pair of neighbours in a row: is the right one lighter? As hex."""
    bits = np.packbits((np.round(tile[:, 1:], 6) > np.round(tile[:, :-1], 6)).ravel())
    return bits.tobytes().hex()


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and they padded with zeros to a positive multiple of 64."""
    raw = (text or "").encode()
    return len(raw), raw + bytes(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH) - len(raw))


def store_texts(docs: DataFrame) -> DataFrame:
    """Operator: doc_id, n_bytes, media (PGM), tile (NPY) and difference hash of each row.

    Null and empty texts are one row of 64 zeros; equal texts give equal media; repeated
    rows stay rows; no rows in, none out. Texts of any length keep all their bytes.
    """

    def run(rows):
        out = {k: [] for k in ("doc_id", "n_bytes", "media", "tile", "dhash")}
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            n, payload = payload_of(text)
            media = encode_pgm(payload)
            tile = area_resize(decode(media))
            for k, v in zip(out, (doc_id, n, media, npy_tile(tile), difference_hash(tile)), strict=True):
                out[k].append(v)
        return out

    return map_rows(doc_texts(docs), run, "doc_id long, n_bytes long, media binary, tile binary, dhash string")


def digest_media(stored: DataFrame) -> DataFrame:
    """Reads stored media back: what the samples hold, and the media's own digests."""

    def run(rows):
        out = {k: [] for k in ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
        for doc_id, n, media, tile, dhash in zip(*(rows[k] for k in ("doc_id", "n_bytes", "media", "tile", "dhash")), strict=True):
            back = decode(media).tobytes()
            feature = f"{dhash}:{hashlib.sha256(tile).hexdigest()[:16]}"
            row = (doc_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature)
            for k, v in zip(out, row, strict=True):
                out[k].append(v)
        return out

    return map_rows(stored, run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
