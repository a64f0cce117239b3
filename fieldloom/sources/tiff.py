"""GeoTIFF reading and writing: strips or tiles; uncompressed, deflate, LZW or PackBits; horizontal and floating-point predictors. Written are deflate files."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
_SIZES = {"B": 1, "s": 1, "H": 2, "I": 4, "b": 1, "h": 2, "i": 4, "f": 4, "d": 8, "Q": 8, "q": 8}
#: Stores whose files can be read in ranges; files in others are read whole.
_STORES = ("file", "hdfs", "s3", "s3a", "gs")


@dataclass
class Raster:
    """Pixels [bands, height, width] with their affine (a, b, c, d, e, f), EPSG code and no-data value."""

    data: np.ndarray
    transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)
    epsg: int | None = None
    nodata: float | None = None
    alpha: bool = False
    extra: dict = field(default_factory=dict)


class Ranges:
    """The bytes of a stored file, read where a slice asks for them."""

    def __init__(self, path: str):
        from pyarrow import fs

        scheme, _, place = path.partition(":")
        uri = "file://" + quote("/" + place.lstrip("/")) if scheme == "file" else path.replace("s3a:", "s3:", 1)
        system, place = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(place)

    def __getitem__(self, at: slice) -> bytes:
        return self.file.read_at(at.stop - (at.start or 0), at.start or 0)


def unpackbits(data: bytes) -> bytes:
    """Runs of literal and of repeated bytes."""
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 2 if n > 128 else 1
    return bytes(out)


def unlzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first; 256 clears the table, 257 ends; codes grow one entry early."""
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, last, bits, held, width = list(first), [], None, 0, 0, 9
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == 257:
            break
        if code == 256:
            table, last, width = list(first), None, 9
            continue
        if last is None:
            word = table[code]
        else:
            word = table[code] if code < len(table) else last + last[:1]
            table.append(last + word[:1])
        out.append(word)
        last = word
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return b"".join(out)


class Reader:
    """Reads the header once and then only the strips or tiles under a window. 64-bit files are read too."""

    def __init__(self, blob: bytes | Ranges):
        self.blob = blob
        head = blob[0:16]
        self.order = {b"II": "<", b"MM": ">"}.get(head[:2])
        version = struct.unpack_from(self.order + "H", head, 2)[0] if self.order and len(head) >= 8 else 0
        if version not in (42, 43):
            raise ValueError("not a baseline TIFF")
        self.big = version == 43
        tags = self._tags(struct.unpack_from(self.order + ("Q" if self.big else "I"), head, 8 if self.big else 4)[0])
        one = lambda t, default=None: tags[t][0] if t in tags else default
        self.width, self.height, self.bands = one(256), one(257), one(277, 1)
        self.compression, self.predictor, self.planar = one(259, 1), one(317, 1), one(284, 1)
        if self.compression not in (1, 5, 8, 32773, 32946) or self.predictor not in (1, 2, 3):
            raise ValueError(f"compression {self.compression} with predictor {self.predictor} isn't supported")
        bits, kind = one(258, 8), {1: "u", 2: "i", 3: "f"}[one(339, 1)]
        self.dtype = np.dtype(f"{self.order}{kind}{bits // 8}")
        self.tiled = 322 in tags
        self.block_w, self.block_h = (one(322), one(323)) if self.tiled else (self.width, min(one(278, self.height), self.height))
        self.offsets, self.counts = tags[324 if self.tiled else 273], tags[325 if self.tiled else 279]
        scale, tie, matrix = tags.get(33550), tags.get(33922), tags.get(34264)
        if matrix:
            self.transform = (matrix[0], matrix[1], matrix[3], matrix[4], matrix[5], matrix[7])
        elif scale and tie:
            self.transform = (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1])
        else:
            self.transform = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
        keys = tags.get(34735, ())
        codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
        self.epsg = codes.get(3072) or codes.get(2048)
        self.geographic = codes.get(1024) == 2
        nodata = tags.get(42113)
        self.nodata = float(nodata[0].rstrip(b"\0 ").decode()) if nodata and nodata[0].strip(b"\0 ") else None
        self.alpha = self.bands >= 4 and tags.get(338, (0,))[-1] in (1, 2)

    def _tags(self, at: int) -> dict[int, tuple]:
        n_code, word = ("Q", "Q") if self.big else ("H", "I")
        first, entry, inline = at + struct.calcsize(f"={n_code}"), struct.calcsize(f"=HH2{word}"), struct.calcsize(f"={word}")
        count = struct.unpack(self.order + n_code, self.blob[at:first])[0]
        table, out = self.blob[first : first + entry * count], {}
        for k in range(count):
            tag, kind, n = struct.unpack_from(f"{self.order}HH{word}", table, entry * k)
            code = _KINDS.get(kind)
            if code is None:
                continue
            size, cell = n * _SIZES[code], table[entry * (k + 1) - inline : entry * (k + 1)]
            if size > inline:
                place = struct.unpack(self.order + word, cell)[0]
                cell = self.blob[place : place + size]
            out[tag] = struct.unpack_from(f"{self.order}{n}{code}", cell)
        return out

    def _block(self, k: int, rows: int) -> np.ndarray:
        if not self.counts[k]:  # a block that was left out has no data
            return np.full((rows, self.block_w, self.bands if self.planar == 1 else 1), self.nodata or 0, self.dtype)
        raw = self.blob[self.offsets[k] : self.offsets[k] + self.counts[k]]
        if self.compression != 1:
            raw = {5: unlzw, 32773: unpackbits}.get(self.compression, zlib.decompress)(raw)
        samples = self.bands if self.planar == 1 else 1
        if self.predictor == 3:  # bytes of one significance stand together, the highest first, as differences along the row
            wide = self.dtype.itemsize
            b = np.frombuffer(raw, np.uint8, rows * self.block_w * samples * wide).reshape(rows, self.block_w * wide, samples)
            b = np.cumsum(b, axis=1, dtype=np.uint8).reshape(rows, wide, self.block_w * samples).transpose(0, 2, 1)
            return np.ascontiguousarray(b).view(self.dtype.newbyteorder(">")).reshape(rows, self.block_w, samples).astype(self.dtype)
        a = np.frombuffer(raw, self.dtype, rows * self.block_w * samples).reshape(rows, self.block_w, samples)
        return np.cumsum(a, axis=1, dtype=a.dtype) if self.predictor == 2 else a

    def read(self, row: int = 0, col: int = 0, height: int | None = None, width: int | None = None) -> np.ndarray:
        """[bands, height, width] of a window inside the raster."""
        height, width = height or self.height - row, width or self.width - col
        out = np.zeros((self.bands, height, width), self.dtype.newbyteorder("="))
        across, down = -(-self.width // self.block_w), -(-self.height // self.block_h)
        for plane in range(1 if self.planar == 1 else self.bands):
            for br in range(row // self.block_h, (row + height - 1) // self.block_h + 1):
                for bc in range(col // self.block_w, (col + width - 1) // self.block_w + 1):
                    rows = self.block_h if self.tiled else min(self.block_h, self.height - br * self.block_h)
                    a = self._block((plane * down + br) * across + bc, rows)
                    r0, r1 = max(row, br * self.block_h), min(row + height, br * self.block_h + rows)
                    c0, c1 = max(col, bc * self.block_w), min(col + width, (bc + 1) * self.block_w)
                    part = a[r0 - br * self.block_h : r1 - br * self.block_h, c0 - bc * self.block_w : c1 - bc * self.block_w]
                    bands = slice(None) if self.planar == 1 else slice(plane, plane + 1)
                    out[bands, r0 - row : r1 - row, c0 - col : c1 - col] = part.transpose(2, 0, 1)
        return out

    def raster(self) -> Raster:
        return Raster(self.read(), self.transform, self.epsg, self.nodata, self.alpha)


def encode(r: Raster, rows_per_strip: int = 64) -> bytes:
    """A little-endian GeoTIFF with deflated strips."""
    bands, height, width = r.data.shape
    dtype = r.data.dtype.newbyteorder("<")
    pixels = np.ascontiguousarray(r.data.transpose(1, 2, 0)).astype(dtype)
    strips = [zlib.compress(pixels[i : i + rows_per_strip].tobytes(), 6) for i in range(0, height, rows_per_strip)]
    a, _, c, _, e, f = r.transform
    tags: list[tuple[int, str, list]] = [
        (256, "I", [width]), (257, "I", [height]), (258, "H", [dtype.itemsize * 8] * bands), (259, "H", [8]), (262, "H", [2 if bands >= 3 else 1]),
        (273, "I", [0] * len(strips)), (277, "H", [bands]), (278, "I", [rows_per_strip]), (279, "I", [len(s) for s in strips]), (284, "H", [1]),
        (339, "H", [{"u": 1, "i": 2, "f": 3}[dtype.kind]] * bands), (33550, "d", [a, -e, 0.0]), (33922, "d", [0.0, 0.0, 0.0, c, f, 0.0]),
    ]
    if bands >= 4:
        tags.append((338, "H", [2 if r.alpha else 0]))
    if r.epsg:
        geographic = 4000 <= r.epsg < 5000
        tags.append((34735, "H", [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, 2048 if geographic else 3072, 0, 1, r.epsg]))
    if r.nodata is not None:
        tags.append((42113, "s", [f"{r.nodata:g}\0".encode()]))
    tags.sort(key=lambda t: t[0])
    kinds = {v: k for k, v in _KINDS.items()}
    base = 8 + 2 + 12 * len(tags) + 4

    def laid_out() -> tuple[bytes, bytes]:
        entries, tail = b"", b""
        for tag, code, values in tags:
            raw = values[0] if code == "s" else struct.pack(f"<{len(values)}{code}", *values)
            n = len(raw) if code == "s" else len(values)
            cell = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", base + len(tail))
            tail += b"" if len(raw) <= 4 else raw + b"\0" * (len(raw) % 2)
            entries += struct.pack("<HHI", tag, kinds[code], n) + cell
        return entries, tail

    at = base + len(laid_out()[1])
    places = next(t for t in tags if t[0] == 273)[2]
    for i, s in enumerate(strips):
        places[i] = at
        at += len(s)
    entries, tail = laid_out()
    return struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", len(tags)) + entries + b"\0" * 4 + tail + b"".join(strips)


def tile_windows(width: int, height: int, size: int, overlap: int, row: int | None = None) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row_idx, col_idx, row_off, col_off, height, width) of the overlapping grid, or of one row of it."""
    step = size - overlap
    for r in range(-(-(height - overlap) // step)) if row is None else (row,):
        for c in range(-(-(width - overlap) // step)):
            yield r, c, r * step, c * step, min(size, height - r * step), min(size, width - c * step)


TILE_SCHEMA = "path string, row_idx int, col_idx int, stem string, row_off int, col_off int, actual_h int, actual_w int, bands int, dtype string, transform array<double>, epsg int, valid_frac double, data binary"


def valid_fraction(data: np.ndarray, nodata: float | None, alpha: bool) -> float:
    """Share of valid pixels of an unpadded window: by the no-data value in band 1, else by alpha, else all."""
    if nodata is not None:
        return float((data[0] != nodata).mean())
    return float((data[3] > 0).mean()) if alpha and len(data) > 3 else 1.0


def read_tiles(spark: SparkSession, path: str, size: int = 512, overlap: int = 64, min_valid: float = 0.1, pad: bool = True) -> DataFrame:
    """Overlapping tiles of all GeoTIFFs under a path: one row per tile that has enough valid pixels, padded with 0.

    Files in a store that can be read in ranges are parted into rows of tiles, which are spread over the tasks, so that
    one large raster keeps a whole cluster busy and no task holds more than a tile. Files in other stores are read whole,
    one per task. Geographic rasters are refused.
    """
    names = [x.split()[0] for x in TILE_SCHEMA.split(", ")]

    def checked(file: str, blob: bytes | Ranges) -> Reader:
        r = Reader(blob)
        if r.geographic:
            raise ValueError(f"{file}: a projected reference system is needed")
        return r

    def cut(file: str, r: Reader, windows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        a, b, c, d, e, f = r.transform
        for ri, ci, y, x, h, w in windows:
            data = r.read(y, x, h, w)
            share = valid_fraction(data, r.nodata, r.alpha)
            if share < min_valid:
                continue
            if pad and (h < size or w < size):
                data = np.pad(data, ((0, 0), (0, size - h), (0, size - w)))
            at = [a, b, c + a * x + b * y, d, e, f + d * x + e * y]
            row = (file, ri, ci, f"tile_r{ri:04d}_c{ci:04d}", y, x, h, w, r.bands, data.dtype.str, at, r.epsg, share, data.tobytes())
            yield pd.DataFrame([row], columns=names)

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, blob in zip(frame["path"], frame["content"]):
                r = checked(file, bytes(blob))
                yield from cut(file, r, tile_windows(r.width, r.height, size, overlap))

    def tile_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file in frame["path"]:
                r = checked(file, Ranges(file))
                rows = [w[0] for w in tile_windows(1 + overlap, r.height, size, overlap)]
                yield pd.DataFrame({"path": [file] * len(rows), "row_idx": rows})

    def ranged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, r = None, None
        for frame in frames:
            for path, row in zip(frame["path"], frame["row_idx"]):
                if path != file:
                    file, r = path, checked(path, Ranges(path))
                yield from cut(file, r, tile_windows(r.width, r.height, size, overlap, row))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif*").option("recursiveFileLookup", "true").load(path)
    one = files.select("path").first()
    if one is None or one[0].partition(":")[0] not in _STORES:
        return files.select("path", "content").mapInPandas(whole, TILE_SCHEMA)
    tasks = max(spark.sparkContext.defaultParallelism, files.agg({"length": "sum"}).first()[0] // (64 << 20))
    return files.select("path").mapInPandas(tile_rows, "path string, row_idx int").repartition(int(tasks), "path", "row_idx").mapInPandas(ranged, TILE_SCHEMA)


def tile_array(data: bytes, dtype: str, bands: int, size: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(dtype)).reshape(bands, size, size)


def rgb_uint8(data: np.ndarray) -> np.ndarray:
    """[height, width, 3] in bytes; other types are scaled by their own maximum, one band is repeated."""
    rgb = data[:3] if len(data) >= 3 else np.repeat(data[:1], 3, axis=0)
    if rgb.dtype != np.uint8:
        top = float(rgb.max()) or 1.0
        rgb = np.clip(rgb.astype(np.float64) / top * 255, 0, 255).astype(np.uint8)
    return rgb.transpose(1, 2, 0)


def mosaic(tiles: DataFrame, width: int, height: int, size: int, overlap: int, band: int = 0, block: int = 512) -> DataFrame:
    """(block_row, block_col, height, width, dtype, data): a raster put together from tiles, later ones over earlier ones by row, then column.

    Tiles are dealt to the blocks that they touch, so a task holds one block at a time.
    """
    from pyspark.sql import functions as F

    def assemble(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        br, bc = key
        h, w = min(block, height - br * block), min(block, width - bc * block)
        out = None
        for t in rows.sort_values(["row_idx", "col_idx"]).itertuples():
            a = tile_array(t.data, t.dtype, t.bands, size)[band, : t.actual_h, : t.actual_w]
            out = np.zeros((h, w), a.dtype) if out is None else out
            y0, y1 = max(t.row_off, br * block), min(t.row_off + t.actual_h, br * block + h)
            x0, x1 = max(t.col_off, bc * block), min(t.col_off + t.actual_w, bc * block + w)
            out[y0 - br * block : y1 - br * block, x0 - bc * block : x1 - bc * block] = a[y0 - t.row_off : y1 - t.row_off, x0 - t.col_off : x1 - t.col_off]
        return pd.DataFrame([(br, bc, h, w, out.dtype.str, out.tobytes())], columns=["block_row", "block_col", "height", "width", "dtype", "data"])

    over = lambda off, n: F.sequence(F.floor(F.col(off) / block).cast("int"), F.floor((F.col(off) + F.col(n) - 1) / block).cast("int"))
    dealt = tiles.withColumn("block_row", F.explode(over("row_off", "actual_h"))).withColumn("block_col", F.explode(over("col_off", "actual_w")))
    return dealt.groupBy("block_row", "block_col").applyInPandas(assemble, "block_row int, block_col int, height int, width int, dtype string, data binary")


def write_blocks(blocks: DataFrame, path: str, scratch, width: int, height: int, block: int, bands: int, dtype: str, transform: tuple[float, ...], epsg: int | None = None, nodata: float | None = None) -> None:
    """One tiled GeoTIFF from rows (block_row, block_col, height, width, data), blocks that are missing have no data.

    Blocks are deflated on the executors and written to the shared folder; the driver copies them one after the other
    into the file (on a mounted path), so it holds one partition at a time. ``block`` is a multiple of 16. Files that may
    pass 4 GB get 64-bit offsets. The file appears under its name when it is whole.
    """
    if block % 16:
        raise ValueError("the block size must be a multiple of 16")
    kind, across = np.dtype(dtype).newbyteorder("<"), -(-width // block)
    n = across * -(-height // block)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for b in f.itertuples():
                full = np.full((block, block, bands), nodata or 0, kind)
                full[: b.height, : b.width] = np.frombuffer(b.data, np.dtype(dtype)).reshape(bands, b.height, b.width).transpose(1, 2, 0)
                yield pd.DataFrame([(b.block_row * across + b.block_col, zlib.compress(full.tobytes(), 6))], columns=["k", "z"])

    packed = scratch.save(blocks.select("block_row", "block_col", "height", "width", "data").mapInPandas(pack, "k long, z binary"))
    big = n * (block * block * bands * kind.itemsize + 64) > 3_500_000_000
    word, inline = ("Q", 8) if big else ("I", 4)
    a, _, c, _, e, f0 = transform
    places, counts = [0] * n, [0] * n
    draft = f"{path}.part"
    with open(draft, "wb") as out:
        out.write(b"\0" * 16)
        for r in packed.toLocalIterator(prefetchPartitions=True):
            places[r["k"]], counts[r["k"]] = out.tell(), len(r["z"])
            out.write(r["z"])
        tags: list[tuple[int, str, list]] = [
            (256, "I", [width]), (257, "I", [height]), (258, "H", [kind.itemsize * 8] * bands), (259, "H", [8]), (262, "H", [2 if bands >= 3 else 1]),
            (277, "H", [bands]), (284, "H", [1]), (322, "I", [block]), (323, "I", [block]), (324, word, places), (325, word, counts),
            (339, "H", [{"u": 1, "i": 2, "f": 3}[kind.kind]] * bands), (33550, "d", [a, -e, 0.0]), (33922, "d", [0.0, 0.0, 0.0, c, f0, 0.0]),
        ]
        if bands >= 4:
            tags.append((338, "H", [0] * (bands - 3)))
        if epsg:
            geographic = 4000 <= epsg < 5000
            tags.append((34735, "H", [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, 2048 if geographic else 3072, 0, 1, epsg]))
        if nodata is not None:
            tags.append((42113, "s", [f"{nodata:g}\0".encode()]))
        kinds, entries = {v: k for k, v in _KINDS.items()}, b""
        for tag, code, values in sorted(tags, key=lambda t: t[0]):
            raw = values[0] if code == "s" else struct.pack(f"<{len(values)}{code}", *values)
            cell = raw.ljust(inline, b"\0")
            if len(raw) > inline:
                out.write(b"\0" * (out.tell() % 2))
                cell = struct.pack(f"<{word}", out.tell())
                out.write(raw)
            entries += struct.pack(f"<HH{word}", tag, kinds[code], len(raw) if code == "s" else len(values)) + cell
        out.write(b"\0" * (out.tell() % 2))
        at = out.tell()
        out.write(struct.pack("<Q" if big else "<H", len(tags)) + entries + b"\0" * inline)
        out.seek(0)
        out.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI", b"II", 42, at))
    os.replace(draft, path)
