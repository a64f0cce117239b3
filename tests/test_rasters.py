import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import geometry as g
from fieldloom.operators import models, polygons
from fieldloom.sources import tiff

SIZE, OVERLAP = 64, 16


@pytest.fixture(scope="module")
def ortho(tmp_path_factory):
    y, x = np.mgrid[0:150, 0:200]
    data = np.stack([(x // 8 + y // 8) % 2 * 100 + 50, x % 200, y % 200]).astype(np.uint8)
    data[:, :, 180:] = 0
    data[0, :, 180:] = 7
    r = tiff.Raster(data, (0.05, 0.0, 500000.0, 0.0, -0.05, 4000000.0), 32755, nodata=7)
    folder = tmp_path_factory.mktemp("ortho")
    (folder / "a.tif").write_bytes(tiff.encode(r))
    return str(folder), r


def test_codec(ortho):
    _, r = ortho
    for data in (r.data, r.data[:1].astype(np.int16) - 100, r.data[:2].astype(np.float32) / 3):
        back = tiff.Reader(tiff.encode(tiff.Raster(data, r.transform, 32755, 7)))
        assert (back.read() == data).all() and back.transform == r.transform and (back.epsg, back.nodata) == (32755, 7)
        assert (back.read(10, 20, 90, 33) == data[:, 10:100, 20:53]).all()


def test_mosaic_of_tiles_is_the_raster(spark, ortho):
    path, r = ortho
    tiles = tiff.read_tiles(spark, path, SIZE, OVERLAP, 0.0)
    assert tiles.count() == 3 * 4 and {t["stem"] for t in tiles.select("stem").collect()} >= {"tile_r0000_c0000", "tile_r0002_c0003"}
    out = np.zeros(r.data.shape[1:], np.uint8)
    for b in tiff.mosaic(tiles, 200, 150, SIZE, OVERLAP, 1, 100).collect():
        y, x = b["block_row"] * 100, b["block_col"] * 100
        out[y : y + b["height"], x : x + b["width"]] = np.frombuffer(b["data"], b["dtype"]).reshape(b["height"], b["width"])
    assert (out == r.data[1]).all()


def test_valid_share_is_that_of_the_unpadded_window(spark, ortho):
    share = {t["stem"]: t["valid_frac"] for t in tiff.read_tiles(spark, ortho[0], SIZE, OVERLAP, 0.1).collect()}
    assert share["tile_r0000_c0000"] == 1.0 and share["tile_r0000_c0003"] == pytest.approx((180 - 144) / 56)


def test_inference_averages_overlaps_and_ties_go_low(spark, ortho):
    tiles = tiff.read_tiles(spark, ortho[0], SIZE, OVERLAP, 0.0)
    make = lambda: lambda rgb: np.stack([np.zeros(rgb.shape[:2]), (rgb[:, :, 1] > 100) * 1.0, np.zeros(rgb.shape[:2])])
    out = np.zeros((150, 200), np.uint8)
    for b in models.infer(tiles, 200, 150, SIZE, OVERLAP, 3, make, 64).collect():
        out[b["block_row"] * 64 :, b["block_col"] * 64 :][: b["height"], : b["width"]] = np.frombuffer(b["data"], np.uint8).reshape(b["height"], b["width"])
    assert (out == (ortho[1].data[1] > 100)).all()


def test_features_skip_what_is_done(spark, ortho):
    tiles = tiff.read_tiles(spark, ortho[0], SIZE, OVERLAP, 0.1)
    f = models.extract_features(tiles, SIZE)
    assert f.filter("stem = 'tile_r0000_c0000'").count() == (SIZE // 14) ** 2
    assert models.extract_features(tiles, SIZE, done=f).count() == 0


def test_pseudolabels(spark):
    cells = spark.createDataFrame([("t", r, c, r * 2 + c) for r in range(2) for c in range(2)], "stem string, pr int, pc int, cluster_id int")
    m = models.pseudolabels(models.cluster_map(cells, 5, 2), {1: 3, 3: 1})
    a = np.frombuffer(m.first()["data"], np.uint8).reshape(5, 5)
    assert a[0].tolist() == [0, 0, 0, 3, 3] and a[4].tolist() == [0, 0, 0, 1, 1]
    assert {r["cls"]: r["n"] for r in models.byte_counts(m.select("data")).collect()} == {0: 15, 1: 4, 3: 6}


def test_confusion(spark):
    df = spark.createDataFrame([(bytes([0, 1, 255, 1]), bytes([0, 0, 1, 1]))], "truth binary, pred binary")
    assert {(r["t"], r["p"]): r["n"] for r in models.confusion(df).collect()} == {(0, 0): 1, (1, 0): 1, (1, 1): 1}


def test_burn_prefers_band_then_layer(spark):
    rows = [(g.write_wkb(g.box(0, 0, 6, 6)), 1, 1.0, 1), (g.write_wkb(g.box(3, 3, 9, 9)), 2, 1.0, 2), (g.write_wkb(g.box(5, 5, 7, 7)), 3, 2.0, 3)]
    df = polygons.with_bounds(spark.createDataFrame(rows, "wkb binary, v int, band double, ord int"))
    out = np.full((10, 10), 255)
    for b in polygons.burn(df, 10, 10, (1, 0, 0, 0, 1, 0), "v", "band", "ord", 4).collect():
        out[b["block_row"] * 4 :, b["block_col"] * 4 :][: b["height"], : b["width"]] = np.frombuffer(b["data"], np.uint8).reshape(b["height"], b["width"])
    assert out[4, 4] == 1 and out[5, 5] == 3 and out[8, 8] == 2 and out[9, 9] == 255 and out[0, 7] == 255


def test_polygonize_parts_regions_by_their_sides(spark, scratch):
    a = np.array([[1, 1, 0, 2], [1, 0, 1, 2], [1, 1, 0, 2], [1, 1, 1, 1]])
    cells = spark.createDataFrame([(int(y), int(x), int(a[y, x])) for y in range(4) for x in range(4)], "y long, x long, label int")
    got = polygons.polygonize(cells, "label", scratch).collect()
    assert sorted((r["label"], r["cells"], r["area"]) for r in got) == [(0, 1, 1.0), (0, 1, 1.0), (0, 1, 1.0), (1, 1, 1.0), (1, 9, 9.0), (2, 3, 3.0)]
    assert polygons.polygonize(cells, "label", scratch, 3).count() == 2


def test_warp_identity_and_overview(spark, ortho):
    rd = tiff.Reader(tiff.encode(ortho[1]))
    assert (models.warp_window(rd, rd.transform, 10, 20, 30, 40) == ortho[1].data[:, 10:40, 20:60]).all()
    df = spark.createDataFrame([(0, 0, 2, 3, bytes([1, 3, 9, 5, 7, 255]))], "block_row int, block_col int, height int, width int, data binary")
    r = models.overview(df, 2, 255).first()
    assert (r["height"], r["width"], list(r["data"])) == (1, 2, [4, 9])


def test_region_names_are_stable(spark, scratch):
    cells = spark.range(40).select((F.col("id") / 8).cast("long").alias("y"), (F.col("id") % 8).alias("x"), F.lit(1).alias("label"))
    assert polygons.label_regions(cells, "label", scratch).select("region").distinct().count() == 1


def test_a_large_file_is_read_in_ranges_and_written_by_blocks(spark, scratch, ortho, tmp_path):
    folder, r = ortho
    assert (tiff.Reader(tiff.Ranges(f"file:{folder}/a.tif")).read(5, 7, 40, 50) == r.data[:, 5:45, 7:57]).all()
    blocks = models.warp(spark, f"file:{folder}/a.tif", r.transform, 200, 150, block=64)
    assert blocks.count() == 12
    out = str(tmp_path / "b.tif")
    tiff.write_blocks(blocks.filter("block_row <> 1 or block_col <> 1"), out, scratch, 200, 150, 64, 3, "u1", r.transform, 32755, 7)
    back = tiff.Reader(open(out, "rb").read())
    want = r.data.copy()
    want[:, 64:128, 64:128] = 7
    assert (back.read() == want).all() and (back.transform, back.epsg, back.nodata) == (r.transform, 32755, 7)


def test_64_bit_files(spark, scratch, ortho, tmp_path, monkeypatch):
    _, r = ortho
    rows = [(0, 0, 150, 200, r.data.tobytes())]
    blocks = spark.createDataFrame(rows, "block_row int, block_col int, height int, width int, data binary")
    out = str(tmp_path / "big.tif")
    # a grid that could pass 4 GB: one block is there, the others are left out
    tiff.write_blocks(blocks, out, scratch, 40000, 30000, 208, 3, "u1", r.transform, 32755)
    back = tiff.Reader(tiff.Ranges(f"file:{out}"))
    assert back.big and (back.read(0, 0, 150, 200) == r.data).all() and not back.read(29000, 39000, 300, 300).any()


def test_a_geographic_raster_is_made_projected():
    lon, lat, step = 147.0, -36.0, 1e-4
    y, x = np.mgrid[0:40, 0:60]
    rd = tiff.Reader(tiff.encode(tiff.Raster((x * 2 + y)[None].astype(np.float32), (step, 0.0, lon, 0.0, -step, lat), 4326)))
    epsg, target, width, height, back = models.target_grid(rd, 10.0)
    assert epsg == 32755 and abs(width * 10 - 60 * step * 111320 * np.cos(np.radians(lat))) < 30 and abs(height * 10 - 40 * step * 110950) < 30
    a = models.warp_window(rd, target, height // 2, width // 2, 1, 1, back)[0, 0, 0]
    px = back(target[2] + (width // 2 + 0.5) * 10, target[5] - (height // 2 + 0.5) * 10)
    assert models.target_grid(rd, 5.0)[1][0] == pytest.approx(models.pixel_size(rd)) == pytest.approx(9.0, abs=0.1)  # never made finer
    assert a == pytest.approx(((px[0] - lon) / step - 0.5) * 2 + (lat - px[1]) / step - 0.5, abs=0.01)


def lzw(data):
    """A plain encoder: 9 to 12 bits, high bits first, a clear code at the start and when the table is full."""
    bits, table, width, word = [], {}, 9, b""

    def put(code):
        bits.extend(code >> k & 1 for k in range(width - 1, -1, -1))

    put(256)
    table = {bytes([i]): i for i in range(256)}
    n = 258
    for b in data:
        if word + bytes([b]) in table:
            word += bytes([b])
            continue
        put(table[word])
        table[word + bytes([b])] = n
        n += 1
        if n >= (1 << width) and width < 12:
            width += 1
        if n >= 4094:
            put(256)
            table, n, width = {bytes([i]): i for i in range(256)}, 258, 9
        word = bytes([b])
    if word:
        put(table[word])
        n += 1
        if n >= (1 << width) and width < 12:
            width += 1
    put(257)
    bits += [0] * (-len(bits) % 8)
    return bytes(int("".join(map(str, bits[i : i + 8])), 2) for i in range(0, len(bits), 8))


def test_other_compressions():
    rng = np.random.default_rng(3)
    for data in (b"", b"a", b"abababababab" * 50, rng.integers(0, 4, 30_000, dtype=np.uint8).tobytes(), rng.integers(0, 256, 20_000, dtype=np.uint8).tobytes()):
        assert tiff.unlzw(lzw(data)) == data
    assert tiff.unpackbits(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")


def test_the_floating_point_predictor():
    a = np.random.default_rng(4).normal(size=(2, 5, 7)).astype(np.float32)
    r = tiff.Reader(tiff.encode(tiff.Raster(a, (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), 32755)))
    assert (r.read() == a).all()
    planes = np.ascontiguousarray(a.transpose(1, 2, 0)).astype(">f4").view(np.uint8).reshape(5, 14, 4).transpose(0, 2, 1).reshape(5, 28, 2)  # rows, bytes by significance, bands
    coded = np.diff(planes, axis=1, prepend=np.zeros((5, 1, 2), np.uint8)).astype(np.uint8).tobytes()
    r.blob, r.offsets, r.counts, r.compression, r.predictor, r.tiled, r.block_w, r.block_h = coded, (0,), (len(coded),), 1, 3, False, 7, 5
    assert (r.read() == a).all()


def test_colours_notes_and_normalised_images(spark):
    from pyspark.sql import functions as F

    from fieldloom.functions import grid, names

    classes = ["Sphagnum", "Heath", "Other", "Fern"]
    rows = spark.createDataFrame([("Sphagnum",), ("Heath",), ("Fern",), ("Nothing",), (None,)], "n string")
    assert [r[0] for r in rows.select(names.colour(F.col("n"), classes)).collect()] == ["#911eb4", "#f58231", "#42d4f4", "#ff00ff", "#ff00ff"]
    assert [grid.resolution_note(x, 1.0) for x in (0.97, 0.99, 1.02, 1.03)] == ["resample", "keep", "keep", "coarser"]
    out = grid.normalised(np.full((2, 3, 3), 255, np.uint8))
    assert out.shape == (3, 2, 3) and out[0, 0, 0] == pytest.approx((1 - 0.485) / 0.229)
