"""Literal vectors: geometry, levels, resolution, configuration, files."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselia.config import Config
from tesselia.functions import geometry as g, parsing as ps, pixels as px
from tesselia.operators import planning, runs, scoring, stitching, tissue
from tesselia.sources import files, slides as src

LEVELS = [(0, 0.2425, 0.2426), (1, 0.4850, 0.4853), (2, 0.9701, 0.9706)]


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


@pytest.mark.parametrize("length,expected", [(1000, [0, 384, 488]), (256, [0]), (512, [0]), (896, [0, 384])])
def test_axis_positions(spark, length, expected):
    assert one(spark, g.axis_positions(F.lit(length), 512, 384))[0] == expected


@pytest.mark.parametrize("x,y,expected", [(384, 384, (64, 64, 448, 448)), (0, 0, (0, 0, 448, 448))])
def test_crop_bounds(spark, x, y, expected):
    c = g.crop_bounds(F.lit(x), F.lit(y), F.lit(1200), F.lit(1200), 512, 64)
    assert tuple(one(spark, c["crop_left"], c["crop_top"], c["crop_right"], c["crop_bottom"])) == expected


@pytest.mark.parametrize("policy,cap,expected", [("nearest", 2.0, 2), ("prefer_higher", 2.0, 1), ("prefer_higher_bounded", 1.5, 2), ("prefer_higher_bounded", 2.0, 1)])
def test_levels(spark, policy, cap, expected):
    lv = F.array(*[F.struct(F.lit(i).alias("index"), F.lit(x).alias("mpp_x"), F.lit(y).alias("mpp_y")) for i, x, y in LEVELS])
    assert one(spark, g.choose_level(lv, 0.88, policy, cap)["index"])[0] == expected


@pytest.mark.parametrize("props,expected", [
    ({"openslide.mpp-x": "0.24", "openslide.mpp-y": "0.25"}, (0.24, 0.25, "openslide.mpp-x/y")),
    ({"aperio.MPP": "0.50"}, (0.5, 0.5, "aperio.MPP")),
    ({"tiff.ImageDescription": "x microns per pixel = 0.88"}, (0.88, 0.88, "text:tiff.imagedescription")),
    ({"tiff.XResolution": "10000", "tiff.YResolution": "10000", "tiff.ResolutionUnit": "centimeter"}, (1.0, 1.0, "tiff.resolution")),
    ({"openslide.objective-power": "20"}, (0.5, 0.5, "objective-power-estimate")),
    ({"openslide.mpp-x": "nan", "other": "1"}, None),
])
def test_mpp_chain(spark, props, expected):
    table = spark.createDataFrame([(props,)], "props map<string, string>").select(ps.lower_keys(F.col("props")).alias("props"))
    got = table.select(ps.mpp_chain(F.col("props"))).first()[0]
    assert (tuple(got) if got else None) == expected


def test_override_and_text(spark):
    found = F.struct(F.lit(0.1).alias("mpp_x"), F.lit(0.2).alias("mpp_y"), F.lit("a").alias("mpp_source"))
    none = F.lit(None).cast("double")
    assert tuple(one(spark, ps.mpp_with_override(found, F.lit(0.75), none))[0]) == (0.75, 0.75, "config.override")
    assert tuple(one(spark, ps.mpp_with_override(found, none, none))[0]) == (0.1, 0.2, "a")
    with pytest.raises(Exception, match="positive"):
        one(spark, ps.mpp_with_override(found, F.lit(-1.0), none))
    numbers = {"1d": None, "1/4": 0.25, "3/0": None, " 2.5e-1 ": 0.25, "": None}
    assert {k: one(spark, ps.lenient_float(F.lit(k)))[0] for k in numbers} == numbers
    assert one(spark, ps.format_bytes(F.lit(2752512)))[0] == "2.62 MiB"


# level-0 resolution, frame size, size at the target, true resolution, patches
MANIFESTS = [
    (0.26278, 0.26278, 64396, 46701, 19230, 13946, 0.8799782048881954, 0.8799719475118314, 1800),
    (0.242534722222222, 0.242647058823529, 99840, 178432, 27517, 49200, 0.8799893399231983, 0.8799999999999986, 9216),
    (0.242534722222222, 0.242647058823529, 94464, 186624, 26035, 51459, 0.8799999999999991, 0.8799969821777003, 9112),
    (0.242534722222222, 0.242647058823529, 78080, 91648, 21519, 25271, 0.8800181751527066, 0.8799856613137108, 3696),
]


def test_frames_and_grids(spark):
    rows = [(i, m[2], m[3], m[0], m[1], None, None, None, None) for i, m in enumerate(MANIFESTS)]
    s = spark.createDataFrame(rows, "slide_id int, width0 int, height0 int, mpp_x double, mpp_y double, bnd_x int, bnd_y int, bnd_w int, bnd_h int")
    frames = planning.output_frames(s)
    got = {r.slide_id: (r.out_w, r.out_h, r.ampp_x, r.ampp_y) for r in frames.collect()}
    assert got == {i: m[4:8] for i, m in enumerate(MANIFESTS)}
    assert {r.slide_id: r["count"] for r in planning.patch_grid(frames).groupBy("slide_id").count().collect()} == {i: m[8] for i, m in enumerate(MANIFESTS)}


def test_bounds_frame_and_supertiles(spark):
    s = spark.createDataFrame([(1, 1000, 800, 0.5, 0.5, 200, 100, 400, 300)], "slide_id int, width0 int, height0 int, mpp_x double, mpp_y double, bnd_x int, bnd_y int, bnd_w int, bnd_h int")
    r = planning.output_frames(s, 1.0).first()
    assert (r.origin_x, r.origin_y, r.out_w, r.out_h, r.ampp_x, r.ampp_y) == (200, 100, 200, 150, 1.0, 1.0)
    p = spark.createDataFrame([(1, 0, 0), (1, 384, 0), (1, 4608, 0)], "slide_id int, out_x int, out_y int")
    assert sorted((t.kx, t.n_patches) for t in planning.supertiles(p).collect()) == [(0, 2), (1, 1)]


def test_otsu_and_morphology(spark):
    two = spark.createDataFrame([(1, 30)] * 8 + [(1, 220)] * 8 + [(2, 7)] * 3, "slide_id int, gray int")
    assert {r.slide_id: r.otsu for r in tissue.otsu(two).collect()} == {1: 30, 2: 0}
    rnd = np.random.RandomState(3).randint(0, 2, (9, 14))
    assert tissue.thresholds(np.array([[[30] * 8 + [220] * 8], [[7] * 16]])).tolist() == [30, 0]
    got = tissue.close_open(np.stack([rnd, 1 - rnd]))[0]

    def square(a, k, f):
        p = np.pad(a, k, mode="edge")
        return f([p[i : i + a.shape[0], j : j + a.shape[1]] for i in range(2 * k + 1) for j in range(2 * k + 1)], axis=0)

    want = square(square(square(square(rnd, 2, np.max), 2, np.min), 1, np.min), 1, np.max)
    assert got.tolist() == want.tolist()


def test_tissue_chain_does_not_shuffle(spark):
    """Thumbnails of several sizes in one pass; the gate adds the two exchanges of its join at most, and the plan is computed once."""
    rnd = np.random.RandomState(5)
    images = [rnd.randint(0, 256, (h, w, 3), np.uint8) for h, w in ((5, 7), (1, 1), (5, 7), (40, 30))]
    df = spark.createDataFrame([(i, x.shape[1], x.shape[0], bytearray(x.tobytes())) for i, x in enumerate(images)], "slide_id int, thumb_w int, thumb_h int, rgb binary")
    long = spark.createDataFrame([(i, int(p[0]), int(p[1]), int(p[2])) for i, x in enumerate(images) for p in x.reshape(-1, 3)], "slide_id int, r int, g int, b int")
    marked = tissue.gray_hsv(long)
    count = marked.join(tissue.otsu(marked), "slide_id").filter(px.is_tissue(F.col("gray"), F.col("otsu"), F.col("sat"), F.col("val"))).groupBy("slide_id").count()
    want = {r["slide_id"]: r["count"] for r in count.collect()}
    out = tissue.tissue_images(df)
    for r in out.collect():
        assert sum(r.raw) == want.get(r.slide_id, 0) and r.sums[-1] == sum(r.mask) and len(r.sums) == r.thumb_w * r.thumb_h
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(out)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from tesselia.plans import queries

        assert plan(queries.q_gated_plan(spark, "/root/testdata/sf0.001")).count("Exchange hashpartitioning") <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("w, h, least, levels", [(1024, 1024, 512, 2), (1023, 1023, 512, 2), (4096, 4096, 512, 4), (1024, 1024, 256, 3), (511, 9000, 512, 0), (1, 1, 0, 0), (2, 2, 0, 1)])
def test_pyramid_levels(spark, w, h, least, levels):
    got = spark.range(1).select(g.pyramid_levels(F.lit(w), F.lit(h), least).alias("n")).first().n
    body = files.ome_tiff_bytes(np.zeros((h, w), np.uint8), (0.5, 0.5), 256, least)
    assert got == levels and body.count(struct.pack("<HHQ", 254, 4, 1) + b"\1") == levels


def test_config(tmp_path):
    with pytest.raises(ValueError):
        Config.from_dict({"model": {"stride_px": 400}})
    old = Config.from_dict({"future": {"use_bounds": False, "use_tissue_mask": False, "supertile_px": 8192}}).schedule
    assert (old.use_bounds, old.use_tissue_mask, old.supertile_px) == (False, False, 8192)
    (tmp_path / "c.yaml").write_text("paths: {slide_path: a/b.svs}\noutput: {write_previews: false, write_ome_tiff: false}\nextra: 1\n")
    c = Config.from_yaml(tmp_path / "c.yaml")
    assert c.paths.slide_path == str(tmp_path / "a/b.svs") and not c.output.exports_requested and len(c.hash()) == 8
    assert Config().hash() == Config().hash() != Config.from_dict({"model": {"threshold": 0.6}}).hash()


def test_model_outputs():
    a = np.zeros((2, 2, 4, 4), np.float32)
    a[:, 1] = 1
    assert np.allclose(scoring.to_probs({"out": a}, 4, False), 1 / (1 + np.exp(-1)))
    assert scoring.to_probs([a[:, 0]], 8).shape == (2, 8, 8)
    with pytest.raises(ValueError):
        scoring.to_probs(np.zeros((1, 3, 4, 4)), 4)
    with pytest.raises(TypeError):
        scoring.unwrap({"x": 1})
    assert scoring.probe(scoring.mean_darkness, 16)["output_kind"] == "binary_logits_1ch"
    flat = np.full((7, 9, 3), 77, np.uint8)
    assert (scoring.resize_area(flat, 3, 20) == 77).all()


def test_images():
    mask = np.zeros((1024, 1024), np.uint8)
    data = files.ome_tiff_bytes(mask, (0.88, 0.88), 256, 256)
    assert data[:2] == b"II" and struct.unpack_from("<H", data, 2)[0] == 43 and b'PhysicalSizeX="0.88"' in data
    assert files.tiff_bytes(mask, (0.5, 0.5)).startswith(b"II") and files.png_bytes(mask).startswith(b"\x89PNG")


def test_discovery(spark, tmp_path):
    for n in ("b.SVS", "a.tiff", "note.txt"):
        (tmp_path / n).write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.mrxs").write_text("x")
    names = lambda df: [r.path.rsplit("/", 1)[1] for r in df.collect()]
    assert names(src.discover(spark, str(tmp_path))) == ["a.tiff", "b.SVS"]
    assert names(src.discover(spark, str(tmp_path), recursive=True)) == ["a.tiff", "b.SVS", "c.mrxs"]
    assert names(src.discover(spark, str(tmp_path), pattern="*.txt")) == ["note.txt"]


def test_events_and_sampling(spark, tmp_path):
    log = files.EventLog(tmp_path)
    log.event("slide_opened", path="x")
    log.event("run_complete")
    assert [json.loads(x)["event"] for x in log.path.read_text().splitlines()] == ["slide_opened", "run_complete"]
    assert files.read_events(spark, str(tmp_path)).count() == 2
    e = spark.createDataFrame([(1, i, i) for i in range(1, 20)], "run_id int, ts int, event_id int")
    assert sorted(r.idx for r in runs.progress_sample(e, 8).collect()) == [1, 8, 16, 19]


def test_stitch_is_independent_of_order(spark):
    rnd = np.random.RandomState(1)
    rows = [("c", x, y, 30, 30, rnd.randn(64).astype(float).tolist()) for x in (0, 4, 8, 12, 16, 20, 22) for y in (0, 4, 8, 12, 16, 20, 22) if rnd.rand() < 0.8]
    schema = "canvas string, out_x int, out_y int, out_w int, out_h int, logits array<double>"
    want = np.full((30, 30), -1)
    for _, x, y, w, h, z in sorted(rows, key=lambda r: (r[1] // 16, r[2] // 16, r[2], r[1])):
        a = (1 / (1 + np.exp(-np.array(z).reshape(8, 8))) >= 0.5).astype(int)
        l, t, r, b = (0 if x == 0 else 2), (0 if y == 0 else 2), (8 if x + 8 >= w else 6), (8 if y + 8 >= h else 6)
        want[y + t : y + b, x + l : x + r] = a[t:b, l:r]
    for order in (rows, rows[::-1]):
        got = stitching.stitch(stitching.patch_pixels(spark.createDataFrame(order, schema), 8, 2, 16)).collect()
        out = np.full((30, 30), -1)
        for r in got:
            out[r.y, r.x] = r.mask
        assert (out == want).all()
