"""Slide files: what the writers write, the readers read; and a run over a pyramid."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselia import engine
from tesselia.config import Config
from tesselia.operators import scoring
from tesselia.sources import files, formats


def noise(h: int, w: int, channels: int | None = 3) -> np.ndarray:
    return np.random.RandomState(h + w).randint(0, 256, (h, w, channels) if channels else (h, w)).astype(np.uint8)


@pytest.mark.parametrize("big", [True, False])
@pytest.mark.parametrize("compression", ["zlib", None])
@pytest.mark.parametrize("channels", [None, 3])
def test_round_trip(tmp_path, big, compression, channels):
    image = noise(300, 421, channels)
    (tmp_path / "a.tiff").write_bytes(files.ome_tiff_bytes(image, (0.25, 0.5), 64, 100, big, compression))
    s = formats.open_slide(str(tmp_path / "a.tiff"))
    assert s.backend == "tiff" and s.big == big and s.sizes == [(421, 300), (211, 150), (106, 75)]
    for k in range(3):
        want = image[:: 2**k, :: 2**k]
        want = want if channels else np.repeat(want[..., None], 3, 2)
        w, h = s.sizes[k]
        assert (s.pixels(k, 0, 0, w, h) == want).all() and (s.pixels(k, 33, 21, 50, 47) == want[21:68, 33:83]).all()
    assert float(s.props["tiff.XResolution"]) == pytest.approx(40000) and s.props["tiff.ResolutionUnit"] == "centimeter"


def test_strips_and_byte_order(tmp_path):
    """A big-endian file of two strips, by hand; white is zero."""
    image = noise(5, 4, None)
    tags = [(256, 3, 4), (257, 3, 5), (258, 3, 8), (259, 3, 1), (262, 3, 0), (273, 4, None), (277, 3, 1), (278, 3, 3), (279, 4, None)]
    at = 8 + 20
    after = at + 2 + 12 * len(tags) + 4
    out = b"MM\0\x2a" + at.to_bytes(4, "big") + image.tobytes() + len(tags).to_bytes(2, "big")
    for tag, kind, value in tags:
        place = {273: after, 279: after + 8}.get(tag)
        field = place.to_bytes(4, "big") if place else value.to_bytes(2, "big") + b"\0\0"
        out += tag.to_bytes(2, "big") + kind.to_bytes(2, "big") + (2 if place else 1).to_bytes(4, "big") + field
    out += b"\0" * 4 + b"".join(n.to_bytes(4, "big") for n in (8, 20, 12, 8))
    (tmp_path / "b.tif").write_bytes(out)
    s = formats.open_slide(str(tmp_path / "b.tif"))
    assert (s.pixels(0, 0, 0, 4, 5)[..., 0] == 255 - image).all()


def test_region_and_thumbnail(tmp_path):
    image = noise(90, 70)
    np.save(tmp_path / "c.npy", image)
    s = formats.open_slide(str(tmp_path / "c.npy"))
    got = formats.region(s, 0, -10, 80, 100, 20, (1, 2, 3))
    assert (got[:10, 10:80] == image[80:]).all() and (got[10:] == (1, 2, 3)).all() and (got[:, :10] == (1, 2, 3)).all()
    assert (formats.region(s, 0, 500, 500, 4, 4) == 255).all()
    assert (formats.thumbnail(s, 30, strip=7) == scoring.resize_area(image, 30, 23)).all()


def test_place_mask():
    mask = np.full((10, 20), 255, np.uint8)
    got = scoring.place_mask(mask, (50, 100), (1000, 500), (200, 100, 400, 200))
    assert (got[10:30, 20:60] == 255).all() and got.sum() == 255 * 20 * 40


def test_aperio_description(spark, tmp_path):
    text = "Aperio Image Library|AppMag = 20|MPP = 0.4990"
    page, directory = files._page(noise(64, 64), 16, (1.0, 1.0), 32, text, [], False, True, "zlib")
    (tmp_path / "d.svs").write_bytes(files._whole(page, directory, True))
    r = engine.find_slides(spark, Config.from_dict({}), str(tmp_path)).first()
    assert (r.vendor, r.mpp_x, r.mpp_y, r.mpp_source) == ("aperio", 0.499, 0.499, "aperio.MPP")


def test_pyramid_run(spark, tmp_path):
    """0.25 microns a pixel, wanted 0.5: level 1 is read, and the mask is where the tissue is."""
    image = np.full((1400, 1800, 3), 250, np.uint8)
    image[400:1000, 200:1200] = (90, 30, 60)
    (tmp_path / "one.tiff").write_bytes(files.ome_tiff_bytes(image, (0.25, 0.25), 256, 256))
    cfg = Config.from_dict({"model": {"target_mpp": 0.5, "patch_px": 128, "stride_px": 96, "halo_px": 16}, "schedule": {"supertile_px": 256, "tissue_mask_max_size": 128}})
    cfg.paths.output_dir, cfg.output.keep_memmap = str(tmp_path / "out"), True
    slides = engine.find_slides(spark, cfg, str(tmp_path / "one.tiff"))
    r = slides.select("mpp_x", "mpp_source", F.size("levels").alias("n"), "level.*").first()
    assert (r.mpp_source, r.n, r["index"], r.width) == ("tiff.resolution", 4, 1, 900)
    (row,) = engine.run(spark, cfg, str(tmp_path / "one.tiff"), chunk=256)
    folder = Path(row["run_dir"])
    mask = np.load(folder / "mask.npy")
    assert mask.shape == (700, 900) and (mask[200:500, 100:600] == 255).mean() > 0.99 and mask[:150].mean() < 0.01
    back = formats.open_slide(str(folder / "mask.ome.tiff"))
    assert (back.pixels(0, 0, 0, 900, 700)[..., 0] == mask).all()
    manifest = json.loads((folder / "run.json").read_text())
    assert manifest["selection"]["index"] == 1 and manifest["selection"]["resize_x"] == 1.0 and manifest["slide"]["n_levels"] == 4


def test_unknown_resolution(spark, tmp_path):
    page, directory = files._page(noise(64, 64), 16, (1.0, 1.0), 32, "", [], False, True, None)
    data = bytearray(files._whole(page, directory, True))
    at = data.index((296).to_bytes(2, "little") + b"\x03\0", directory)
    data[at + 12] = 1
    (tmp_path / "e.tif").write_bytes(bytes(data))
    with pytest.raises(Exception, match="no resolution"):
        engine.find_slides(spark, Config.from_dict({}), str(tmp_path)).collect()
