"""Settings of a run: defaults, validation, YAML files and the older layout of them."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

POLICIES = ("nearest", "prefer_higher", "prefer_higher_bounded")


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass
class Paths:
    slide_path: str | None = None
    model_path: str = "data/model_scripted.pt"
    output_dir: str = "outputs"


@dataclass
class Slide:
    mpp_override_x: float | None = None
    mpp_override_y: float | None = None

    def __post_init__(self):
        for v in (self.mpp_override_x, self.mpp_override_y):
            _need(v is None or v > 0, "mpp overrides must be positive")


@dataclass
class Model:
    target_mpp: float = 0.88
    patch_px: int = 512
    stride_px: int = 384
    halo_px: int = 64
    batch_size: int = 8
    threshold: float = 0.5
    apply_sigmoid: bool = True
    level_selection_policy: str = "nearest"
    max_native_oversample_factor: float = 2.0

    def __post_init__(self):
        _need(self.target_mpp > 0 and self.patch_px > 0 and self.stride_px > 0 and self.batch_size > 0, "sizes must be positive")
        _need(self.halo_px >= 0 and self.patch_px > 2 * self.halo_px, "the halo must leave some of the patch")
        _need(self.stride_px == self.patch_px - 2 * self.halo_px, "stride must be patch - 2 * halo")
        _need(0 <= self.threshold <= 1, "threshold must lie in [0, 1]")
        _need(self.level_selection_policy in POLICIES, f"policy must be one of {POLICIES}")
        _need(self.max_native_oversample_factor >= 1, "oversample factor must be at least 1")


@dataclass
class Runtime:
    device: str = "auto"
    use_amp: bool = True
    openslide_cache_bytes: int = 512 * 1024 * 1024
    torch_num_threads: int = 1
    prefetch_supertiles: bool = True
    prefetch_queue_size: int = 2
    log_every_supertiles: int = 8

    def __post_init__(self):
        _need(self.openslide_cache_bytes >= 0 and self.torch_num_threads >= 0, "cache and threads must not be negative")
        _need(self.prefetch_queue_size > 0 and self.log_every_supertiles > 0, "queue and logging steps must be positive")


@dataclass
class Output:
    write_tiff: bool = False
    bigtiff: bool = True
    compression: str | None = "zlib"
    tiff_tile_size: int = 512
    write_ome_tiff: bool = True
    ome_tile_size: int = 512
    ome_pyramid_min_size: int = 512
    write_previews: bool = True
    preview_max_size: int = 1536
    keep_memmap: bool = False

    def __post_init__(self):
        _need(min(self.tiff_tile_size, self.ome_tile_size, self.ome_pyramid_min_size, self.preview_max_size) > 0, "sizes must be positive")

    @property
    def exports_requested(self) -> bool:
        return self.write_tiff or self.write_ome_tiff or self.write_previews

    @property
    def needs_materialized_mask(self) -> bool:
        return self.write_tiff or self.write_ome_tiff


@dataclass
class Schedule:
    use_bounds: bool = True
    use_tissue_mask: bool = True
    tissue_mask_max_size: int = 1536
    tissue_mask_saturation_threshold: int = 18
    tissue_mask_white_threshold: int = 235
    tissue_mask_min_fraction: float = 0.03
    supertile_px: int = 4096

    def __post_init__(self):
        _need(self.tissue_mask_max_size > 0 and self.supertile_px > 0, "sizes must be positive")
        _need(0 <= self.tissue_mask_min_fraction <= 1, "fraction must lie in [0, 1]")


@dataclass
class Config:
    paths: Paths = field(default_factory=Paths)
    slide: Slide = field(default_factory=Slide)
    model: Model = field(default_factory=Model)
    runtime: Runtime = field(default_factory=Runtime)
    output: Output = field(default_factory=Output)
    schedule: Schedule = field(default_factory=Schedule)

    @classmethod
    def from_dict(cls, raw: dict, base: Path | None = None) -> Config:
        """Unknown keys are ignored. Without ``schedule``, the older ``future`` block gives three of its keys.

        Paths that the settings name are relative to ``base``, defaults to the working folder.
        """
        raw = dict(raw or {})
        if "schedule" not in raw and isinstance(raw.get("future"), dict):
            raw["schedule"] = {k: raw["future"][k] for k in ("use_bounds", "use_tissue_mask", "supertile_px") if k in raw["future"]}
        out = {}
        for f in fields(cls):
            kind = f.default_factory
            names = {x.name for x in fields(kind)}
            out[f.name] = kind(**{k: v for k, v in (raw.get(f.name) or {}).items() if k in names})
        cfg = cls(**out)
        named = raw.get("paths") or {}
        for k in ("slide_path", "model_path", "output_dir"):
            value = getattr(cfg.paths, k)
            if value is not None and not Path(value).is_absolute():
                setattr(cfg.paths, k, str(((base if k in named and base else Path.cwd()) / value).resolve()))
        return cfg

    @classmethod
    def from_yaml(cls, path: str | Path) -> Config:
        import yaml

        path = Path(path)
        return cls.from_dict(yaml.safe_load(path.read_text(encoding="utf-8")) or {}, path.resolve().parent)

    def hash(self) -> str:
        """First 8 hex digits of the SHA-256 of what changes the result, as JSON with sorted keys."""
        d = asdict(self)
        part = {
            "slide": d["slide"], "model": d["model"], "schedule": d["schedule"],
            "runtime": {k: v for k, v in d["runtime"].items() if k.startswith("prefetch_")},
            "output": {"write_ome_tiff": d["output"]["write_ome_tiff"]},
        }
        return hashlib.sha256(json.dumps(part, sort_keys=True).encode()).hexdigest()[:8]
