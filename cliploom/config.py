"""Run configuration: strict sections, open model options, read from YAML."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any


@dataclass
class Model:
    """A scorer; keys that aren't fields are kept in ``extra``."""

    name: str
    kind: str
    threshold: float = 0.0
    device: str = "cpu"
    batch_size: int = 1
    extra: dict[str, Any] = field(default_factory=dict)


@dataclass
class Upload:
    repo: str = ""
    enabled: bool = True
    patterns: list[str] = field(default_factory=lambda: ["**/*"])
    workers: int = 4


@dataclass
class Splitter:
    kind: str = "pyscenedetect"
    threshold: float = 27.0
    transnet_threshold: float = 0.0
    min_scene_len: int = 15
    window_len: int = 60
    window_stride: int = 60
    cut: bool = False

    def boundary_threshold(self) -> float:
        """The model's own threshold; zero stands for the general one."""
        return self.transnet_threshold or self.threshold


@dataclass
class FlashFilter:
    enabled: bool = False
    sample_stride: int = 1
    brightness_delta: float = 40.0
    max_flash_ratio: float = 0.2
    record_only: bool = False


@dataclass
class Ocr:
    enabled: bool = False
    sample_stride: int = 30
    text_area_threshold: float = 0.02
    record_only: bool = False
    lang: str = "en"


@dataclass
class CaptionStage:
    """One caption stage; ``provider`` names a registered plug-in."""

    provider: str = ""
    model: str = ""
    base_url: str = ""
    api_key: str = ""
    prompt: str = ""
    system_prompt: str = ""
    template: str = ""
    response_field: str = "caption"
    num_frames: int = 4
    max_side: int = 768
    retry: int = 1
    workers: int = 4


@dataclass
class Caption:
    """Two stages, or the older single stage in ``single``."""

    enabled: bool = False
    visual: CaptionStage | None = None
    rewrite: CaptionStage | None = None
    single: CaptionStage | None = None

    def stages(self) -> list[CaptionStage]:
        if self.visual:
            return [self.visual, *([self.rewrite] if self.rewrite else [])]
        if self.single:
            return [self.single]
        if self.enabled:
            raise ValueError("captions are enabled without a stage")
        return []

    def workers(self) -> int:
        return max([1, *(s.workers for s in self.stages())])


@dataclass
class Runtime:
    prefetch: int = 2
    queue_size: int = 128
    workers: int = 4


@dataclass
class Calibration:
    enabled: bool = False
    sample_size: int = 10_000
    quantiles: list[float] = field(default_factory=lambda: [0.4, 0.7])
    output: str = "calibration.parquet"


@dataclass
class Selection:
    strategy: str | None = None


@dataclass
class Config:
    workdir: str = "work"
    shards: list[str] = field(default_factory=list)
    shards_file: str | None = None
    skip_upload: bool = False
    limit_shards: int | None = None
    models: list[Model] = field(default_factory=list)
    upload: Upload = field(default_factory=Upload)
    splitter: Splitter = field(default_factory=Splitter)
    flash_filter: FlashFilter = field(default_factory=FlashFilter)
    ocr: Ocr = field(default_factory=Ocr)
    caption: Caption = field(default_factory=Caption)
    runtime: Runtime = field(default_factory=Runtime)
    calibration: Calibration = field(default_factory=Calibration)
    selection: Selection = field(default_factory=Selection)

    def thresholds(self) -> dict[str, float]:
        """Threshold of each model; of models with the same name the last counts."""
        return {m.name: float(m.threshold) for m in self.models}

    def batch_size(self) -> int:
        """The smallest batch any model asks for, 1 at least."""
        return min((max(1, m.batch_size) for m in self.models), default=1)


def _section(kind: type, raw: Mapping[str, Any] | None, where: str):
    raw = dict(raw or {})
    known = {f.name for f in fields(kind)}
    if unknown := sorted(set(raw) - known):
        raise TypeError(f"unknown keys in {where}: {', '.join(unknown)}")
    return kind(**raw)


def _model(raw: Mapping[str, Any]) -> Model:
    known = {f.name for f in fields(Model)} - {"extra"}
    own = {k: v for k, v in raw.items() if k in known}
    return Model(**own, extra={**raw.get("extra", {}), **{k: v for k, v in raw.items() if k not in known and k != "extra"}})


def from_dict(raw: Mapping[str, Any], folder: str = ".") -> Config:
    """Configuration of a plain dictionary; unknown sections are ignored, unknown keys within a section are errors."""
    sections = {"upload": Upload, "splitter": Splitter, "flash_filter": FlashFilter, "ocr": Ocr, "runtime": Runtime, "calibration": Calibration, "selection": Selection}
    built = {k: _section(kind, raw.get(k), k) for k, kind in sections.items()}
    caption = dict(raw.get("caption") or {})
    for stage in ("visual", "rewrite", "single"):
        if caption.get(stage) is not None:
            caption[stage] = _section(CaptionStage, caption[stage], f"caption.{stage}")
    built["caption"] = _section(Caption, caption, "caption")
    plain = {k: raw[k] for k in ("workdir", "shards", "shards_file", "skip_upload", "limit_shards") if k in raw}
    config = Config(**plain, models=[_model(m) for m in raw.get("models", [])], **built)
    if config.shards_file:
        path = config.shards_file if os.path.isabs(config.shards_file) else os.path.join(folder, config.shards_file)
        with open(path, encoding="utf-8") as f:
            config.shards = [s for s in (line.strip() for line in f) if s and not s.startswith("#")]
    if config.limit_shards is not None:
        config.shards = config.shards[: max(0, config.limit_shards)]
    return config


def load(path: str, **overrides: Any) -> Config:
    """Configuration of a YAML file; keyword arguments replace top-level values that are given (not None)."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs the yaml package") from e
    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f) or {}
    raw |= {k: v for k, v in overrides.items() if v is not None}
    return from_dict(raw, os.path.dirname(os.path.abspath(path)))


def env_flag(name: str, default: bool = False) -> bool:
    """An environment switch: unset is the default, empty and the usual words of denial are false."""
    value = os.environ.get(name)
    return default if value is None else value.strip().lower() not in {"", "0", "false", "no", "off"}
