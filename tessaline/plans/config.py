"""Settings of the composite, training and inference plans: defaults, then a YAML file, then explicit values; always checked."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path


class ConfigurationError(ValueError):
    """A setting is missing or out of range."""


def _require(condition: bool, message: str) -> None:
    if not condition:
        raise ConfigurationError(message)


# The defaults of all settings below are those that users of such tools know.


@dataclass
class Tiling:
    tile_size: int = 512
    stride: int = 256
    buffer: int = 0

    def validate(self) -> None:
        _require(self.tile_size > 0, "tile_size must be positive")
        _require(0 < self.stride <= self.tile_size, "stride must lie between 1 and the tile size")
        _require(self.buffer >= 0, "buffer must not be negative")


@dataclass
class Sampling:
    ratio: float = 1.0
    margin: float = 100.0
    seed: int = 42

    def validate(self) -> None:
        _require(self.ratio > 0, "ratio must be positive")
        _require(self.margin >= 0, "margin must not be negative")


@dataclass
class Composite:
    seasons: list[str] = field(default_factory=lambda: ["SPR", "SUM", "FAL"])
    years: list[int] = field(default_factory=list)
    cloud_cover: float = 60.0
    min_clear: int = 3
    dilation: int = 0
    max_scenes: int | None = None

    def validate(self) -> None:
        _require(set(self.seasons) <= {"SPR", "SUM", "FAL"}, "seasons must be among SPR, SUM, FAL")
        _require(0 <= self.cloud_cover <= 100, "cloud_cover must lie between 0 and 100")
        _require(self.min_clear >= 1, "min_clear must be at least 1")
        _require(self.dilation >= 0, "dilation must not be negative")
        _require(self.max_scenes is None or self.max_scenes > 0, "max_scenes must be positive")


@dataclass
class Inference:
    window: int = 512
    overlap: int = 256
    classes: int = 2
    threshold: float | None = None
    min_area: int = 1000
    tolerance: float = 1.0
    batch_size: int = 4

    def validate(self) -> None:
        _require(self.tolerance >= 0, "tolerance must not be negative")
        _require(self.batch_size > 0, "batch_size must be positive")
        _require(self.window > 0, "window must be positive")
        _require(0 <= self.overlap < self.window, "overlap must lie between 0 and the window")
        _require(self.classes >= 2, "classes must be at least 2")
        _require(self.threshold is None or 0 <= self.threshold <= 1, "threshold must lie between 0 and 1")
        _require(self.min_area >= 0, "min_area must not be negative")


@dataclass
class Model:
    """What a trained model expects; None leaves the number of channels to the stack."""

    architecture: str = "unet"
    encoder: str = "resnet34"
    encoder_weights: str | None = "imagenet"
    channels: int | None = None

    def validate(self) -> None:
        _require(bool(self.architecture), "architecture must be given")
        _require(bool(self.encoder), "encoder must be given")
        _require(self.channels is None or self.channels > 0, "channels must be positive")


@dataclass
class Training:
    """What a trainer outside this engine is told; the split and the target size also shape the tiles."""

    batch_size: int = 4
    epochs: int = 25
    learning_rate: float = 0.001
    weight_decay: float = 1e-4
    validation: float = 0.2
    seed: int = 42
    target_size: tuple[int, int] | None = None
    resize: str = "resize"
    workers: int | None = None

    def validate(self) -> None:
        for name in ("batch_size", "epochs", "learning_rate"):
            _require(getattr(self, name) > 0, f"{name} must be positive")
        _require(self.weight_decay >= 0, "weight_decay must not be negative")
        _require(0 <= self.validation < 1, "validation must lie between 0 and 1")
        _require(self.resize in ("resize", "pad"), "resize must be resize or pad")
        _require(self.target_size is None or (len(self.target_size) == 2 and min(self.target_size) > 0), "target_size must be a positive height and width")
        _require(self.workers is None or self.workers >= 0, "workers must not be negative")


@dataclass
class Topography:
    buffer: float = 200.0
    small: float = 30.0
    large: float = 150.0
    resolution: str | None = None

    def validate(self) -> None:
        _require(self.buffer >= 0, "buffer must not be negative")
        _require(0 < self.small <= self.large, "radii must be positive, the small one first")
        _require(self.resolution in (None, "1m", "10m", "30m"), "resolution must be 1m, 10m or 30m")


@dataclass
class Settings:
    tiling: Tiling = field(default_factory=Tiling)
    sampling: Sampling = field(default_factory=Sampling)
    composite: Composite = field(default_factory=Composite)
    inference: Inference = field(default_factory=Inference)
    model: Model = field(default_factory=Model)
    training: Training = field(default_factory=Training)
    topography: Topography = field(default_factory=Topography)
    paths: dict[str, str] = field(default_factory=dict)

    def validate(self) -> None:
        for f in fields(self):
            if is_dataclass(part := getattr(self, f.name)):
                part.validate()


def build(loaded: dict | None = None, explicit: dict | None = None, base: Path | None = None) -> Settings:
    """Settings from defaults, a loaded mapping and explicit values, in rising precedence; relative paths are those of base."""
    out = Settings()
    for layer in (loaded or {}, explicit or {}):
        for name, value in layer.items():
            _require(hasattr(out, name), f"Unknown section: {name}")
            part = getattr(out, name)
            if name == "paths":
                part.update({k: str((base or Path()) / v) for k, v in value.items()})
                continue
            for key, own in (value or {}).items():
                _require(hasattr(part, key), f"Unknown setting: {name}.{key}")
                if own is not None:
                    setattr(part, key, own)
    out.validate()
    return out


def load(path: str | Path, explicit: dict | None = None) -> Settings:
    try:
        import yaml
    except ImportError as error:
        raise ConfigurationError("YAML files need the package yaml") from error
    own = Path(path)
    content = yaml.safe_load(own.read_text(encoding="utf-8"))
    _require(isinstance(content, dict), f"{own} must hold a mapping")
    return build(content, explicit, own.resolve().parent)
