"""Recipes: named presets of a job's options, with explicit options winning."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

from ..functions.vectors import TWO_ARMS, MirrorSpec, mirror_spec
from ..operators.planning import Temporal
from ..operators.prefilter import Gate
from .augmentations import REGISTRY

#: Augmentations that are not functions of images alone.
OTHERS = ("frame_decimate", "horizontal_flip")


@dataclass(frozen=True)
class Recipe:
    """All options of the augmentation job."""

    num_passes: int = 2
    include_originals: bool = False
    include_originals_decimated: bool = False
    augmentations: tuple[str, ...] = ()
    two_arms: bool = False
    action_shift: int = 0
    keep_every_n: int | None = 1
    frame_stride_cycle: tuple[int, ...] | None = None
    remove_every_n: int = 5
    prefilter: bool = True
    prefilter_mode: str = "full"
    prefilter_sample_every_n: int = 1
    min_action_delta: float = 0.02
    max_action_jerk: float | None = None
    sparc_threshold: float = -10.0
    saturation_threshold: float = 0.15
    saturation_limit: float = 7.0
    tail_drop_max: int = 0
    temporal_jitter: float = 0.0
    action_noise_std: float = 0.0
    smoothing: bool = False
    smooth_window: int = 7
    smooth_order: int = 2
    smooth_exclude: tuple[int, ...] | None = None
    mask_stride: int = 5
    background_history: int = 24
    box_overlay: bool = False
    feather: int = 10
    brightness: tuple[float, float] = (0.8, 1.2)
    contrast: tuple[float, float] = (0.8, 1.2)
    saturation: tuple[float, float] = (0.5, 1.5)
    hue: tuple[float, float] = (-0.05, 0.05)
    blur_size: int = 5
    blur_sigma: tuple[float, float] = (0.1, 2.0)
    sharpness_factor: float = 2.0
    erasing_p: float = 0.5
    erasing_scale: tuple[float, float] = (0.02, 0.15)
    blob_radius: int = 30
    blob_speed: float = 2.0
    blob_softness: float = 0.6
    blob_opacity: float = 0.5
    action_signs: tuple[float, ...] | None = None
    state_signs: tuple[float, ...] | None = None
    seed: int = 42

    def __post_init__(self) -> None:
        known = (*REGISTRY, *OTHERS)
        unknown = [a for a in self.augmentations if a not in known]
        if unknown:
            raise ValueError(f"unknown augmentations {unknown}; there are {', '.join(known)}")
        if self.smooth_window < 3 or self.smooth_order < 1:
            raise ValueError("the smoothing window is at least 3 and the order at least 1")
        if "background" in self.augmentations and "random_erasing" in self.augmentations:
            at = self.augmentations.index
            if at("random_erasing") < at("background"):
                raise ValueError("erasing must not come before masking")
        if self.blur_size < 1 or self.blur_size % 2 == 0:
            raise ValueError("the size of a blur is odd")
        self.temporal()
        self.mirror()

    def temporal(self) -> Temporal:
        decimate = self.remove_every_n if "frame_decimate" in self.augmentations else None
        return Temporal(
            self.num_passes, self.include_originals, self.include_originals_decimated, self.keep_every_n, self.frame_stride_cycle, decimate, self.action_shift, self.tail_drop_max, self.temporal_jitter, self.seed
        )

    def gate(self, fps: float = 50.0) -> Gate:
        return Gate(self.prefilter_mode, self.prefilter_sample_every_n, self.sparc_threshold, self.saturation_limit, self.saturation_threshold, self.min_action_delta, self.max_action_jerk, fps)

    def mirror(self) -> MirrorSpec | None:
        """How a flip mirrors action and state; an error if neither a robot nor both signs tell."""
        if "horizontal_flip" not in self.augmentations:
            return None
        return mirror_spec(TWO_ARMS if self.two_arms else None, self.action_signs, self.state_signs)

    def excluded(self) -> tuple[int, ...]:
        """Grippers switch rather than move, so the two-arm robot's aren't smoothed by default."""
        if self.smooth_exclude is not None:
            return self.smooth_exclude
        return (6, 13) if self.two_arms else ()


_FAST = {"two_arms": True, "action_shift": 4, "prefilter_mode": "fast", "prefilter_sample_every_n": 8}
_LOOK = ("color_jitter", "gaussian_blur", "sharpness", "random_erasing")
# The options of the named recipes.
_PRODUCTION = _FAST | {
    "include_originals": True, "include_originals_decimated": True, "num_passes": 1, "augmentations": (*_LOOK, "horizontal_flip"), "keep_every_n": 3,
    "min_action_delta": 0.015, "max_action_jerk": 0.0145, "saturation_threshold": 0.12, "tail_drop_max": 8, "temporal_jitter": 0.15, "action_noise_std": 0.003, "smoothing": True,
}
_COMPOSED = _PRODUCTION | {"augmentations": ("color_jitter", "gaussian_blur", "sharpness", "horizontal_flip", "background")}
RECIPES: Mapping[str, Mapping] = {
    "tier1": _FAST | {"num_passes": 1, "keep_every_n": 4, "prefilter": False},
    "tier2": _FAST | {"include_originals": True, "num_passes": 3, "augmentations": (*_LOOK, "horizontal_flip"), "keep_every_n": 3, "min_action_delta": 0.0188, "max_action_jerk": 0.0138, "saturation_threshold": 0.12, "tail_drop_max": 12},
    "tier3": _FAST | {"num_passes": 3, "augmentations": (*_LOOK, "drifting_blob", "static_erasing", "horizontal_flip"), "frame_stride_cycle": (2, 3, 4), "prefilter": False, "min_action_delta": 0.03, "saturation_threshold": 0.10, "tail_drop_max": 12},
    "v7": _PRODUCTION,
    "v8": _COMPOSED,
    "v7_sam": _COMPOSED,
    "v9": _COMPOSED | {"keep_every_n": 1, "mask_stride": 5, "background_history": 200},
    "v9_boxes": _PRODUCTION | {
        "include_originals_decimated": False, "augmentations": ("background",), "keep_every_n": 1, "temporal_jitter": 0.0, "action_noise_std": 0.0, "smoothing": False,
        "mask_stride": 1, "background_history": 1, "box_overlay": True,
    },
}


def resolve(name: str | None = None, **options) -> Recipe:
    """A recipe with options changed; what is given explicitly always wins, also where it equals the default."""
    if name is not None and name not in RECIPES:
        raise ValueError(f"unknown recipe {name!r}; there are {', '.join(RECIPES)}")
    known = {f.name for f in fields(Recipe)}
    if unknown := sorted(set(options) - known):
        raise ValueError(f"unknown options {unknown}")
    return replace(Recipe(**(RECIPES[name] if name else {})), **options)
