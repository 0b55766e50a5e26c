"""Parameters of a dataset: label taxonomy, splits and thresholds.

Nothing below is hard-wired into an operator; every operator takes the values it
needs and these objects only carry the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

SCHEMA_NAME = "provider_subtype_point_dataset"
SCHEMA_VERSION = 1

# Fixed values of the published dataset contract.
SPLIT_NAMES = ("train", "val", "test", "unassigned")
DEFAULT_SPLITS = {"1": "train", "9": "train", "2": "val", "8": "test"}
TRANSFORMS = ("identity", "hflip", "vflip", "rot180")
OVERRIDE_TRANSFORMS = ("identity", "hflip")
CONTROL_SHIFTS = ((41, 0), (0, 41), (-41, 0), (0, -41), (29, 29), (-29, -29), (29, -29), (-29, 29))
DEFAULT_SUBTYPES = {"BPD": (), "TED": ("a", "b", "c", "d", "e", "f"), "TSD": ("a", "b", "c")}


@dataclass(frozen=True)
class Taxonomy:
    """Classes and the one-letter subtypes each of them allows (none = no subtype)."""

    subtypes: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(DEFAULT_SUBTYPES))

    @property
    def classes(self) -> tuple[str, ...]:
        return tuple(self.subtypes)

    @property
    def fine_labels(self) -> tuple[str, ...]:
        out: list[str] = []
        for name, letters in self.subtypes.items():
            out.extend([f"{name}_{letter}" for letter in letters] or [name])
        return tuple(out)


@dataclass(frozen=True)
class Settings:
    patch_size: int = 128
    center_box: int = 32
    min_probe_points: int = 15
    min_signal_ratio: float = 1.15
    min_preference: float = 1.10
    min_exact_rows: float = 0.01
    min_correlation: float = 0.3
    min_correlation_lead: float = 0.2
    relation_stride: int = 8
    diff_radius: float = 2.0
    window_radius: int = 7
    control_shifts: tuple[tuple[int, int], ...] = CONTROL_SHIFTS
    rare_below: int = 300
    preview_per_label: int = 8
    legacy_double_stem: bool = False
