"""Settings of a run, checked before anything is read."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Sizes and thresholds of a run; a value out of range raises ValueError that names it."""

    part_size: int = 200_000
    write_aux_outputs: bool = False
    near_threshold: float = 0.92
    fuzzy_threshold: float = 96.0
    bucket_most: int = 250

    def __post_init__(self) -> None:
        ranges = {
            "part_size": self.part_size >= 1, "near_threshold": 0 < self.near_threshold <= 1,
            "fuzzy_threshold": 0 < self.fuzzy_threshold <= 100, "bucket_most": self.bucket_most >= 2,
        }
        wrong = [f"{name} = {getattr(self, name)}" for name, ok in ranges.items() if not ok]
        if wrong:
            raise ValueError("out of range: " + ", ".join(wrong))
