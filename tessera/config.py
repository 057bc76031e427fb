"""Settings of the two pipelines. Source keys, licences and id prefixes are fixed values of the corpora."""

from __future__ import annotations

from dataclasses import dataclass, field

SOURCES = ("gsma_tcc", "tele_data", "frrouting", "sonic", "openvswitch", "kea")
REPOSITORY_LICENSE = "SEE_REPOSITORY_LICENSE; review document notices"
MANUAL_LICENSE = "SEE_ARM_COPYRIGHT_AND_LICENSE_NOTICES"
CARD_LICENSE = "dataset-card:MIT; verify embedded source license"
UNKNOWN_LICENSE = "UNKNOWN_REVIEW_REQUIRED"


@dataclass(frozen=True)
class CorpusConfig:
    enabled_sources: tuple[str, ...] = SOURCES
    ratios: tuple[float, float, float] = (0.90, 0.05, 0.05)
    seed: int = 42
    min_chars: int = 200
    manual_version: str = "kea-3.0.4"
    extra: dict = field(default_factory=dict)

    def validate(self) -> None:
        if abs(sum(self.ratios) - 1.0) > 1e-9:
            raise ValueError("split ratios must add up to 1.0")
        unknown = set(self.enabled_sources) - set(SOURCES)
        if unknown:
            raise ValueError(f"unknown sources: {sorted(unknown)}")


@dataclass(frozen=True)
class TrainerView:
    """What a trainer needs to know of the data."""

    max_length: int = 4096
    per_device: int = 4
    world: int = 16
    accumulation: int = 2
    packing: str = "bfd_split"

    def validate(self) -> None:
        if min(self.max_length, self.per_device, self.world, self.accumulation) < 1:
            raise ValueError("lengths and batch sizes must be positive")
        if self.packing not in ("wrapped", "bfd_split"):
            raise ValueError(f"unknown packing strategy: {self.packing}")

    @property
    def global_batch(self) -> int:
        return self.per_device * self.world * self.accumulation
