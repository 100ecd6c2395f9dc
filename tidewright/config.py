"""Parameters with their defaults and the rules between them. Durations are whole numbers with their unit in the name."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Grid:
    interval_seconds: int = 60
    offset_seconds: int = 5
    history_minutes: int = 60
    book_age_ms: int = 2500
    ticker_age_ms: int = 2500


@dataclass(frozen=True)
class Labels:
    horizons_minutes: tuple[int, ...] = (5, 15, 30, 60)
    stop_multiple: float = 1.0
    take_profit_multiple: float = 1.5
    least_stop_bps: float = 10.0
    most_stop_bps: float = 250.0


@dataclass(frozen=True)
class Execution:
    horizons_minutes: tuple[int, ...] = (15, 30)
    notionals: tuple[float, ...] = (50.0, 100.0, 250.0, 500.0)
    latency_ms: int = 250
    activation_ms: int = 2500
    lifetime_ms: int = 30_000
    queue_multiple: float = 1.0
    most_gap_ms: int = 90_000


@dataclass(frozen=True)
class Evaluation:
    embargo_minutes: int = 60
    least_train_days: int = 30
    test_days: int = 14
    most_folds: int = 4
    calibration_days: int = 7
    least_coverage: float = 0.95


@dataclass(frozen=True)
class Settings:
    grid: Grid = field(default_factory=Grid)
    labels: Labels = field(default_factory=Labels)
    execution: Execution = field(default_factory=Execution)
    evaluation: Evaluation = field(default_factory=Evaluation)

    def validate(self) -> Settings:
        h = self.labels.horizons_minutes
        rules = {
            "horizons must be positive and rise": all(x > 0 for x in h) and list(h) == sorted(set(h)),
            "notionals must be positive and rise": all(x > 0 for x in self.execution.notionals) and list(self.execution.notionals) == sorted(set(self.execution.notionals)),
            "stop bounds must be positive and in order": 0 < self.labels.least_stop_bps <= self.labels.most_stop_bps,
            "an order must outlive its latency and activation": self.execution.lifetime_ms > self.execution.latency_ms + self.execution.activation_ms,
            "the queue multiple must be 1 or more": self.execution.queue_multiple >= 1,
            "the gap must be from the book's age to 120 s": self.grid.book_age_ms <= self.execution.most_gap_ms <= 120_000,
            "the embargo must cover the longest horizon": self.evaluation.embargo_minutes >= max(h),
            "the coverage must be a share": 0 < self.evaluation.least_coverage <= 1,
        }
        if broken := [rule for rule, holds in rules.items() if not holds]:
            raise ValueError("; ".join(broken))
        return self


def load(path: str, prefix: str = "TIDEWRIGHT_") -> Settings:
    """Settings from a TOML file; PREFIX_SECTION_NAME in the environment takes precedence."""
    with open(path, "rb") as f:
        data = tomllib.load(f)
    out = Settings()
    for section in fields(out):
        part = getattr(out, section.name)
        changes = {k: tuple(v) if isinstance(v, list) else v for k, v in data.get(section.name, {}).items()}
        for f in fields(part):
            if (text := os.environ.get(f"{prefix}{section.name}_{f.name}".upper())) is not None:
                now = getattr(part, f.name)
                changes[f.name] = tuple(type(now[0])(x) for x in text.split(",")) if isinstance(now, tuple) else type(now)(text)
        out = replace(out, **{section.name: replace(part, **changes)})
    return out.validate()
