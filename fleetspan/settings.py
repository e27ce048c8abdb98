"""Thresholds as one frozen record; every operator takes what it needs as a parameter with these defaults."""

from __future__ import annotations

from dataclasses import dataclass

Box = tuple[float, float, float, float]  # lowest and highest latitude, lowest and highest longitude

# The boxes and limits that give the published results.
BOXES: dict[str, Box] = {
    "wide": (-24.0, -23.0, -47.0, -46.0),
    "strict": (-23.9, -23.3, -46.9, -46.3),
    "stream": (-24.0, -23.3, -46.9, -46.3),
    "global": (-90.0, 90.0, -180.0, 180.0),
}


@dataclass(frozen=True)
class Settings:
    box: Box = BOXES["strict"]
    speed_limit: float = 120.0
    loop_speed_limit: float = 100.0
    loop_max_gap_s: int = 600
    moving_kmh: float = 5.0
    stale_minutes: int = 4
    fresh_minutes: int = 10
    stale_hours: int = 24
    known_lines: int = 400
    fleet_size: int = 15_000
    tolerance_min: float = 5.0
    null_rate: float = 0.05
    valid_rate: float = 0.95
    duplicate_rate: float = 0.01
    retention_days: int = 90


DEFAULTS = Settings()
