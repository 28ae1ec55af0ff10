"""Settings that change results, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    """Country settings and match limits."""

    street_ref: str = "ref:RS:ulica"
    house_ref: str = "ref:RS:kucni_broj"
    authority: str = "RGZ"
    metric_crs: str = "EPSG:32634"
    radius: float = 200.0
    far: float = 50.0
    buffer: float = 30.0
    min_share: float = 0.6
    min_missing: float = 50.0
    decapitalize: bool = False
    use_place_tag: bool = False
    min_munis: int = 168
    rows_per_task: int = 500_000


DEFAULTS = Options()

# Districts left out of country reports.
EXCLUDED_DISTRICTS = [25, 26, 27, 28, 29]
