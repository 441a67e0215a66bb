"""Severity bands over a breakpoint table, and the hazard test."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.functions.missing import no_nan


@dataclass(frozen=True)
class Band:
    """All values up to and including ``upto``; ``None`` is everything above."""

    upto: float | None
    name: str
    colour: str


# Band table (fixed values).
SEVERITY = (
    Band(50.0, "Good", "#2ecc71"),
    Band(100.0, "Moderate", "#f1c40f"),
    Band(150.0, "Unhealthy for Sensitive Groups", "#e67e22"),
    Band(200.0, "Unhealthy", "#e74c3c"),
    Band(300.0, "Very Unhealthy", "#8e44ad"),
    Band(None, "Hazardous", "#7d3c3c"),
)

HAZARD_LEVEL = 150.0


def _pick(value: Column, bands: tuple[Band, ...], attribute: str, missing_is_top: bool) -> Column:
    *bounded, top = bands
    value = no_nan(value)
    chain = None
    for band in bounded:
        test, result = value <= band.upto, F.lit(getattr(band, attribute))
        chain = F.when(test, result) if chain is None else chain.when(test, result)
    chain = chain.otherwise(F.lit(getattr(top, attribute)))
    return chain if missing_is_top else F.when(value.isNotNull(), chain)


def band_name(
    value: Column | str, bands: tuple[Band, ...] = SEVERITY, missing_is_top: bool = False
) -> Column:
    """The band of a value. A missing value has no band unless ``missing_is_top``."""
    value = F.col(value) if isinstance(value, str) else value
    return _pick(value, bands, "name", missing_is_top)


def band_colour(
    value: Column | str, bands: tuple[Band, ...] = SEVERITY, missing_is_top: bool = False
) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return _pick(value, bands, "colour", missing_is_top)


def is_hazard(value: Column | str, level: float = HAZARD_LEVEL) -> Column:
    """True above the level; a missing value is no hazard."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(no_nan(value) > level, F.lit(False))
