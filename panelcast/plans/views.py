"""Feature views: the inputs and exactly one label per horizon."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.derived import INPUTS, TARGETS, feature_names, with_derived


@dataclass(frozen=True)
class FeatureView:
    """A named, versioned projection with one label column."""

    name: str
    label: str
    columns: tuple[str, ...]
    version: int = 1

    def select(self, table: DataFrame) -> DataFrame:
        return table.select(*self.columns, self.label)

    def register(self, table: DataFrame) -> str:
        """Make the view readable from SQL as ``<name>_v<version>``."""
        name = f"{self.name}_v{self.version}"
        self.select(table).createOrReplaceTempView(name)
        return name


def horizon_view(horizon: int, keys: Sequence[str] = ("city", "date")) -> FeatureView:
    return FeatureView(f"panel_view_{horizon}d", TARGETS[horizon], (*keys, *INPUTS))


HORIZON_VIEWS = {h: horizon_view(h) for h in TARGETS}


def view_definitions(spark) -> DataFrame:
    """The views as catalog rows."""
    rows = [(v.name, v.version, v.label, list(v.columns)) for v in HORIZON_VIEWS.values()]
    return spark.createDataFrame(
        rows, "name string, version int, label string, columns array<string>"
    )


def horizon_matrix(table: DataFrame, horizon: int) -> DataFrame:
    """Keys, the horizon's features as doubles, and its label."""
    view = HORIZON_VIEWS[horizon]
    derived = with_derived(view.select(table), horizon)
    return derived.select(
        "city",
        "date",
        *(F.col(c).cast("double").alias(c) for c in feature_names(horizon)),
        view.label,
    )
