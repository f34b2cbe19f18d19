"""Bands of a measure: labelled half-open or closed ranges as chained conditions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Ascending edges and one label more than there are edges.

    A value belongs to the first band whose edge it stays below (or reaches,
    with ``closed``). What meets no edge belongs to the last band, and so does
    a null, as in ``CASE ... ELSE``.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    closed: bool = False

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("bands need one label more than edges")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("band edges must ascend")

    def _choose(self, column: str, results: list) -> Column:
        value = F.col(column)
        chain = F
        for edge, result in zip(self.edges, results):
            limit = F.lit(float(edge))
            chain = chain.when(value <= limit if self.closed else value < limit, F.lit(result))
        return chain.otherwise(F.lit(results[-1]))

    def label(self, column: str) -> Column:
        return self._choose(column, list(self.labels))

    def order(self, column: str) -> Column:
        return self._choose(column, list(range(1, len(self.labels) + 1)))


# Air-quality categories by upper limit, without gaps.
AQI_CATEGORIES = Bands(
    edges=(50, 100, 150, 200, 300),
    labels=(
        "Good",
        "Moderate",
        "Unhealthy for Sensitive Groups",
        "Unhealthy",
        "Very Unhealthy",
        "Hazardous",
    ),
    closed=True,
)

# Air-quality hours counted by closed whole-number ranges
# (name, lowest, highest). A value such as 50.5 falls between two of them.
AQI_RANGES = (
    ("good_hours", None, 50),
    ("moderate_hours", 51, 100),
    ("unhealthy_sensitive_hours", 101, 150),
    ("unhealthy_hours", 151, 200),
    ("very_unhealthy_hours", 201, 300),
    ("hazardous_hours", 300, None),
)

# Wind speed in mph and temperature in degrees Fahrenheit.
WIND_BANDS = Bands(edges=(5, 10, 15, 20), labels=("0-5", "5-10", "10-15", "15-20", "20+"))
TEMPERATURE_BANDS = Bands(
    edges=(32, 50, 68, 86),
    labels=("Below 32 F", "32-49 F", "50-67 F", "68-85 F", "86 F and above"),
)


def rain_label(column: str) -> Column:
    """Wet only where it is known to have rained; an unknown amount counts as dry."""
    return F.when(F.col(column) > 0, F.lit("Rain / Precipitation")).otherwise(F.lit("Dry"))


def hours_in_range(column: str, low: float | None, high: float | None) -> Column:
    """Count of rows in a closed range; without ``high``, of rows strictly above ``low``."""
    value = F.col(column)
    if high is None:
        return F.count_if(value > F.lit(float(low)))
    if low is None:
        return F.count_if(value <= F.lit(float(high)))
    return F.count_if(value.between(F.lit(float(low)), F.lit(float(high))))
