"""Values entered where nothing was measured.

Three signs, all taken from the whole column: zero and negative or many-digit
nines are fillers by form; a short run of nines (99, 999) is one if it is far
more frequent than the values beside it; and a value that makes up a large
share of one crew's entries, but not of the others', is that crew's default.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs of nines that also occur as measurements.
SHORT_NINES = (99.0, 999.0)
LONG_NINES = (9999.0, 99999.0, 999999.0)


@dataclass(frozen=True)
class FillerRules:
    negatives_measure: bool = False  # whether values below zero other than nines can be measurements
    spike: float = 5.0  # times the mean count of the values beside it
    beside: float = 0.05  # relative distance that counts as beside
    least: int = 5
    crew_share: float = 0.2
    crew_ratio: float = 10.0
    crew_least: int = 8


def by_form(c: Column, rules: FillerRules = FillerRules()) -> Column:
    """NULL, NaN, infinite, zero, minus one and nines, or any negative if the column has no measurements below zero."""
    nines = F.abs(c).isin(*LONG_NINES) | c.isin(*(-v for v in SHORT_NINES)) | c.isin(0.0, -1.0, -9.0)
    if not rules.negatives_measure:
        nines = nines | (c < 0)
    return c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))) | nines


def short_nines(df: DataFrame, columns: list[str], rules: FillerRules = FillerRules()) -> dict[str, list[float]]:
    """For each column those of 99 and 999 that stand out from the values beside them. One small aggregate over all rows."""
    aggs = []
    for c in columns:
        for v in SHORT_NINES:
            near = (F.abs(F.col(c) - F.lit(v)) <= v * rules.beside) & (F.col(c) != F.lit(v))
            aggs += [F.count_if(F.col(c) == F.lit(v)).alias(f"{c}|{v}|at"), F.count_if(near).alias(f"{c}|{v}|near")]
    row = df.select(*columns).agg(*aggs).first().asDict()
    out: dict[str, list[float]] = {c: [] for c in columns}
    for c in columns:
        for v in SHORT_NINES:
            # values beside are recorded to whole units at the coarsest: so many steps lie within the distance
            steps = max(1.0, 2 * v * rules.beside)
            if row[f"{c}|{v}|at"] >= max(rules.least, rules.spike * row[f"{c}|{v}|near"] / steps):
                out[c].append(v)
    return out


def crew_defaults(cells: DataFrame, rules: FillerRules = FillerRules()) -> DataFrame:
    """field, crew, value of the crews' defaults, from cells (field, crew, value) that aren't fillers by form.

    A crew can have at most 1 / crew_share of them per field.
    """
    n = cells.filter("crew is not null").groupBy("field", "crew", "value").agg(F.count(F.lit(1)).alias("n"))
    crew = n.groupBy("field", "crew").agg(F.sum("n").alias("n_crew"))
    all_ = crew.groupBy("field").agg(F.sum("n_crew").alias("n_all"))
    large = n.join(crew, ["field", "crew"]).filter((F.col("n") >= rules.crew_least) & (F.col("n") >= rules.crew_share * F.col("n_crew")))
    value = n.groupBy("field", "value").agg(F.sum("n").alias("n_value"))
    both = large.join(value, ["field", "value"]).join(all_, "field")
    elsewhere = (F.col("n_value") - F.col("n")) / F.greatest(F.col("n_all") - F.col("n_crew"), F.lit(1))
    return both.filter(F.col("n") / F.col("n_crew") >= rules.crew_ratio * elsewhere).filter("n_all > n_crew").select("field", "crew", "value")
