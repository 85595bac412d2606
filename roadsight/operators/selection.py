"""The dashboard's filter selection, applied to the *fact* before any
aggregation so that Catalyst pushes it into the Parquet scan."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import day_end_inclusive
from ..schema import VEHICLE_CLASSES


@dataclass(frozen=True)
class Selection:
    """Optional predicates; ``None`` or an empty list means "no filter"."""
    types: tuple[str, ...] | None = None
    severities: tuple[int, ...] | None = None
    date_range: tuple[_dt.date, _dt.date] | None = None

    def predicates(self, type_col: str = "Violation_Type", sev_col: str = "Severity",
                   ts_col: str = "Timestamp") -> list[Column]:
        preds = []
        if self.types:
            preds.append(F.col(type_col).isin(list(self.types)))
        if self.severities:
            preds.append(F.col(sev_col).isin([int(s) for s in self.severities]))
        if self.date_range and len(self.date_range) == 2:
            start, end = self.date_range
            preds.append(F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
            preds.append(F.col(ts_col) <= day_end_inclusive(end))
        return preds


PARTITION_DATE = "event_date"   # partition column of the stored fact


def apply_selection(df: DataFrame, sel: Selection | None) -> DataFrame:
    """Conjunction of the selection's predicates.  On a fact stored by date
    the date range is also stated on the partition column, so whole days are
    pruned before any file is opened."""
    preds = sel.predicates() if sel else []
    if sel and sel.date_range and len(sel.date_range) == 2 and PARTITION_DATE in df.columns:
        start, end = sel.date_range
        preds.append(F.col(PARTITION_DATE).between(F.lit(start), F.lit(end)))
    return df.where(reduce(lambda a, b: a & b, preds)) if preds else df


def valid_coordinates(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """Drop rows with a null or NaN coordinate or a 0 placeholder in either one."""
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()
                    & ~F.isnan(lat) & ~F.isnan(lon)
                    & (F.col(lat) != 0) & (F.col(lon) != 0))


def vehicle_only(df: DataFrame, cls: str = "class_name") -> DataFrame:
    return df.where(F.col(cls).isin(VEHICLE_CLASSES))
