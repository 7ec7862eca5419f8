"""Per-source processing parameters, held at plan time.

A missing section switches its stage off, so an unused stage never reaches the
plan, and bounds enter the plan as literals that Catalyst can push to the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import md5
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Formats and column names of the trip feed and of the routes table.
INPUT_DATETIME_FORMAT = "%Y-%m-%d %H:%M:%S"
OUTPUT_DATETIME_FORMAT = "%Y-%m-%d %H:%M"
# Seconds, as the routes table declares; text output is for extracts.
ROUTES_TABLE_FORMAT = "unix"
COLUMN_RENAME_MAP = (
    ("newID", "routeID"),
    ("k_dispositivo", "gpsID"),
    ("o_fecha_inicial", "timestampStart"),
    ("o_fecha_final", "timestampEnd"),
    ("f_distancia", "measuredDistance"),
)


@dataclass(frozen=True)
class Range:
    """``(min, max]``; a max that is missing or 0 means no upper bound."""

    min: float
    max: float | None = None


@dataclass(frozen=True)
class SplitRule:
    max_distance: float
    avg_distance: float

    def __post_init__(self) -> None:
        if self.avg_distance <= 0:
            raise ValueError("avg_distance must be positive")


@dataclass(frozen=True)
class SourceParams:
    source: str
    input_datetime_format: str = INPUT_DATETIME_FORMAT
    output_datetime_format: str = ROUTES_TABLE_FORMAT
    column_rename_map: tuple[tuple[str, str], ...] = COLUMN_RENAME_MAP
    distance: Range | None = None
    duration: Range | None = None
    max_per_hour: float | None = None
    split: SplitRule | None = None
    prototype_address: str | None = None

    @classmethod
    def from_document(cls, source: str, doc: Mapping[str, Any], address_section: str = "prototype_address") -> SourceParams:
        """Build from a parameter document (the YAML sections, already parsed).

        ``address_section`` names the section that holds the prototypes' fallback address.
        """

        def bounds(section: str) -> Range | None:
            if section not in doc:
                return None
            top = doc[section].get("max")
            return Range(float(doc[section]["min"]), float(top) if top else None)

        fix, cut = doc.get("distance_fix"), doc.get("split_big_routes")
        fallback = doc.get(address_section)
        return cls(
            source=source,
            input_datetime_format=doc.get("input_datetime_format", INPUT_DATETIME_FORMAT),
            output_datetime_format=doc.get("output_datetime_format", ROUTES_TABLE_FORMAT),
            column_rename_map=tuple(doc.get("column_rename_map", dict(COLUMN_RENAME_MAP)).items()),
            distance=bounds("distance_filter"),
            duration=bounds("duration_filter"),
            max_per_hour=float(fix["expected_max_per_hour"]) if fix else None,
            split=SplitRule(float(cut["max_distance"]), float(cut["avg_distance"])) if cut else None,
            prototype_address=fallback["address"] if fallback else None,
        )


class ParamSet:
    """The parameters of all sources handled in one job."""

    def __init__(self, params: Iterable[SourceParams], column: str = "source") -> None:
        self.params: Sequence[SourceParams] = tuple(params)
        self.column = column
        if not self.params:
            raise ValueError("no source parameters")
        if len({p.source for p in self.params}) != len(self.params):
            raise ValueError("a source is listed twice")

    def known_source(self) -> Column:
        return F.col(self.column).isin([p.source for p in self.params])

    def any(self, get: Callable[[SourceParams], object]) -> bool:
        return any(get(p) is not None for p in self.params)

    def version(self, seed: int = 0) -> Column:
        """What decides how a source's trips are cut, as a short text: cap, split rule and seed."""
        return self.value(
            lambda p: (p.max_per_hour, p.split), lambda rule: F.lit(md5(repr((*rule, seed)).encode()).hexdigest()[:12]))

    def by_value(self, get: Callable[[SourceParams], Any]) -> dict[Any, list[str]]:
        groups: dict[Any, list[str]] = {}
        for p in self.params:
            groups.setdefault(get(p), []).append(p.source)
        return groups

    def predicate(self, get: Callable[[SourceParams], Any], build: Callable[[Any], Column]) -> Column:
        """One filter for all sources, as an OR of plain comparisons.

        Unlike a join with a parameter table or a CASE, this form reaches the
        file scan. Sources where ``get`` gives None pass unfiltered.
        """
        groups = self.by_value(get)
        if len(groups) == 1:
            section = next(iter(groups))
            return F.lit(True) if section is None else build(section)
        branches = []
        for section, sources in groups.items():
            mine = F.col(self.column).isin(sources)
            branches.append(mine if section is None else mine & build(section))
        return reduce(lambda a, b: a | b, branches)

    def value(self, get: Callable[[SourceParams], Any], build: Callable[[Any], Column]) -> Column:
        """One column whose definition depends on the row's source."""
        groups = self.by_value(get)
        if len(groups) == 1:
            return build(next(iter(groups)))
        out = F
        for section, sources in groups.items():
            out = out.when(F.col(self.column).isin(sources), build(section))
        return out

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The parameters as a table, one row per source."""
        rows = [(
            p.source, p.distance and p.distance.min, p.distance and p.distance.max,
            p.duration and p.duration.min, p.duration and p.duration.max, p.max_per_hour,
            p.split and p.split.max_distance, p.split and p.split.avg_distance,
            p.prototype_address, p.output_datetime_format) for p in self.params]
        return spark.createDataFrame(rows, (
            "source string, dist_min double, dist_max double, dur_min double, dur_max double, "
            "max_per_hour double, split_max double, split_avg double, proto_address string, out_format string"))
