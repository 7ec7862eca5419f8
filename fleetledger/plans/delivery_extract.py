"""The delivery extract: trips of known clients with location pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fleetledger.operators import routes
from fleetledger.sources import writers
from fleetledger.functions import times

# Column names and formats of the export and of the extract.
COLUMN_RENAME_MAP = (
    ("Dispositivo", "gpsID"),
    ("Fecha Inicio", "timestampStart"),
    ("Fecha Fin", "timestampEnd"),
    ("Distancia", "measuredDistance"),
    ("startLocation", "startLocation"),
    ("endLocation", "endLocation"),
    ("durationMinutes", "durationMinutes"),
)
INPUT_FORMAT = "%m/%d/%y %H:%M"
OUTPUT_FORMAT = "%Y-%m-%d %H:%M"


@dataclass(frozen=True)
class ExportColumns:
    """Where the export keeps each value."""

    start: str = "Fecha Inicio"
    end: str = "Fecha Fin"
    distance: str = "Distancia"
    reference: str = "Referencia"
    start_location: tuple[str, str] = ("Lng. Inicial", "Lat. Inicial")
    end_location: tuple[str, str] = ("Lng. Final", "Lat. Final")
    rename: tuple[tuple[str, str], ...] = COLUMN_RENAME_MAP


def extract(raw: DataFrame, columns: ExportColumns = ExportColumns(), input_format: str = INPUT_FORMAT,
            output_format: str = OUTPUT_FORMAT) -> DataFrame:
    """Range and reference filters, parsing, duration, location pairs, renamed and ordered."""
    plain = {c: c.replace(".", "").replace(" ", "_") for c in raw.columns}
    df = raw.toDF(*plain.values())
    start, end = plain[columns.start], plain[columns.end]
    df = routes.filter_distance(df, routes.MIN_DISTANCE, routes.MAX_DISTANCE, plain[columns.distance])
    df = routes.filter_reference(df, plain[columns.reference])
    df = routes.parse_times(df, input_format, (start, end))
    df = routes.filter_duration(df, routes.MIN_DURATION, routes.MAX_DURATION, start, end)
    df = routes.gps_points(
        df, tuple(plain[c] for c in columns.start_location), tuple(plain[c] for c in columns.end_location))
    df = df.withColumns({c: times.format_time(c, output_format) for c in (start, end)})
    df = writers.pairs_as_text(df, "startLocation", "endLocation")
    return df.select(*[df[plain.get(a, a)].alias(b) for a, b in columns.rename])


def write(rows: DataFrame, path: str) -> None:
    """The extract as CSV files with a header."""
    writers.write_table(rows, path, "csv")
