"""Trip cleaning, capping, splitting and formatting. All of it is row-local: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetledger.functions import scalars, times
from fleetledger.params import COLUMN_RENAME_MAP, INPUT_DATETIME_FORMAT

START, END, DISTANCE = "o_fecha_inicial", "o_fecha_final", "f_distancia"
TRIP_ID, DEVICE = "k_ruta", "k_dispositivo"

# Bounds used when a caller gives none (metres; minutes).
MIN_DISTANCE, MAX_DISTANCE = 0, 9_000_000
MIN_DURATION, MAX_DURATION = 2, 90

# Segments of one trip are generated in blocks, so no array of them grows with the trip, and
# their weights are summed in runs of these lengths.
_BLOCK, _RUN = 8_192, 256
# Up to this many segments the time arithmetic fits a bigint.
_EXACT_SEGMENTS = 300_000


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def replace_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Replace columns by costly expressions that later filters must not repeat.

    Catalyst pushes a filter below a projection by copying the projection's
    expressions into it; it does not push one through a generator.
    """
    once = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], once).select(*[f"`{c}`" for c in df.columns])


def parse_times(df: DataFrame, fmt: str = INPUT_DATETIME_FORMAT, columns: Sequence[str] = (START, END),
                strict: bool = True) -> DataFrame:
    """Time text columns to timestamps, in place."""
    return replace_once(df, {c: times.parse_time(c, fmt, strict) for c in columns})


def filter_distance(df: DataFrame, low: float = MIN_DISTANCE, high: float | None = None,
                    column: str = DISTANCE) -> DataFrame:
    """Keep ``low < distance <= high``; no upper bound when high is missing or 0."""
    return df.where(scalars.in_range(column, low, high))


def filter_duration(df: DataFrame, low: float = MIN_DURATION, high: float | None = None,
                    start: str = START, end: str = END) -> DataFrame:
    """Keep ``low < minutes <= high`` and add ``durationMinutes``."""
    timed = df.withColumn("durationMinutes", scalars.duration_minutes(start, end))
    return timed.where(scalars.in_range("durationMinutes", low, high))


def filter_reference(df: DataFrame, column: str = "Referencia") -> DataFrame:
    """Keep rows that name a client."""
    return df.where(F.col(column).isNotNull())


def cap_distance(df: DataFrame, max_per_hour: float) -> DataFrame:
    """Lower distances no vehicle can reach in the trip's time; adds the duration and the bound."""
    timed = df.withColumn("durationMinutes", scalars.duration_minutes(START, END))
    bound = timed.withColumn("maxExpectedDistance", scalars.plausible_distance("durationMinutes", max_per_hour))
    return bound.withColumn(DISTANCE, scalars.capped(DISTANCE, "maxExpectedDistance"))


def count_segments(df: DataFrame, max_distance: float, avg_distance: float) -> DataFrame:
    """Add ``segments``: how many parts a trip is cut into."""
    return df.withColumn("segments", scalars.segment_count(DISTANCE, max_distance, avg_distance))


def split(df: DataFrame, seed: int = 0, key: str = TRIP_ID) -> DataFrame:
    """Cut each trip into its ``segments``; adds ``segment`` (0, 1, ...).

    Every segment's weight is uniform in 0.8-1.2 of the mean and drawn by itself
    from trip id, segment and seed. A segment starts after the weights before it:
    sums of whole runs, then of its own run, all from the trip's row, so nothing
    is shuffled. Only a long trip has a list of sums, one number per ``_RUN``
    segments. Times are exact integer microseconds; the last segment ends
    at the trip's end.
    """
    require_columns(df, key, START, END, DISTANCE, "segments")
    unit = f"{scalars.SHARE_UNIT}L"
    kept = [f"`{c}`" for c in df.columns if c not in (START, END, DISTANCE)]

    def drawn(first: str, last: str) -> str:
        """The sum of the draws of these segments."""
        return f"aggregate(sequence({first}, {last}), 0L, (a, s) -> a + {scalars.segment_jitter(f'`{key}`', 's', seed)})"

    run = f"segment div {_RUN}"
    sums = f"transform(sequence(0L, (segments - 1) div {_RUN}), r -> {drawn(f'r * {_RUN}', f'least(r * {_RUN} + {_RUN - 1}, segments - 1)')})"
    starts = (f"aggregate({sums}, named_struct('p', array(0L), 'n', 0L), "
              "(a, x) -> named_struct('p', concat(a.p, array(a.n + x)), 'n', a.n + x)).p")
    whole = (
        df.selectExpr("*", f"if(segments > {_RUN}, {starts}, null) as _starts",
                      f"unix_micros({START}) as _t0", f"unix_micros({END}) - unix_micros({START}) as _t")
        .selectExpr("*", f"segments * {unit} + case when segments = 1 then 0L when segments <= {_RUN} then {drawn('0L', 'segments - 1')} "
                         f"else element_at(_starts, -1) end as _all"))
    each = (
        whole.selectExpr("*", f"explode(sequence(0L, (segments - 1) div {_BLOCK})) as _block")
        .selectExpr("*", f"explode(sequence(_block * {_BLOCK}, least(_block * {_BLOCK} + {_BLOCK - 1}, segments - 1))) as segment"))
    weighted = each.selectExpr(
        "*", f"{unit} + if(segments = 1, 0L, {scalars.segment_jitter(f'`{key}`', 'segment', seed)}) as _w",
        f"segment * {unit} + if({run} = 0, 0L, element_at(_starts, int({run}) + 1)) "
        f"+ if(segment % {_RUN} = 0, 0L, {drawn(f'{run} * {_RUN}', 'segment - 1')}) as _before")

    def moment(cum: str) -> str:
        # _t * cum div _all without the large product, which only a decimal holds for very long trips
        return (f"timestamp_micros(_t0 + if(segments <= {_EXACT_SEGMENTS}, "
                f"(_t div _all) * ({cum}) + ((_t % _all) * ({cum})) div _all, "
                f"(cast(_t as decimal(20,0)) * cast({cum} as decimal(18,0))) div cast(_all as decimal(18,0))))")

    return weighted.selectExpr(
        *kept, "segment",
        f"if(segments = 1, {START}, {moment('_before')}) as {START}",
        f"if(segments = 1, {END}, {moment('_before + _w')}) as {END}",
        f"if(segments = 1, {DISTANCE}, {DISTANCE} * cast(_w as double) / cast(_all as double)) as {DISTANCE}")


def split_summary(df: DataFrame, *by: str) -> DataFrame:
    """Trips before the split, segments after it, and how many the split adds."""
    return df.groupBy(*by).agg(
        F.expr("count(1) as original_routes"), F.expr("coalesce(sum(segments), 0) as new_routes"),
        F.expr("coalesce(sum(segments), 0) - count(1) as extra_routes"))


def over_long_segments(df: DataFrame, max_distance: float) -> DataFrame:
    """Count segments that stay above the split bound: shares vary, so a few may."""
    return df.agg(F.count_if(F.col(DISTANCE) > max_distance).alias("over_long_segments"))


def gps_points(df: DataFrame, start: tuple[str, str] = ("lng_inicial", "lat_inicial"),
               end: tuple[str, str] = ("lng_final", "lat_final")) -> DataFrame:
    """Scale integer coordinates to degrees and add start and end location pairs."""
    scale = scalars.double(scalars.LOCATION_SCALE)
    return df.withColumns({
        "startLocation": scalars.location(*start), "endLocation": scalars.location(*end),
        **{c: F.expr(f"{c} / {scale}") for c in (*start, *end)}})


def format_output(df: DataFrame, rename: Mapping[str, str] | Sequence[tuple[str, str]] = COLUMN_RENAME_MAP,
                  time_format: str | Column = "unix", keep: Sequence[str] = ()) -> DataFrame:
    """Format times, round distance half to even, then select, order and rename.

    Columns absent from the data are skipped; the address is always last unless
    the map places it. ``keep`` adds columns (the partition keys) unchanged.
    """
    pairs = list(rename.items() if isinstance(rename, Mapping) else rename)
    if "celo_address" not in dict(pairs):
        pairs.append(("celo_address", "celo_address"))

    def shown(name: str) -> Column:
        if name in (START, END):
            return times.format_time(name, time_format)
        if name == DISTANCE:
            return scalars.round_half_even(name)
        return F.col(name)

    return df.select(*[shown(a).alias(b) for a, b in pairs if a in df.columns], *keep)
