"""Number, text and record expressions.

Arguments are SQL text: a column name or any expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Location integers carry eight decimal digits; terms are given in weeks;
# a segment's share of its trip is drawn from 0.8 to 1.2, here in steps of 1/10000.
LOCATION_SCALE = 100_000_000
DAYS_PER_WEEK = 7
SHARE_UNIT = 10_000
SHARE_JITTER = 2_000

# Texts that tell publication outcomes apart.
ALREADY_MINTED = "ERC721: token already minted"
OVERFLOW = "Panic error 0x11"
REVERT = "revert"


def double(value: float) -> str:
    """A number as a DOUBLE literal."""
    return f"{float(value)!r}D"


def is_missing(number: str) -> Column:
    """Null or NaN: Spark orders NaN above every number, so it needs its own test."""
    return F.expr(f"({number}) is null or isnan({number})")


def in_range(number: str, low: float, high: float | None = None) -> Column:
    """``low < x <= high``; a missing or zero high means unbounded; missing x fails."""
    top = f" and ({number}) <= {double(high)}" if high else ""
    return F.expr(f"({number}) > {double(low)} and not isnan({number}){top}")


def duration_minutes(start: str, end: str) -> Column:
    return F.expr(f"(unix_micros({end}) - unix_micros({start})) / 1e6D / 60D")


def plausible_distance(minutes: str, max_per_hour: float) -> Column:
    return F.expr(f"({minutes}) / 60D * {double(max_per_hour)}")


def capped(distance: str, cap: str) -> Column:
    """Lower to the cap; a missing distance or cap changes nothing (``least`` would invent a value)."""
    return F.expr(f"case when not isnan({distance}) and ({distance}) > ({cap}) then ({cap}) else ({distance}) end")


def segment_count(distance: str, max_distance: float, avg_distance: float) -> Column:
    """How many segments a trip is cut into: by exact remainder, since a division may round up."""
    d, avg = f"({distance})", double(avg_distance)
    return F.expr(
        f"case when not isnan({d}) and {d} > {double(max_distance)} "
        f"then cast(rint(({d} - {d} % {avg}) / {avg}) as bigint) + if({d} % {avg} <> 0D, 1, 0) else 1L end")


def round_half_even(number: str) -> Column:
    return F.expr(f"cast(bround({number}, 0) as bigint)")


def whole_number(number: str, strict: bool = True) -> Column:
    """Toward zero, as an integer. What is missing or no number raises when strict, else gives null."""
    if not strict:
        return F.expr(f"try_cast({number} as bigint)")
    return F.expr(f"coalesce(cast({number} as bigint), cast(raise_error('a required number is missing: {number}') as bigint))")


def first_of(items: str) -> Column:
    """First element of a link field; null when the field is absent or empty."""
    return F.expr(f"try_element_at({items}, 1)")


def non_empty(text: str) -> Column:
    return F.expr(f"nullif({text}, '')")


def term_days(text: str, strict: bool = True) -> Column:
    """First digit run, in weeks, as days. No digits raises when strict, else gives null."""
    digits = f"regexp_extract({text}, '([0-9]+)', 1)"
    none = "cast(raise_error('no digits in the repayment term') as bigint)" if strict else "null"
    return F.expr(f"case when {digits} <> '' then cast({digits} as bigint) * {DAYS_PER_WEEK} "
                  f"when {digits} = '' then {none} end")


def location(lng: str, lat: str) -> Column:
    scale = double(LOCATION_SCALE)
    return F.expr(f"struct({lng} / {scale} as lng, {lat} / {scale} as lat)")


def published_flag(env: str) -> Column:
    """The record's flag for one environment; an absent flag is false."""
    return F.expr(f"coalesce(fields.published_{env}, false)")


def route_status(message: str) -> Column:
    """Outcome of one route attempt."""
    return F.expr(f"case when contains({message}, '{ALREADY_MINTED}') then 'already_minted' "
                  f"when {message} = 'ok' then 'sent' else 'failed' end")


def payment_status(message: str) -> Column:
    """Outcome of one payment attempt; the overflow text also says revert, so it is tested first."""
    return F.expr(f"case when {message} = 'ok' then 'sent' when contains({message}, '{OVERFLOW}') then 'overflow' "
                  f"when contains(lower({message}), '{REVERT}') then 'revert' else 'error' end")


def placeholder_address(client_id: Column | str) -> Column:
    """Default address hook: a hash of the client id, not a wallet."""
    text = F.concat(F.lit("client|"), (F.col(client_id) if isinstance(client_id, str) else client_id).cast("string"))
    return F.concat(F.lit("0x"), F.substring(F.sha2(text, 256), 1, 40))


def segment_jitter(key: str, segment: str, seed: int) -> str:
    """Uniform integer in [-SHARE_JITTER, SHARE_JITTER] for one segment of one trip, as SQL text.

    The cube, modulo the prime 2^31-1, of a number made of trip, segment and seed: in plain
    bigint arithmetic, so that any retry, engine or partitioning gives the same draw, and
    not linear, so that neighbouring segments and trips are drawn independently. Trips
    without an id draw as trip 0.
    """
    prime = "2147483647L"
    x = (f"pmod(pmod(coalesce({key}, 0L), {prime}) * 48271L + pmod({segment}, {prime}) * 69621L "
         f"+ {int(seed) % 2_147_483_647 * 7_919 + 1}L, {prime})")
    return f"(({x} * {x} % {prime}) * {x} % {prime} % {2 * SHARE_JITTER + 1}L - {SHARE_JITTER}L)"
