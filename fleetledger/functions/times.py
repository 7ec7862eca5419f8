"""Time text: strftime formats on Spark's own parser and formatter."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime directive -> datetime pattern, padded as strftime prints it.
_DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh", "%M": "mm",
    "%S": "ss", "%f": "SSSSSS", "%p": "a", "%j": "DDD", "%b": "MMM", "%B": "MMMM",
    "%a": "EEE", "%A": "EEEE", "%z": "xx",
}
# Directives that strptime reads with or without a leading zero.
_UNPADDED = {"%m", "%d", "%H", "%I", "%M", "%S"}

# Text padded in full, for formats that a cast reads to the same value several times faster.
_PADDED = {
    "%Y-%m-%d %H:%M:%S": r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$",
    "%Y-%m-%dT%H:%M:%S.%f": r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{1,6}$",
    "%Y-%m-%d": r"^\d{4}-\d\d-\d\d$",
}


def to_pattern(fmt: str, parsing: bool = False) -> str:
    """Translate a strftime format; for parsing, allow unpadded numbers where unambiguous."""
    parts = re.findall(r"%.|[^%]+|%$", fmt)
    out = []
    for i, part in enumerate(parts):
        if part == "%%":
            out.append("%")
        elif part.startswith("%"):
            if part not in _DIRECTIVES:
                raise ValueError(f"unsupported directive {part} in {fmt!r}")
            pattern = _DIRECTIVES[part]
            beside_digits = any(
                0 <= j < len(parts) and parts[j].startswith("%") and parts[j] != "%%" for j in (i - 1, i + 1))
            out.append(pattern[0] if parsing and part in _UNPADDED and not beside_digits else pattern)
        else:
            out.append(re.sub(r"[A-Za-z'\[\]{}#]+", lambda m: "'" + m.group(0).replace("'", "''") + "'", part))
    return "".join(out)


def parse_time(text: Column | str, fmt: str, strict: bool = True) -> Column:
    """Text to timestamp. Unparseable text raises when strict, else gives null."""
    text = F.col(text) if isinstance(text, str) else text
    pattern = to_pattern(fmt, parsing=True)
    parsed = F.to_timestamp(text, pattern) if strict else F.try_to_timestamp(text, F.lit(pattern))
    if fmt in _PADDED:
        cast = text.cast("timestamp") if strict else text.try_cast("timestamp")
        return F.when(text.rlike(_PADDED[fmt]), cast).otherwise(parsed)
    if "%y" in fmt:  # strptime reads two-digit years 69-99 as 19xx
        return F.when(F.year(parsed) >= 2069, parsed - F.expr("interval 100 years")).otherwise(parsed)
    return parsed


def format_time(ts: Column | str, fmt: str) -> Column:
    """``unix`` gives epoch seconds (floored), anything else formatted text."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(ts) if fmt == "unix" else F.date_format(ts, to_pattern(fmt))


def epoch_seconds(text: Column | str, fmt: str, strict: bool = True) -> Column:
    """Text to epoch seconds."""
    return F.unix_seconds(parse_time(text, fmt, strict))


def strip_zulu(text: Column | str) -> Column:
    """Drop one trailing ``Z``."""
    return F.regexp_replace(F.col(text) if isinstance(text, str) else text, "Z$", "")


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)
