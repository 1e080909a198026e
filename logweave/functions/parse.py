"""Column expressions for parsing raw log lines.

Line layout: ``<time token>[|<reason>|<message>]`` or
``<time token> ... <reason>: <message>``. All blanks are Unicode blanks
(``(?U)\\s``), as in Python's ``str.split`` / ``str.strip``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time layout of the first 19 characters of the time token
# (single-digit parts accepted), bucket width in seconds, NUL-scrub length.
TIME_PATTERN = "yyyy-M-d'T'H:m:s"
BUCKET_SECONDS = 300
NUL_SCRUB_MIN_LEN = 36

_LSTRIP = r"(?U)^\s+"
_STRIP = r"(?U)^\s+|\s+$"


def ltrim_u(c: Column) -> Column:
    return F.regexp_replace(c, _LSTRIP, "")


def strip_u(c: Column) -> Column:
    return F.regexp_replace(c, _STRIP, "")


def is_blank(line: Column) -> Column:
    return F.regexp_like(line, F.lit(r"(?U)^\s*$"))


def time_token(line: Column) -> Column:
    """First blank-delimited word, cut at the first ``|``."""
    return F.regexp_extract(line, r"(?U)^\s*([^\s|]*)", 1)


def scrub_nul(tok: Column, enabled: bool = True) -> Column:
    """Drop NUL bytes from an over-long time token (only used for parsing)."""
    if not enabled:
        return tok
    return F.when(F.length(tok) >= NUL_SCRUB_MIN_LEN, F.translate(tok, "\u0000", "")).otherwise(tok)


def parse_time(tok: Column) -> Column:
    """timestamp_ntz of the first 19 characters, null when invalid.

    Parsed in the session zone and cast back to wall-clock time, so epoch
    seconds read as UTC whatever the session zone is (contract Q6).
    """
    return F.try_to_timestamp(F.substring(tok, 1, 19), F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """P5: whole epoch seconds of a wall-clock timestamp."""
    return F.unix_timestamp(ts)


def time_bucket(ts: Column, seconds: int = BUCKET_SECONDS) -> Column:
    """5-minute bucket number ``floor(epoch / 300)``."""
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds)).cast("long")


def remainder(line: Column, tok: Column) -> Column:
    """Text after the token and one more character, stripped (Q1, Q2)."""
    return strip_u(F.substr(ltrim_u(line), F.length(tok) + 2))


def split_reason_message(rest: Column) -> tuple[Column, Column, Column]:
    """``(reason, message, has_separator)``.

    A ``|`` wins: reason is the text before it (not stripped). Otherwise the
    first ``:`` splits, and reason is the last word before it (null when there
    is no word, Q4). No separator at all is a reject (Q3).
    """
    has_pipe = F.instr(rest, "|") > 0
    has_colon = F.instr(rest, ":") > 0
    pipe_parts = F.split(rest, r"\|", 2)
    colon_parts = F.split(rest, ":", 2)
    colon_words = F.split(strip_u(colon_parts.getItem(0)), r"(?U)\s+")
    colon_reason = F.when(F.length(strip_u(colon_parts.getItem(0))) > 0, F.element_at(colon_words, -1))
    reason = F.when(has_pipe, pipe_parts.getItem(0)).when(has_colon, colon_reason)
    message = F.when(has_pipe, strip_u(pipe_parts.getItem(1))).when(has_colon, strip_u(colon_parts.getItem(1)))
    return reason, message, has_pipe | has_colon
