"""Dates and times that arrive as text.

Bad text becomes NULL and never an error, whatever ``spark.sql.ansi.enabled`` says, and every instant
is a ``timestamp_ntz``, so the session time zone plays no part.
"""

from __future__ import annotations

SECONDS_PER_DAY = 86_400
_FIRST_DAY = "1970-01-01"


def hour_of(text: str) -> str:
    """Leading hour number of a time text: ``'19:34:22'`` is 19, ``'9:05:00'`` is 9.

    Text that does not start with a number counts as hour 0; NULL stays NULL.
    """
    return (
        f"CASE WHEN {text} IS NOT NULL THEN coalesce(try_cast(left({text}, 2) AS INT), "
        f"try_cast(left({text}, 1) AS INT), 0) END"
    )


def seconds_of_day(text: str) -> str:
    """Seconds since midnight of ``H:m:s`` text, missing parts counting as 0; NULL for other text.

    Blanks around the text do not count. Besides digits, colons and a point nothing may stand in it, so a
    time with a zone is unreadable. All parts of an empty text are missing: it is midnight.

    Reads the text as a time on the first day of the epoch, which is the cheapest reader Spark has.
    """
    plain = f"trim({text})"
    read = (
        f"CASE WHEN translate({plain}, '0123456789:.', '') = '' "
        f"THEN try_cast(concat('{_FIRST_DAY} ', {plain}) AS TIMESTAMP_NTZ) END"
    )
    return f"CAST(CAST({read} - TIMESTAMP_NTZ'{_FIRST_DAY}' AS INTERVAL SECOND) AS INT)"


def _part(text: str, separator: str, number: int) -> str:
    """``split_part`` for a one-character separator and a number from 2 on, without the regular
    expression that Spark splits with."""
    upto = f"substring_index({text}, '{separator}', {number})"
    before = f"substring_index({text}, '{separator}', {number - 1})"
    return f"substring({upto}, length({before}) + 2)"


def _date_text(text: str, year_digits: int) -> str:
    """``d.M.y`` text turned round to ``y-M-d``, the form Spark's own reader takes."""
    year = _part(text, ".", 3)
    if year_digits == 2:
        number = f"try_cast({year} AS INT)"
        year = f"CASE WHEN {number} BETWEEN 0 AND 99 THEN ({number} + 30) % 100 + 1970 END"
    month = f"substring_index(substring_index({text}, '.', 2), '.', -1)"
    return f"concat({year}, '-', {month}, '-', substring_index({text}, '.', 1))"


def parse_date(text: str, year_digits: int = 2) -> str:
    """Date of ``d.M.yy`` (or ``d.M.yyyy``) text. Two-digit years below 70 are 20xx, others 19xx."""
    return f"try_cast({_date_text(text, year_digits)} AS DATE)"


def instant(date: str, seconds: str | int) -> str:
    """``date`` 00:00 plus a number of seconds, as ``timestamp_ntz``."""
    return f"timestampadd(SECOND, {seconds}, CAST({date} AS TIMESTAMP_NTZ))"


def parse_datetime(date_text: str, time_text: str) -> str:
    """Instant of a ``d.M.yy`` date text and an ``H:m:s`` time text."""
    return instant(parse_date(date_text), seconds_of_day(time_text))


def parse_datetime_text(text: str) -> str:
    """Instant of ``d.M.yyyy H:m:s`` text (four-digit year)."""
    date = _date_text(f"substring_index({text}, ' ', 1)", year_digits=4)
    return f"try_cast(concat({date}, ' ', {_part(text, ' ', 2)}) AS TIMESTAMP_NTZ)"


def minutes_between(start: str, end: str) -> str:
    """Whole minutes from ``start`` to ``end``, truncated towards zero.

    ``timestampdiff`` would read ``timestamp_ntz`` values in the session time zone, and count an
    hour too many or too few across a clock change.
    """
    return f"CAST(CAST({end} - {start} AS INTERVAL MINUTE) AS BIGINT)"
