"""Number expressions that must not depend on floating point or on ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

# With more decimal places a mean could not be decided within Spark's 38 digits.
MOST_PLACES = 17


def exact_mean(total: str, count: str, places: int = 5) -> str:
    """``total / count`` rounded to two places, halves away from zero; NULL when ``count`` is 0.

    ``total`` is a decimal with ``places`` decimal places and at most 33 digits. The rounding is
    decided on whole numbers, so no digit is lost and no value is rounded twice, however many
    readings went into the total.
    """
    if places > MOST_PLACES:
        raise ValueError(f"means of numbers with more than {MOST_PLACES} decimal places")
    divisor = f"CAST(nullif({count}, 0) AS DECIMAL(20,0))"
    doubled = f"CAST(abs({total}) AS DECIMAL(33,{places})) * 200 + {divisor}"
    hundredths = f"({doubled}) div CAST({divisor} * 2 AS DECIMAL(21,0))"
    signed = f"CAST(CAST(sign({total}) AS INT) * ({hundredths}) AS DECIMAL(20,0))"
    return f"CAST({signed} * 0.01 AS DECIMAL(18,2))"


# A number of smallest units is kept as a high and a low part, which can be added up as bigints: below
# these bounds neither sum comes near 63 bits.
MOST_IN_PARTS = 10**18
MOST_ROWS_IN_PARTS = 2**32
_LOW_BITS = 30


def whole_units(number: str, places: int) -> str:
    """A number with ``places`` decimal places, in units of the last one; below ``MOST_IN_PARTS``."""
    if places > MOST_PLACES:
        raise ValueError(f"means of numbers with more than {MOST_PLACES} decimal places")
    return f"CAST(CAST({number} AS DECIMAL(18,{places})) * CAST({10**places} AS DECIMAL(18,0)) AS BIGINT)"


def high_part(units: str) -> str:
    return f"shiftright({units}, {_LOW_BITS})"


def low_part(units: str) -> str:
    return f"({units} & {2**_LOW_BITS - 1})"


def parts_are_small(
    highs: Sequence[str], lows: Sequence[str], counts: Sequence[str], places: int
) -> str:
    """Whether 63 bits are enough for the means of totals with up to ``places`` decimal places, and
    none is negative."""
    # Counts stay below the power of two whose product with a unit stays below 2 ** 60.
    bits = (highs, 22), (lows, 52), (counts, 60 - (10**places).bit_length())
    return " AND ".join(
        f"({' | '.join(numbers)}) BETWEEN 0L AND {2**most - 1}L" for numbers, most in bits
    )


def exact_mean_of_parts(high: str, low: str, count: str, places: int, small: str) -> str:
    """As ``exact_mean``, of a total in units that sums of high and low parts tell.

    Where ``parts_are_small`` the total is divided as a bigint, else as a decimal.
    """
    unit = 10**places
    bigint = f"(shiftleft({high}, {_LOW_BITS}) + {low}) * 200L div (nullif({count}, 0L) * {unit}L)"
    total = f"CAST(high AS DECIMAL(20,0)) * {2**_LOW_BITS} + {low}"
    decimal = f"abs({total}) * 200 div (CAST(nullif({count}, 0L) AS DECIMAL(19,0)) * {unit}BD)"
    # In a lambda, because those are not compiled: as a part of the compiled method, decimals that are
    # seldom needed would make it longer than the JVM compiles.
    decimal = f"element_at(transform(array({high}), high -> {decimal}), 1)"
    # Halves of hundredths, cut off; the odd ones are at least a half and go up.
    hundredths = f"(CASE WHEN {small} THEN {bigint} ELSE {decimal} END + 1L) div 2L"
    negative = f"{high} + shiftright({low}, {_LOW_BITS}) < 0"
    signed = f"CAST(({hundredths}) * IF({negative}, -1L, 1L) AS DECIMAL(20,0))"
    return f"CAST({signed} * 0.01 AS DECIMAL(18,2))"


def to_whole_number(text: str) -> str:
    """Number written in ``text``, fraction cut off, as a bigint; NULL when there is none.

    A plain cast also reads Java suffixes (``'12D'``, ``'12F'``), which are names, not numbers.
    """
    plain = rf"{text} RLIKE r'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
    return (
        f"coalesce(try_cast({text} AS BIGINT), "
        f"CASE WHEN {plain} THEN try_cast(try_cast({text} AS DOUBLE) AS BIGINT) END)"
    )


def share(quantity: str, part: str, whole: str) -> str:
    """``quantity * part / whole`` rounded half away from zero; NULL when ``whole`` is 0."""
    return f"CAST(round({quantity} * {part} / nullif({whole}, 0)) AS BIGINT)"
