"""The shift calendar and the expressions that follow from it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from shiftline.functions.text_time import SECONDS_PER_DAY, hour_of, instant, seconds_of_day


@dataclass(frozen=True)
class Shift:
    """``first_hour`` is inclusive, ``end_hour`` exclusive (24 = midnight)."""

    label: str
    first_hour: int
    end_hour: int
    order: int
    previous_date: bool = False  # booked on the date before the calendar day

    @property
    def end_text(self) -> str:
        return f"{self.end_hour % 24:02d}:00"


@dataclass(frozen=True)
class ShiftCalendar:
    """Shifts of one production day.

    The last shift is the default for hours no other shift claims, NULL included. A record whose
    ``time_begin`` lies at or after ``evening_hour`` may run past midnight, and its slots before
    ``morning_hour`` then belong to the next calendar day.
    """

    shifts: tuple[Shift, ...]
    morning_hour: int
    evening_hour: int

    def pick(self, hour: str, value: Callable[[Shift], str | int]) -> str:
        """``value(shift)`` of the shift that holds ``hour``; text becomes a literal."""

        def literal(shift: Shift) -> str:
            found = value(shift)
            return f"'{found}'" if isinstance(found, str) else str(found)

        *claimed, default = self.shifts
        cases = " ".join(
            f"WHEN {hour} BETWEEN {shift.first_hour} AND {shift.end_hour - 1} THEN {literal(shift)}"
            for shift in claimed
        )
        return f"CASE {cases} ELSE {literal(default)} END"

    def label(self, hour: str) -> str:
        return self.pick(hour, lambda shift: shift.label)

    def order(self, hour: str) -> str:
        return self.pick(hour, lambda shift: shift.order)

    def end_text(self, hour: str) -> str:
        return self.pick(hour, lambda shift: shift.end_text)

    def end_instant(self, hour: str, date: str) -> str:
        """End of the shift that holds ``hour`` on ``date``, as an instant."""
        return instant(date, self.pick(hour, lambda shift: shift.end_hour * 3600))

    def production_date(self, hour: str, date: str) -> str:
        """Date on which work at ``hour`` of the calendar day ``date`` is booked."""
        return f"date_sub({date}, {self.pick(hour, lambda shift: int(shift.previous_date))})"

    def next_shift(self, shift: Shift) -> Shift:
        return next(s for s in self.shifts if s.first_hour == shift.end_hour % 24)

    def is_evening(self, time_begin: str) -> str:
        """Whether a record that begins at ``time_begin`` may run past midnight."""
        return f"coalesce({hour_of(time_begin)} >= {self.evening_hour}, false)"

    def seconds_from_record_date(self, evening: str, time_text: str) -> str:
        """Seconds from midnight of a record's date to ``time_text``; in an evening record, times
        before the morning lie on the next day."""
        day_starts = f"CASE WHEN {evening} THEN {self.morning_hour * 3600} ELSE 0 END"
        seconds = f"{seconds_of_day(time_text)} - ({day_starts})"
        return f"pmod({seconds}, {SECONDS_PER_DAY}) + ({day_starts})"


# The three eight-hour shifts; C is booked on the previous date.
THREE_SHIFTS = ShiftCalendar(
    shifts=(
        Shift("A", 8, 16, 1),
        Shift("B", 16, 24, 2),
        Shift("C", 0, 8, 3, previous_date=True),
    ),
    morning_hour=8,
    evening_hour=16,
)
