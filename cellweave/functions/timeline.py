"""Calendar durations, epochs and delivery periods. Driver arithmetic: a run has a few hundred epochs at most."""

from __future__ import annotations

import calendar
import re
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

_ISO = re.compile(r"P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?$")
ALIGNS = ("exact", "center", "trailing", "leading")


@dataclass(frozen=True)
class Duration:
    """Whole months, then days. whole_years tells P1Y from P12M: only the calendar boundary differs."""

    months: int = 0
    days: int = 0
    whole_years: bool = field(default=False, compare=False)

    @classmethod
    def parse(cls, text: str) -> Duration:
        m = _ISO.fullmatch(text.strip())
        if not m or not any(m.groups()):
            raise ValueError(f"not a period of years, months, weeks and days: {text}")
        y, mo, w, d = (int(x or 0) for x in m.groups())
        if not (y or mo or w or d):
            raise ValueError(f"an empty period: {text}")
        return cls(12 * y + mo, 7 * w + d, bool(y and not mo))

    def after(self, start: datetime, times: int = 1) -> datetime:
        """start plus so many of it, counted once from start: months first, held to the month's last day."""
        month = start.month - 1 + self.months * times
        year, month = start.year + month // 12, month % 12 + 1
        day = min(start.day, calendar.monthrange(year, month)[1])
        return start.replace(year=year, month=month, day=day) + timedelta(days=self.days * times)

    def parts_of(self, other: Duration) -> int | None:
        """How many of self make other, if they divide it; months and days never divide each other."""
        k = other.months // self.months if self.months else 0 if other.months else other.days // self.days
        return k if k > 0 and (self.months * k, self.days * k) == (other.months, other.days) else None


@dataclass(frozen=True)
class Span:
    """start <= t < end."""

    start: datetime
    end: datetime

    def __contains__(self, t: datetime) -> bool:
        return self.start <= t < self.end


def utc(t: datetime) -> datetime:
    """Naive means UTC."""
    return t.replace(tzinfo=UTC) if t.tzinfo is None else t.astimezone(UTC)


def _boundary(start: datetime, step: Duration) -> datetime:
    """The calendar boundary at or before start: of the year for whole years, of the month for any months, else midnight."""
    day = start.replace(hour=0, minute=0, second=0, microsecond=0)
    return day.replace(month=1, day=1) if step.whole_years else day.replace(day=1) if step.months else day


def epochs(start: datetime, end: datetime, step: Duration, align: str = "start", partial: bool = False) -> list[Span]:
    """Consecutive steps from start, or from the calendar boundary before it, that cover start..end.

    Steps that start or end cuts short are left out, as their votes would rest on less; with partial they are there, cut.
    """
    if end <= start:
        raise ValueError(f"{end} is not after {start}")
    at, out, k = _boundary(start, step) if align == "calendar" else start, [], 0
    while (begin := step.after(at, k)) < end:
        until = step.after(at, k + 1)
        if until > start and (partial or (begin >= start and until <= end)):
            out.append(Span(max(begin, start), min(until, end)))
        k += 1
    return out


@dataclass(frozen=True)
class Delivery:
    """A product period: what it is named after, and the epochs that it owns."""

    start: datetime
    end: datetime
    epochs: tuple[Span, ...]


def deliveries(start: datetime, end: datetime, step: Duration, every: Duration, window: Duration | None = None, align: str = "exact", epoch_align: str = "start") -> list[Delivery]:
    """Every period of the time, each with the whole epochs of its window.

    exact      the window is the period
    trailing   the window ends with the period
    leading    the window starts with the period
    center     the surplus lies around the period, the odd epoch after it
    Windows are cut at the first and the last epoch, and a last period may own fewer epochs than the others.
    An epoch that doesn't divide the period is allowed for exact windows only: such periods are placed in time, and own the epochs that lie within.
    """
    window = window or every
    if align not in ALIGNS:
        raise ValueError(f"align is one of {ALIGNS}: {align}")
    n, w = step.parts_of(every), step.parts_of(window)
    if n and w and w < n:
        raise ValueError("a window is no shorter than its period")
    if align == "exact" and window != every:
        raise ValueError("an exact window is the period itself")
    whole = epochs(start, end, step, epoch_align)
    if n and w:
        before = {"exact": 0, "leading": 0, "trailing": w - n, "center": (w - n) // 2}[align]
        periods = [(whole[k : k + n], whole[max(0, k - before) : max(0, k - before + w)]) for k in range(0, len(whole), n)]
        return [Delivery(own[0].start, own[-1].end, tuple(drawn)) for own, drawn in periods]
    if align != "exact":
        raise ValueError("a rolling window needs a period and a window that are whole multiples of the epoch")
    out, k = [], 0
    while (begin := every.after(start, k)) < end:
        until = every.after(start, k + 1)
        if own := tuple(e for e in whole if begin <= e.start and e.end <= until):
            out.append(Delivery(own[0].start, own[-1].end, own))
        k += 1
    return out
