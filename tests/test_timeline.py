"""Epochs and delivery periods with known days."""

from __future__ import annotations

from datetime import datetime

import pytest

from cellweave.functions.timeline import Duration, deliveries, epochs

MONTH = Duration.parse("P1M")


def days(*pairs):
    return [(a, b) for a, b in pairs]


@pytest.mark.parametrize(
    ("start", "end", "length", "more", "want"),
    [
        ((2023, 2, 10), (2024, 1, 1), "P3M", {"align": "calendar", "partial": True}, days(("2023-02-10", "2023-05-01"), ("2023-05-01", "2023-08-01"), ("2023-08-01", "2023-11-01"), ("2023-11-01", "2024-01-01"))),
        ((2023, 1, 15), (2023, 3, 10), "P1M", {"align": "calendar", "partial": True}, days(("2023-01-15", "2023-02-01"), ("2023-02-01", "2023-03-01"), ("2023-03-01", "2023-03-10"))),
        ((2023, 1, 31), (2023, 6, 1), "P1M", {}, days(("2023-01-31", "2023-02-28"), ("2023-02-28", "2023-03-31"), ("2023-03-31", "2023-04-30"), ("2023-04-30", "2023-05-31"))),
    ],
)
def test_epochs(start, end, length, more, want):
    more = dict(more)
    align = [more.pop("align")] if "align" in more else []
    got = epochs(datetime(*start), datetime(*end), Duration.parse(length), *align, **more)
    assert [(f"{e.start:%Y-%m-%d}", f"{e.end:%Y-%m-%d}") for e in got] == want


def test_calendar_months_whole_and_dropped():
    firsts = [datetime(1996 + k // 12, k % 12 + 1, 1) for k in range(25)]
    assert [(e.start, e.end) for e in epochs(datetime(1996, 1, 1), datetime(1998, 1, 1), MONTH, "calendar")] == list(zip(firsts, firsts[1:], strict=False))
    inner = epochs(datetime(1996, 1, 10), datetime(1997, 12, 20), MONTH, "calendar")
    assert [(e.start, e.end) for e in inner] == list(zip(firsts[1:-2], firsts[2:-1], strict=True))


def told(periods):
    return [(f"{p.start:%Y-%m-%d}", f"{p.end:%Y-%m-%d}", len(p.epochs), f"{p.epochs[0].start:%Y-%m-%d}", f"{p.epochs[-1].end:%Y-%m-%d}") for p in periods]


def test_the_last_period_is_delivered_short():
    year = Duration.parse("P1Y")
    assert told(deliveries(datetime(2022, 8, 1), datetime(2026, 7, 31), MONTH, year, year)) == [
        ("2022-08-01", "2023-08-01", 12, "2022-08-01", "2023-08-01"), ("2023-08-01", "2024-08-01", 12, "2023-08-01", "2024-08-01"),
        ("2024-08-01", "2025-08-01", 12, "2024-08-01", "2025-08-01"), ("2025-08-01", "2026-07-01", 11, "2025-08-01", "2026-07-01"),
    ]
    assert told(deliveries(datetime(2025, 1, 1), datetime(2026, 1, 1), Duration.parse("P1W"), year)) == [("2025-01-01", "2025-12-31", 52, "2025-01-01", "2025-12-31")]
