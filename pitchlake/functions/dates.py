"""Ranges of dates that jobs work on."""

from __future__ import annotations

from datetime import date, timedelta


def week_before(day: date) -> tuple[date, date]:
    """From seven days before a day to the day itself."""
    return day - timedelta(days=7), day


def previous_month(day: date) -> tuple[int, int]:
    """Year and month before a day's."""
    last = day.replace(day=1) - timedelta(days=1)
    return last.year, last.month


def season_start(day: date) -> date:
    """The first of March of a day's year."""
    return date(day.year, 3, 1)
