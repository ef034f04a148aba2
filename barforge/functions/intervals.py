"""Interval handling (driver-side arguments, turned into literals).

``infer_step`` mirrors the feature-side rule: a fixed table of aliases, then
``<n>m|min|minute``, ``<n>h``, ``<n>d``, else five minutes.  ``INTERVAL_MS``
is the ingest-side table, which rejects anything else.
"""

from __future__ import annotations

import re
import warnings
from datetime import datetime, timedelta, timezone

# ---- fixed values: ingest-side supported intervals (milliseconds) ----------
INTERVAL_MS: dict[str, int] = {
    "1m": 60_000,
    "3m": 3 * 60_000,
    "5m": 5 * 60_000,
    "15m": 15 * 60_000,
    "30m": 30 * 60_000,
    "1h": 60 * 60_000,
}

# ---- fixed values: feature-side alias table (interval -> step) -------------
ALIAS_STEP: dict[str, timedelta] = {
    "1m": timedelta(minutes=1),
    "3m": timedelta(minutes=3),
    "5m": timedelta(minutes=5),
    "15m": timedelta(minutes=15),
    "30m": timedelta(minutes=30),
    "1h": timedelta(hours=1),
    "4h": timedelta(hours=4),
    "1d": timedelta(days=1),
}
DEFAULT_STEP = timedelta(minutes=5)

_UNIT = {"m": timedelta(minutes=1), "h": timedelta(hours=1), "d": timedelta(days=1)}
_COUNT = re.compile(r"(\d+)\s*(m|h|d)(?:in(?:ute)?s?)?", re.IGNORECASE)


def _span(text: str, units: str) -> timedelta | None:
    """``<count><unit>`` as a time span, if the text is one."""
    hit = _COUNT.fullmatch(text.strip())
    return int(hit[1]) * _UNIT[hit[2].lower()] if hit and hit[2].lower() in units else None


def infer_step(interval: str) -> timedelta:
    """Fixed grid step of a bar interval (feature side)."""
    step = ALIAS_STEP.get(interval) or _span(interval, "mhd")
    if step is None:
        warnings.warn(f"unknown interval {interval!r}; using 5 minutes", stacklevel=2)
    return step or DEFAULT_STEP


def step_micros(interval_or_step) -> int:
    step = interval_or_step if isinstance(interval_or_step, timedelta) else infer_step(interval_or_step)
    return int(step / timedelta(microseconds=1))


def ingest_step_ms(interval: str) -> int:
    """Step in ms for ingest; other intervals are an error."""
    try:
        return INTERVAL_MS[interval]
    except KeyError:
        raise ValueError(f"candles of {interval!r} can't be fetched; choose from {sorted(INTERVAL_MS)}") from None


#: Forms of an absolute time that ISO 8601 does not cover.
_DATE_FORMS = ("%Y/%m/%d", "%Y/%m/%d %H:%M", "%Y/%m/%d %H:%M:%S", "%d %b %Y", "%b %d %Y", "%Y%m%d")


def _absolute(text: str) -> datetime:
    try:
        return datetime.fromisoformat(text.upper())
    except ValueError:
        pass
    for form in _DATE_FORMS:
        try:
            return datetime.strptime(text, form)
        except ValueError:
            continue
    raise ValueError(f"{text!r} is neither a time nor a span such as 7d or 12h")


def parse_time(text: str | None, now: datetime | None = None) -> datetime | None:
    """``7d`` and ``12h`` mean so long before ``now``; other texts are times,
    in UTC unless they say otherwise; None stays None."""
    if text is None:
        return None
    ago = _span(text, "dh")
    if ago is not None:
        return (now or datetime.now(timezone.utc)) - ago
    at = _absolute(text.strip())
    return at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)


#: Length of a window of which neither days nor a start is given.
DEFAULT_WINDOW = timedelta(days=7)


def resolve_window(days: int | None = None, start: str | None = None,
                   end: str | None = None, interval: str = "1m",
                   now: datetime | None = None) -> tuple[datetime, datetime]:
    """``[start, end)`` of a bounded scan, from a number of days up to now or
    from start and end (now and a week before the end where not given)."""
    ingest_step_ms(interval)
    now = now or datetime.now(timezone.utc)
    if days is not None and not (start or end):
        return now - timedelta(days=days), now
    if days is not None:
        raise ValueError("a window has either days or a start and an end")
    until = parse_time(end, now) if end else now
    return (parse_time(start, now) if start else until - DEFAULT_WINDOW), until
