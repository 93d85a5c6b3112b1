"""Windows of each job and how a backfill is cut.

Seconds of delay, window, look-back (``pre``) and look-ahead (``post``).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from opslog.spec import Window, WindowSpec

# Operating windows of the minute jobs.
WINDOWS = {
    "route": WindowSpec(delay=60, window=300, post=60),
    "status": WindowSpec(delay=60, window=300, post=60),
    "session": WindowSpec(delay=120, window=300),
    "uvpv": WindowSpec(delay=1800, window=300),
    "ccu": WindowSpec(delay=1800, window=300, pre=1800),
    "usetime": WindowSpec(delay=1800, window=300),
    "bandwidth": WindowSpec(delay=60, window=300),
    "probe": WindowSpec(delay=60, window=300),
    "web": WindowSpec(delay=60, window=300),
    "tps": WindowSpec(delay=60, window=300),
    "hosts": WindowSpec(delay=180, window=300),
    "dashboard": WindowSpec(delay=60, window=60, pre=300),
}

SLOT_SECONDS = 300  # minutes of a statistics table that one folder holds
ROLLUP_LAG = timedelta(hours=2)


def aligned(window: Window, seconds: int = SLOT_SECONDS) -> bool:
    """Whether a window starts and ends on slot borders.

    A re-run replaces whole folders, so only an aligned window may be written.
    """
    return all(
        t.second == 0 and t.microsecond == 0 and (t.hour * 3600 + t.minute * 60) % seconds == 0
        for t in (window.begin, window.end)
    )


def slot_floor(fire: datetime, seconds: int = SLOT_SECONDS) -> datetime:
    """The slot border at or before a fire time."""
    day = fire.replace(hour=0, minute=0, second=0, microsecond=0)
    passed = int((fire - day).total_seconds())
    return day + timedelta(seconds=passed - passed % seconds)


def at_fire(spec: WindowSpec, fire: datetime, seconds: int = SLOT_SECONDS) -> Window:
    """The newest aligned window whose data is complete at ``fire``."""
    end = slot_floor(fire - timedelta(seconds=spec.delay + spec.post), seconds)
    return spec.between(end - timedelta(seconds=spec.window), end)


def hour_of(fire: datetime) -> tuple[datetime, datetime]:
    """The hour a roll-up at ``fire`` covers."""
    begin = (fire - ROLLUP_LAG).replace(minute=0, second=0, microsecond=0)
    return begin, begin + timedelta(hours=1)


def pieces(spec: WindowSpec, begin: datetime, end: datetime, step: timedelta) -> Iterator[Window]:
    """A long backfill in pieces, each one Spark job over whole partitions."""
    at = begin
    while at < end:
        nxt = min(at + step, end)
        yield spec.between(at, nxt)
        at = nxt
