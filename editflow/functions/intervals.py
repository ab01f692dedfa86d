"""Fixed-length intervals, written as in '10 seconds'."""

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def interval_micros(interval: str) -> int:
    count, unit = interval.split()
    return int(count) * _UNIT_MICROS[unit.rstrip("s")]
