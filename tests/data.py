"""Rows of the shapes that the operators take, from a seeded generator."""

import datetime
import random
import uuid

UTC = datetime.timezone.utc
BASE = datetime.datetime(2024, 3, 1, tzinfo=UTC)

URL = "https://wiki.example.org/change?to=11&from=7"


def irc_line(page, flags, size, url=URL, user="Robin", comment="typo fixed"):
    c = "\u0003"
    return (
        f"{c}14[[{c}07{page}{c}14]]{c}4 {flags}{c}10 {c}02{url}{c} {c}5*{c} "
        f"{c}03{user}{c} {c}5*{c} {size} {c}10{comment}{c}"
    )


def word(rng):
    return "".join(rng.choice("abcXYZ") for _ in range(rng.randrange(0, 8)))


def wire_record(rng):
    """A wire record: any second of the 40 days before BASE, positive sizes, short words."""
    at = BASE - datetime.timedelta(seconds=1 + rng.randrange(40 * 86400))
    return {
        "id": str(uuid.UUID(int=rng.getrandbits(128))),
        "isRobot": rng.random() < 0.5,
        "channel": word(rng),
        "timestamp": at.strftime("%Y-%m-%dT%H:%M:%S.000Z"),
        "flags": word(rng),
        "isUnpatrolled": rng.random() < 0.5,
        "page": word(rng),
        "diffUrl": f"https://{word(rng)}x.example/change?n={rng.randrange(99)}",
        "added": rng.randrange(1, 2**31),
        "deleted": rng.randrange(1, 2**31),
        "comment": word(rng),
        "isNew": rng.random() < 0.5,
        "isMinor": rng.random() < 0.5,
        "delta": rng.randrange(1, 2**31),
        "user": word(rng),
        "namespace": word(rng),
    }


def wire_frame(spark, count, seed=1):
    from editflow.schema import WIRE

    rng = random.Random(seed)
    records = [wire_record(rng) for _ in range(count)]
    rows = [tuple(record[name] for name in WIRE.fieldNames()) for record in records]
    return spark.createDataFrame(rows, WIRE), records


def edit_frame(spark, count, seed=1):
    from editflow.operators.parse import normalize_edits, split_rejects
    from editflow.schema import EDIT_COLUMNS

    good, _ = split_rejects(normalize_edits(wire_frame(spark, count, seed)[0]))
    return good.select(*EDIT_COLUMNS)


def skewed_events(count, seed=3, hot="#en.wikipedia"):
    """(id, seconds, channel): a third in one channel, many at the same second, exact copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        channel = hot if i % 3 == 0 else f"#c{rng.randrange(6)}.wikipedia"
        second = 0 if rng.random() < 0.3 else rng.randrange(0, 86400 * 5)
        rows.append((f"id{i:05d}" if rng.random() < 0.9 else "copy", second, channel))
    return rows


def at(second):
    return BASE + datetime.timedelta(seconds=second)
