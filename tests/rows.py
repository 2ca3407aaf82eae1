"""Small event logs for tests."""

from playtrace.schema import EVENT_SCHEMA
from pyspark.sql import types as T

SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("event_id", T.LongType())])
DEFAULTS = {
    "session_id": 1, "index": 0, "elapsed_time": 0, "event_name": "navigate_click", "level": 0, "level_group": "0-4"}


def events(spark, *rows):
    full = []
    for i, row in enumerate(rows):
        row = {**DEFAULTS, "index": i, "event_id": i, **row}
        full.append(tuple(row.get(f.name) for f in SCHEMA.fields))
    return spark.createDataFrame(full, SCHEMA)


def same(left, right):
    """Equal rows, doubles to 9 digits, whatever the order."""
    def key(row):
        return tuple(
            (v is None, round(v, 9) if isinstance(v, float) else str(v)) for v in row)
    assert sorted(left.columns) == sorted(right.columns)
    a = sorted(map(repr, (key(x) for x in left.select(*sorted(left.columns)).collect())))
    b = sorted(map(repr, (key(x) for x in right.select(*sorted(right.columns)).collect())))
    assert a == b
    assert a
