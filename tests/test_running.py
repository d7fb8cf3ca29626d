"""Running totals over buckets against a plain loop."""

import random

import pytest

from kpiloom.operators.running import before


@pytest.mark.parametrize("buckets, width", [(1, 4), (3, 4), (11, 4), (40, 3)])
def test_sums_of_earlier_rows(frame, buckets, width):
    rng = random.Random(buckets)
    rows, number = [], 0
    for key in (None, "a", "b", "hot"):
        for _ in range(300 if key == "hot" else rng.randrange(40)):
            rows.append((key, rng.randrange(50), number, rng.choice([None, 0, 1, 7, -2])))
            number += 1
    rng.shuffle(rows)
    # Buckets follow the order column.
    rows = [(key, place, place * buckets // 50, number, value) for key, place, number, value in rows]
    df = frame("key STRING, place INT, bucket INT, number LONG, value LONG", *rows)
    found = before(df, ["key"], "bucket", ["place", "number"], "value", buckets, "earlier", width=width)
    assert found.columns == ["key", "place", "bucket", "number", "value", "earlier"]
    expected = {}
    for key in {row[0] for row in rows}:
        total = 0
        for row in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[3])):
            expected[row[3]] = total
            total += row[4] or 0
    assert {row["number"]: row["earlier"] for row in found.collect()} == expected
