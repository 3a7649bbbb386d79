"""Each moment's spans against a search over all of them, with a third of the moments in one bucket."""

import random

from heraldo.operators import spans


def found(spark, moments, held, block=(), **more):
    names = "".join(f"{b} int, " for b in block)
    m, s = spark.createDataFrame(moments, f"{names}m long, at long"), spark.createDataFrame(held, f"{names}s long, a long, b long")
    return sorted(tuple(r) for r in spans.containing(m, s, "m", "s", "at", "a", "b", list(block), 10, **more).collect())


def test_moments_against_all_spans(spark):
    pick = random.Random(3)
    moments = [(i, 500 if i % 3 == 0 else pick.randrange(-2000, 2000)) for i in range(900)]
    held = [(i, a, a + pick.choice([-1, 0, 9, 10, 39, 40, 41, 159, 160, 700])) for i in range(60) for a in [pick.randrange(-2000, 2000)]]
    expected = []
    for m, at in moments:
        around = sorted((a, s) for s, a, b in held if a <= at <= b)
        expected.append((m, around[0][1] if around else None, len(around)))
    assert max(n for *_, n in expected) > 2 and any(n == 0 for *_, n in expected)
    assert found(spark, moments, held) == found(spark, moments, held, most=20) == sorted(expected)


def test_blocks_ends_nulls_and_no_spans(spark):
    moments = [(1, 1, 10), (1, 2, 20), (2, 3, 10), (None, 4, 10), (1, 5, None)]
    held = [(1, 7, 10, 20), (1, 6, 10, 10), (2, 8, 11, 12), (1, 9, None, 50), (None, 10, 0, 99)]
    assert found(spark, moments, held, ["k"]) == [(1, 6, 2), (2, 7, 1), (3, None, 0), (4, None, 0), (5, None, 0)]
    assert found(spark, moments, [], ["k"]) == [(m, None, 0) for m in range(1, 6)]
    assert found(spark, [], held, ["k"]) == []
