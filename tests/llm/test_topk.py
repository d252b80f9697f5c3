import math
import random

import pytest
from pyspark.sql import functions as F

from almanac.llm import topk


def brute(codes, asked, k):
    ids = {(i, c) for i, c in codes if i is not None and c is not None}
    out = []
    for q, code in {(i, c) for i, c in asked if i is not None and c is not None}:
        near = sorted((bin((code ^ c) & (2**64 - 1)).count("1"), i) for i, c in ids if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def codes_of(n, seed):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(4)]
    out = []
    for i in range(n):
        code = draw.choice(centres)
        for _ in range(draw.randrange(25)):
            code ^= 1 << draw.randrange(64)
        out.append((i, code - 2**64 if code >> 63 else code))
    return out


@pytest.mark.parametrize("segments", [None, 4, 8])
def test_neighbours_equal_brute_force(spark, segments):
    rows = codes_of(150, 1) + [(500 + i, 7) for i in range(40)] + [(None, 3), (9, None), (3, codes_of(150, 1)[3][1])]
    codes = spark.createDataFrame(rows, "id long, code long")
    asked = codes.where("id % 10 = 0")
    got = topk.top_k(codes, asked, 5, segments)
    assert sorted(map(tuple, got.collect())) == brute(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0], 5)


def test_masks_of_a_wide_segment_are_made_by_tasks(spark):
    masks = spark.createDataFrame([(0, -1)], "mask long, top int")
    for radius in range(1, 6):
        masks = topk._wider_masks(masks, 32)
        assert masks.count() == math.comb(32, radius) == masks.select("mask").distinct().count()
    assert masks.where("bit_count(mask) != 5 OR mask < 0 OR mask >= 4294967296").isEmpty()


def test_wide_segments_reach_radius_five(spark):
    draw = random.Random(6)
    rows = [(1, 0)]
    for i in range(2, 12):
        low, high = draw.sample(range(32), 5), draw.sample(range(32, 63), 6)
        rows.append((i, sum(1 << b for b in low + high)))
    codes = spark.createDataFrame(rows, "id long, code long")
    asked = codes.where("id = 1")
    assert sorted(map(tuple, topk.top_k(codes, asked, 3, 2).collect())) == brute(rows, rows[:1], 3)


def test_few_rows_and_none(spark):
    codes = spark.createDataFrame([(1, 5), (2, 6)], "id long, code long")
    assert sorted(map(tuple, topk.top_k(codes, codes, 10, 8).collect())) == [(1, 1, 2, 2), (2, 1, 1, 2)]
    none = codes.where("id > 5")
    assert topk.top_k(none, none, 3).count() == 0
    assert topk.top_k(codes, none, 3, 8).count() == 0


def test_sign_codes(spark):
    rows = [(1, [1.0] * 64), (2, [-1.0] * 63 + [0.0]), (3, [1.0] * 5), (4, None)]
    found = spark.createDataFrame(rows, "id long, v array<float>").select("id", topk.sign_code("v").alias("c"))
    assert sorted(map(tuple, found.collect())) == [(1, -1), (2, 1), (3, None), (4, None)]
    assert found.where(F.col("c").isNotNull()).count() == 2
