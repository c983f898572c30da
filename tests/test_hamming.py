"""The Hamming join: all pairs, blocks by entropy, tiles of full keys."""

import numpy as np
import pytest

from tracklake.operators import dedupe

SCHEMA = "idx long, h long, mirror long"


def skewed(n: int, seed: int) -> list[tuple[int, int, int | None]]:
    """Codes whose upper 40 bits are nearly always the same, with copies, near copies and mirror codes."""
    rng = np.random.RandomState(seed)
    rows = []
    for i in range(n):
        kind = rng.randint(10)
        h = (0x5A5A5A5A5A << 24) | int(rng.randint(1 << 24)) if kind < 8 or not rows else int(rows[rng.randint(len(rows))][1])
        for bit in rng.randint(0, 63, rng.randint(0, 4)) if kind == 8 else ():
            h ^= 1 << int(bit)
        mirror = None if rng.rand() < 0.3 else int(rows[rng.randint(len(rows))][1]) ^ 3 if rows and rng.rand() < 0.05 else h ^ ((1 << 63) - 1)
        rows.append((i, h, mirror))
    return rows


def brute(rows, threshold: int) -> list[tuple[int, int, int]]:
    h = np.array([r[1] for r in rows])
    m = np.array([r[1] if r[2] is None else r[2] for r in rows])
    d = np.minimum(np.bitwise_count(h[:, None] ^ h), np.bitwise_count(m[:, None] ^ h))
    return [(int(i), int(j), int(d[i, j])) for i, j in zip(*np.nonzero(np.triu(d <= threshold, 1)), strict=True)]


def test_pairs_equal_brute_force_with_and_without_tiles(spark, monkeypatch):
    rows = skewed(700, 1)
    hashes = spark.createDataFrame([*rows, *rows[:20], (900, None, 5), (None, rows[0][1], None)], SCHEMA)
    want = brute(rows, 4)
    assert len(want) > 100
    assert sorted(map(tuple, dedupe.hamming_pairs(hashes, 4).collect())) == want
    _, classes = dedupe._classes(hashes)
    whole = sorted(map(tuple, dedupe.candidates(classes, 4, 6).collect()))
    tiled = dedupe.candidates(classes, 4, 6, tile=40)
    assert "across" in tiled._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, tiled.collect())) == whole
    monkeypatch.setattr(dedupe.candidates, "__defaults__", (None, 40))
    assert sorted(map(tuple, dedupe.hamming_pairs(hashes, 4, 6).collect())) == want


def test_blocks_by_entropy_bound_the_candidates(spark):
    rows = skewed(2000, 2)
    found = brute([(i, h, None) for i, h, _ in rows], 4)
    _, classes = dedupe._classes(spark.createDataFrame([(i, h, None) for i, h, _ in rows], SCHEMA))
    shares = [float(np.mean([h >> i & 1 for h in {r[1] for r in rows}])) for i in range(64)]
    masks = dedupe.bit_blocks([dedupe._entropy(s) for s in shares], 7)
    assert sum(masks) == (1 << 64) - 1 and all(not a & b for k, a in enumerate(masks) for b in masks[:k])
    loads = [sum(dedupe._entropy(shares[i]) for i in range(64) if mask >> i & 1) for mask in masks]
    assert max(loads) - min(loads) <= 1.01
    by_entropy = dedupe.candidates(classes, 4, 7).select("a", "b").distinct().count()
    cuts = [64 * k // 7 for k in range(8)]
    by_place = [sum(1 << i for i in range(cuts[k], cuts[k + 1])) for k in range(7)]
    keys = dedupe.block_keys(by_place, 4)
    met = classes.select("low", keys("h").alias("key")).withColumnRenamed("low", "a").join(classes.select("low", keys("h").alias("key")).withColumnRenamed("low", "b"), "key")
    in_place = met.where("a <> b").select("a", "b").distinct().count()
    print("pairs", len(found), "candidates by entropy", by_entropy, "by place", in_place)
    assert by_entropy < in_place / 20


def test_keys_are_not_broadcast(spark):
    # on 256,410 documents the broadcast of 84 keys a class did not fit into a driver of 750 MB
    _, classes = dedupe._classes(spark.createDataFrame(skewed(300, 3), SCHEMA))
    for met in (dedupe.candidates(classes, 4, 6), dedupe.candidates(classes, 4, 6, tile=40)):
        joins = [line for line in met._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [key" in line and "Inner" in line]
        assert len(joins) == 1 and "SortMergeJoin" in joins[0]


def test_cross_source_pairs_of_many_keys(spark):
    rows = [(i, h, None) for i, h, _ in skewed(300, 4)]
    manifest = spark.createDataFrame([(i, "ab"[i % 2]) for i, *_ in rows], "idx long, source string")
    found = dedupe.cross_source(dedupe.hamming_pairs(spark.createDataFrame(rows, SCHEMA), 4), manifest)
    assert not [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin [key" in line]
    want = [(i, j) for i, j, _ in brute(rows, 4) if (i + j) % 2]
    assert [(r.i, r.j) for r in found.collect()] == want[:300] and want


def test_cross_source_pairs_broadcast_no_table_that_grows(spark):
    rows = [(i, h, None) for i, h, _ in skewed(300, 5)]
    manifest = spark.createDataFrame([(i, "ab"[i % 2]) for i, *_ in rows], "idx long, source string")
    found = dedupe.cross_source(dedupe.hamming_pairs(spark.createDataFrame(rows, SCHEMA), 4), manifest)
    want = [(i, j) for i, j, _ in brute(rows, 4) if (i + j) % 2]
    assert [(r.i, r.j) for r in found.collect()] == want[:300] and want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_few_codes_and_none(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert dedupe.hamming_pairs(none).count() == 0 and dedupe.hamming_edges(none).count() == 0
    one = spark.createDataFrame([(1, -1, None), (2, -1, -1), (3, 0, -1)], SCHEMA)
    assert sorted(map(tuple, dedupe.hamming_pairs(one).collect())) == [(1, 2, 0)]
    with pytest.raises(ValueError, match="blocks"):
        dedupe.hamming_pairs(one, 6, 6)
