import hashlib
import math
import random

import pytest

from venuekit.operators import clusters as Q
from venuekit.operators import selection as S
from venuekit.plans import datasets as D


def digest(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("rows, share", [(1000, 0.1), (1003, 0.1), (9, 0.1), (37, 0.5), (5000, 0.333), (10, 1.0), (10, 0.0)])
def test_exact_share_of_smallest_digests(spark, rows, share):
    df = spark.createDataFrame([(i, i % 7) for i in range(rows)], "id long, x int").repartition(4)
    want = sorted(range(rows), key=digest)[: math.floor(share * rows)]
    got = [r.id for r in S.flag_smallest(df, "id", share=share).collect() if r.is_chosen]
    assert sorted(got) == sorted(want)


def test_exact_number(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    assert {r.k for r in S.sample_exactly(df, "k", n=123).collect()} == set(sorted(range(500), key=digest)[:123])
    assert S.sample_exactly(df, "k", n=9999).count() == 500 and S.sample_exactly(df, "k", n=0).count() == 0
    assert S.sample_exactly(df.where("k < 0"), "k", share=0.5).count() == 0


def test_repeated_keys_and_equal_rows_still_give_the_exact_number(spark):
    rng = random.Random(1)
    data = [(1, "same")] * 400 + [(1, f"v{i}") for i in range(200)] + [(None, "none")] * 100 + [(i, None) for i in range(300)]
    rng.shuffle(data)
    results = []
    for parts in (1, 6):
        flagged = S.flag_smallest(spark.createDataFrame(data, "k long, v string").repartition(parts), "k", share=0.45)
        rows = sorted((tuple(r) for r in flagged.collect()), key=repr)
        assert len(rows) == 1000 and sum(r[2] for r in rows) == 450
        assert sorted((r[:2] for r in rows), key=repr) == sorted(data, key=repr)
        results.append(rows)
    assert results[0] == results[1]


def test_many_equal_rows_are_made_in_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 64)
    df = spark.range(1000).selectExpr("7L as k", "'x' as v")
    rows = S.flag_smallest(df, "k", share=0.3).collect()
    assert len(rows) == 1000 and sum(r.is_chosen for r in rows) == 300


def test_labels_are_flipped_on_exactly_a_tenth(spark):
    df = spark.createDataFrame([(f"b{i}", i % 2, None) for i in range(1005)], "business_id string, success int, other string")
    was = {r.business_id: r.success for r in df.collect()}
    flipped = D.flip_labels_exactly(df)
    assert flipped.columns == df.columns
    now = {r.business_id: r.success for r in flipped.repartition(3).collect()}
    assert sum(was[b] != now[b] for b in was) == 100 and set(was) == set(now)


def cell_of(lat, lon, level):
    x = min(max(math.floor((lon + 180) / 360 * 2**level), 0), 2**level - 1)
    y = min(max(math.floor((lat + 90) / 180 * 2**level), 0), 2**level - 1)
    return sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(level))


PLACES = "business_id long, latitude double, longitude double, stars double, is_open int"


def test_clusters_equal_a_count_by_cell(spark):
    rng = random.Random(3)
    rows = [(i, rng.uniform(-95, 95), rng.uniform(-200, 200), rng.choice([None, 1.0, 4.5]), i % 2) for i in range(300)]
    rows += [(900 + i, 36.1, -115.2, 3.0, 1) for i in range(150)]  # a third in one place
    rows += [(2000, None, 1.0, 1.0, 1), (2001, 1.0, float("nan"), 1.0, 1), (2002, 90.0, 180.0, None, None), (2003, 0.0, 0.0, 2.0, 0)]
    known = [r for r in rows if r[1] is not None and r[2] == r[2]]
    got = {(r.level, r.cell): r for r in Q.map_clusters(spark.createDataFrame(rows, PLACES).repartition(4)).collect()}
    want = {}
    for r in known:
        for level in range(13):
            want.setdefault((level, cell_of(r[1], r[2], level)), []).append(r)
    assert set(got) == set(want)
    for k, members in want.items():
        rated = [m[3] for m in members if m[3] is not None]
        assert (got[k].n, got[k].n_open) == (len(members), sum(m[4] == 1 for m in members))
        assert got[k].center_lat == pytest.approx(sum(m[1] for m in members) / len(members))
        assert got[k].center_lon == pytest.approx(sum(m[2] for m in members) / len(members))
        assert got[k].avg_stars == (pytest.approx(sum(rated) / len(rated)) if rated else None)


def test_levels_add_up(spark):
    rng = random.Random(4)
    rows = [(i, rng.gauss(40, 5), rng.gauss(-100, 9), 3.0, 1) for i in range(500)]
    got = [(r.level, r.cell, r.n) for r in Q.map_clusters(spark.createDataFrame(rows, PLACES), deepest=6).collect()]
    for level in range(6):
        above = {}
        for z, cell, n in got:
            if z == level + 1:
                above[cell >> 2] = above.get(cell >> 2, 0) + n
        assert above == {cell: n for z, cell, n in got if z == level} and sum(above.values()) == 500


def test_no_places(spark):
    assert Q.map_clusters(spark.createDataFrame([], PLACES)).count() == 0
    assert Q.map_clusters(spark.createDataFrame([(1, None, None, 1.0, 1)], PLACES)).count() == 0
