import random

import pytest

from tessera.operators import intervals as I

SEGMENTS = [("1", "101", 0, 6), ("1", "101", 4, 8), ("1", "102", 5, 10)]


def segments(spark, more=()):
    return spark.createDataFrame([*SEGMENTS, *more], "gene string, ortholog string, start long, end long")


def test_coverage_of_features(spark):
    features = spark.createDataFrame([("1", "exon_1", 0, 10), ("1", "exon_2", 10, 15)], "gene string, feature string, start long, end long")
    found = {r["feature"]: r for r in I.coverage(features, segments(spark), ["gene"], "ortholog", "feature").collect()}
    one = found["exon_1"]
    assert (one["covered"], one["depth_length"], one["items_covering"], one["breadth"]) == (10, 13, 2, 1.0)
    assert one["mean_depth"] == pytest.approx(1.3)
    two = found["exon_2"]
    assert (two["covered"], two["depth_length"], two["items_covering"], two["mean_depth"]) == (0, 0, 0, 0.0)


def test_distinct_depth_at_sites(spark):
    sites = spark.createDataFrame([("1", 4), ("1", 5), ("2", 5)], "gene string, pos long")
    found = I.depth_at(sites, segments(spark, [("1", "103", 0, 10)]), ["gene"], "ortholog", "pos")
    assert {(r["gene"], r["pos"]): r["depth"] for r in found.collect()} == {("1", 4): 2, ("1", 5): 3, ("2", 5): 0}


def test_touching_intervals_merge_and_closed_ones_when_adjacent(spark, rows):
    df = spark.createDataFrame([("a", 0, 5), ("a", 5, 7), ("a", 9, 12), ("b", 1, 2)], "g string, start long, end long")
    assert rows(I.merge(df, ["g"]), "g", "start", "end", "members") == [("a", 0, 7, 2), ("a", 9, 12, 1), ("b", 1, 2, 1)]
    assert rows(I.merge(df, ["g"], closed=True), "g", "start", "end") == [("a", 0, 7), ("a", 9, 12), ("b", 1, 2)]
    assert rows(I.merge(df, ["g"], gap=2), "g", "start", "end") == [("a", 0, 12), ("b", 1, 2)]
    assert rows(I.gaps(df, ["g"]), "g", "start", "end") == [("a", 7, 9)]


def test_random_lines_against_sets(spark):
    rng = random.Random(5)
    data = []
    for k in range(400):
        s = rng.randrange(60)
        data.append((k % 12, k % 5, s, s + rng.randrange(1, 12)))
    df = spark.createDataFrame(data, "g long, item long, start long, end long")
    want = {}
    for g, item, s, e in data:
        for at in range(s, e):
            want.setdefault((g, at), set()).add(item)
    got = {}
    for g, s, e, n in I.distinct_depth(df, ["g"], "item").select("g", "start", "end", "depth").collect():
        for at in range(s, e):
            got[g, at] = n
    assert got == {k: len(v) for k, v in want.items()}
    for closed, gap in ((False, 0), (True, 0), (False, 3)):
        whole, cut = (I.merge(df, ["g"], closed=closed, gap=gap, chunk=c).select("g", "start", "end", "members") for c in (None, 7))
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))
    covered = {r["g"]: r["covered"] for r in I.union_length(df, ["g"]).collect()}
    assert covered == {g: len([1 for (h, _) in want if h == g]) for g in covered}


def test_tied_spans_against_a_sweep(spark, rows):
    """Many equal spans: SQL that sorts them twice may part them from their island, one sort may not."""
    rng = random.Random(3)
    spans = [(g, s, s + 9) for g in range(8) for s in rng.sample(range(300), 12) for _ in range(6)]
    islands = []
    for g, s, e in sorted(spans):
        if islands and islands[-1][0] == g and s <= islands[-1][2]:
            islands[-1][2:] = [e, islands[-1][3] + 1]
        else:
            islands.append([g, s, e, 1])
    want = sorted(map(tuple, islands), key=repr)
    rng.shuffle(spans)
    df = spark.createDataFrame(spans, "g long, start long, end long").repartition(7)
    assert rows(I.merge(df, ["g"]), "g", "start", "end", "members") == want
    closed = I.merge(df.selectExpr("g", "start", "end - 1 AS end"), ["g"], closed=True)
    assert rows(closed, "g", "start", "end", "members") == sorted(((g, s, e - 1, n) for g, s, e, n in want), key=repr)
    between = [(a[0], a[2], b[1]) for a, b in zip(islands, islands[1:]) if a[0] == b[0]]
    assert rows(I.gaps(df, ["g"]), "g", "start", "end") == sorted(between, key=repr)
    lengths = [(g, sum(e - s for h, s, e, _ in want if h == g), 72, 72 * 9) for g in range(8)]
    assert rows(I.union_length(df, ["g"]), "g", "covered", "intervals", "total") == lengths
    points = spark.range(8).selectExpr("id AS g", "explode(sequence(0L, 310L, 5L)) AS pos")
    held = {(g, p): (s, e, n) for g, s, e, n in want for p in range(0, 311, 5) if s <= p < e}
    found = rows(I.contained(points, I.merge(df, ["g"]), ["g"], "pos"), "g", "pos", "start", "end", "members")
    assert found == sorted(((g, p, *held.get((g, p), (None,) * 3)) for g in range(8) for p in range(0, 311, 5)), key=repr)


def test_subtract_against_sets(spark):
    rng = random.Random(7)
    base = [(g, k, s := rng.randrange(50), s + rng.randrange(1, 20)) for g in range(4) for k in range(6)]
    cut = [(g, s := rng.randrange(60), s + rng.randrange(1, 6)) for g in range(3) for _ in range(6)]
    out = I.subtract(spark.createDataFrame(base, "g long, k long, start long, end long"), spark.createDataFrame(cut, "g long, start long, end long"), ["g"])
    got = {}
    for g, k, s, e in out.select("g", "k", "start", "end").collect():
        got.setdefault((g, k), set()).update(range(s, e))
    holes = {g: {at for h, s, e in cut if h == g for at in range(s, e)} for g in range(4)}
    want = {(g, k): set(range(s, e)) - holes[g] for g, k, s, e in base}
    assert got == {k: v for k, v in want.items() if v}


def test_priority_partition_joins_equal_neighbours(spark, rows):
    df = spark.createDataFrame([("g", 0, 10, "intron", 3), ("g", 2, 4, "cds", 1), ("g", 4, 6, "cds", 1), ("g", 3, 8, "utr", 2)], "g string, start long, end long, label string, rank int")
    out = I.priority_partition(df, ["g"], "label", "rank")
    assert rows(out, "start", "end", "label") == [(0, 2, "intron"), (2, 6, "cds"), (6, 8, "utr"), (8, 10, "intron")]


def test_range_join_equals_nested_loop_and_plans_none(spark):
    rng = random.Random(3)
    a = [(i, s := rng.randrange(-50, 500), s + rng.randrange(0, 40)) for i in range(120)]
    b = [(i, s := rng.randrange(-50, 500), s + rng.randrange(0, 40)) for i in range(120)]
    left, right = spark.createDataFrame(a, "i long, s long, e long"), spark.createDataFrame(b, "j long, t long, u long")
    joined = I.range_join(left, right, ("s", "e"), ("t", "u"), 16)
    assert sorted((r["i"], r["j"]) for r in joined.collect()) == sorted((i, j) for i, s, e in a for j, t, u in b if s <= u and t <= e)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    anti = I.range_join(left, right, ("s", "e"), ("t", "u"), 16, how="left_anti")
    assert sorted(r["i"] for r in anti.collect()) == sorted(i for i, s, e in a if not any(s <= u and t <= e for _, t, u in b))


def test_asof_uses_the_last_row_at_or_before(spark, rows):
    left = spark.createDataFrame([("x", 5), ("x", 10), ("x", 30), ("y", 1)], "g string, at long")
    right = spark.createDataFrame([("x", 5, 12, "a"), ("x", 9, 20, "b")], "g string, at long, until long, v string")
    assert rows(I.asof(left, right, ["g"], "at", ["v"]), "g", "at", "v") == [("x", 10, "b"), ("x", 30, "b"), ("x", 5, "a"), ("y", 1, None)]
    found = I.asof(left, right, ["g"], "at", ["v"], until="until", default="other")
    assert rows(found, "at", "v") == [(1, "other"), (10, "b"), (30, "other"), (5, "a")]


def test_exists_in_closed_spans_does_not_multiply_rows(spark, rows):
    points = spark.createDataFrame([("1", 5), ("1", 7), ("2", 5)], "c string, pos long")
    spans = spark.createDataFrame([("1", 1, 5), ("1", 5, 6), ("1", 4, 6)], "c string, start long, end long")
    assert rows(I.exists_in(points, spans, "c", "pos"), "c", "pos", "hit") == [("1", 5, True), ("1", 7, False), ("2", 5, False)]


def test_clusters_and_islands(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 9), ("b", 2)], "g string, at long")
    assert rows(I.gap_clusters(df, ["g"], "at", 2), "g", "at", "cluster") == [("a", 1, 1), ("a", 3, 1), ("a", 9, 2), ("b", 2, 1)]
    tiles = spark.createDataFrame([("a", 0), ("a", 10), ("a", 30), ("a", 10)], "g string, tile long")
    assert rows(I.tile_islands(tiles, ["g"], "tile", 10), "first", "last", "tiles") == [(0, 10, 2), (30, 30, 1)]


def exploded_sites(spark):
    """Sites whose estimate knows the ids only, not the places that an explosion gives them."""
    return spark.range(50).selectExpr("id AS gene", "explode(sequence(0L, 90L, 10L)) AS pos")


def own_segments(spark):
    return spark.range(200).selectExpr("id % 50 AS gene", "id AS ortholog", "id % 7 AS start", "id % 7 + 25 AS end")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_members_at_exploded_sites_are_not_broadcast(spark):
    found = I.members_at(exploded_sites(spark), own_segments(spark), ["gene"], "ortholog", "pos")
    assert "Broadcast" not in plan_of(found)
    want = {(i % 50, p, i) for i in range(200) for p in range(0, 91, 10) if i % 7 <= p < i % 7 + 25}
    got = [(r["gene"], r["pos"], r["ortholog"]) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want


def test_coverage_of_exploded_features_is_not_broadcast(spark):
    features = exploded_sites(spark).selectExpr("gene", "pos AS feature", "pos AS start", "pos + 8 AS end")
    found = I.coverage(features, own_segments(spark), ["gene"], "ortholog", "feature")
    plan = plan_of(found)
    assert "Broadcast" not in plan
    # one join of features with segments, one with the sums; lengths and covered parts come from the same pass
    assert plan.count("SortMergeJoin") == 2


def test_coverage_against_sets(spark):
    rng = random.Random(11)
    features = [(g, f, s, s + rng.choice((0, 1, 9, 40))) for g in range(3) for f in range(12) for s in [rng.randrange(-20, 80)]]
    data = [(rng.randrange(4), rng.randrange(6), s, s + rng.choice((0, 2, 7, 120))) for s in (rng.randrange(-30, 90) for _ in range(60))]
    found = I.coverage(
        spark.createDataFrame(features, "g long, feature long, start long, end long"), spark.createDataFrame(data, "g long, item long, start long, end long"), ["g"], "item", "feature",
    )
    got = {(r["g"], r["feature"]): (r["depth_length"], r["items_covering"], r["covered"]) for r in found.collect()}
    for g, f, s, e in features:
        held = [{i for h, i, a, b in data if h == g and a <= at < b} for at in range(s, e)]
        items = {i for h, i, a, b in data if h == g and a < e and b > s}
        assert got[g, f] == (sum(map(len, held)), len(items), sum(map(bool, held)))
