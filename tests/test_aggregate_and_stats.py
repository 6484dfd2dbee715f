import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregate as A
from tessera.operators import hierarchy as H
from tessera.operators import masks as M
from tessera.operators import selectors as S
from tessera.operators import stats as T


@pytest.mark.parametrize("cells, p", [((1, 9, 11, 3), 0.0027594561852200836), ((0, 5, 4, 1), 0.04761904761904762), ((5, 5, 5, 5), 1.0), ((0, 0, 3, 4), 1.0)])
def test_fisher(spark, cells, p):
    assert T.fisher_two_sided(*cells) == pytest.approx(p, rel=1e-9)
    df = spark.createDataFrame([cells], "a long, b long, c long, d long")
    assert df.select(T.fisher_p("a", "b", "c", "d").alias("p")).first()["p"] == pytest.approx(p, rel=1e-9)


def test_odds_ratio_limits(spark):
    df = spark.createDataFrame([(10, 5, 4, 8), (1, 0, 0, 2), (0, 0, 3, 4)], "a long, b long, c long, d long")
    found = [tuple(r["o"]) for r in df.select(T.odds_ratio("a", "b", "c", "d").alias("o")).collect()]
    assert found[0][0] == pytest.approx(4.0)
    error = math.sqrt(1 / 10 + 1 / 5 + 1 / 4 + 1 / 8)
    assert found[0][1:] == pytest.approx((math.exp(math.log(4) - 1.96 * error), math.exp(math.log(4) + 1.96 * error)))
    assert found[1][0] == math.inf and found[2][0] is None


def test_mantel_haenszel_of_equal_strata(spark):
    rows = [("x", 10, 5, 4, 8), ("x", 20, 10, 8, 16), ("x", 1, 0, 0, 0)]
    r = T.mantel_haenszel(spark.createDataFrame(rows, "g string, a long, b long, c long, d long"), ["g"]).first()
    assert r["strata"] == 2 and r["odds_ratio_mh"] == pytest.approx(4.0) and r["ci_low"] < 4 < r["ci_high"]
    chi2 = sum(a - (a + b) * (a + c) / (a + b + c + d) for _, a, b, c, d in rows[:2]) ** 2 / sum(
        (a + b) * (c + d) * (a + c) * (b + d) / ((a + b + c + d) ** 2 * (a + b + c + d - 1)) for _, a, b, c, d in rows[:2]
    )
    assert r["cmh_chi2"] == pytest.approx(chi2) and r["cmh_p"] == pytest.approx(math.erfc(math.sqrt(chi2 / 2)))


def test_benjamini_hochberg_keeps_nulls_and_ties(spark):
    p = [0.01, 0.04, 0.03, None, 0.04, 0.9, float("nan")]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(p)], "k long, p double")
    found = {r["k"]: r["q"] for r in T.benjamini_hochberg(df, [], "p").collect()}
    ok = sorted(v for v in p if v is not None and not math.isnan(v))
    want = {v: min(min(w * len(ok) / (i + 1) for i, w in enumerate(ok) if w >= v), 1.0) for v in ok}
    for k, v in enumerate(p):
        if v is None or math.isnan(v):
            assert found[k] is None
        else:
            assert found[k] == pytest.approx(want[v])


def test_firth_matches_the_half_count_estimate(spark):
    # with one binary term, Jeffreys' prior adds a half to every cell
    cells = {(1, 1): 9, (1, 0): 3, (0, 1): 4, (0, 0): 11}
    y, x = zip(*(k for k, n in cells.items() for _ in range(n)))
    design = np.column_stack([np.ones(len(x)), x])
    beta, _, ok = T.firth(design, np.array(y, float))
    assert ok and math.exp(beta[1]) == pytest.approx((9.5 * 11.5) / (3.5 * 4.5), rel=1e-5)


def test_firth_by_group_reports_why_not(spark):
    rng = np.random.default_rng(1)
    rows = [("a", int(rng.random() < 0.5), int(rng.random() < 0.5), float(rng.normal())) for _ in range(80)]
    rows += [("b", 1, 0, 1.0), ("b", 1, 1, 2.0), ("c", 0, 1, None)]
    found = {r["g"]: r for r in T.firth_by_group(spark.createDataFrame(rows, "g string, y int, o int, s double"), ["g"], "y", "o", "s").collect()}
    assert found["a"]["status"] == "estimated" and found["a"]["ci_low"] < found["a"]["odds_ratio"] < found["a"]["ci_high"]
    assert found["b"]["status"] == "one label" and found["c"]["status"] == "no rows"


def test_paired_bootstrap_is_deterministic(spark):
    rows = [("g", "f0", "observed", 2.0), ("g", "f0", "control", 0.0), ("g", "f0", "control", 1.0), ("g", "f1", "observed", 4.0), ("g", "f1", "control", 1.0), ("g", "f1", "control", 3.0), ("g", "f2", "observed", 9.0)]
    df = spark.createDataFrame(rows, "g string, focal string, role string, score double")
    a, b = (T.paired_bootstrap(d, ["g"], "focal", "role", "score", 200).first() for d in (df, df.orderBy(F.desc("score"))))
    assert a == b and (a["matched_focals"], a["observed_median"], a["valid_resamples"]) == (2, 3.0, 200)


def test_weighted_quantiles(spark):
    rng = random.Random(2)
    data = [(rng.randrange(40), rng.randrange(1, 6)) for _ in range(500)]
    df = spark.createDataFrame([("g", float(v), w) for v, w in data], "g string, v double, w long")
    full = sorted(v for v, w in data for _ in range(w))
    got = df.groupBy("g").agg(A.quantiles("v", [0.1, 0.5, 0.9], frequency=F.col("w")).alias("q")).first()["q"]
    assert got == pytest.approx(list(np.quantile(full, [0.1, 0.5, 0.9])))
    low = {r["point"]: r["v"] for r in A.lower_quantiles(df, ["g"], "v", "w", [0.1, 0.5, 0.9]).collect()}
    assert low == {p: full[max(0, math.ceil(p * len(full)) - 1)] for p in (0.1, 0.5, 0.9)}


@pytest.mark.parametrize("values", [[1.0], [2.0] * 17, [-2.0, 0.0, 0.0, 1.0, 3.0, 8.0], [float(x) for x in np.random.default_rng(4).normal(size=3000)]])
def test_histogram_edges(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    e = A.fd_edges(df, ["g"], "v", 80).first()
    counts = Counter({r["bin"]: r["rows"] for r in A.histogram(df, ["g"], "v", A.fd_edges(df, ["g"], "v", 80)).collect()})
    edges = np.linspace(e["low"], e["high"], e["bins"] + 1)
    assert sum(counts.values()) == len(values)
    if len(set(values)) > 1:
        own = np.histogram_bin_edges(values, bins="fd")
        assert e["bins"] == min(80, len(own) - 1) or np.quantile(values, 0.75) == np.quantile(values, 0.25)
        assert [counts[k] for k in range(e["bins"])] == list(np.histogram(values, bins=edges)[0])


def test_threshold_curves(spark):
    df = spark.createDataFrame([("s", 1), ("s", 3), ("s", 3), ("s", None)], "g string, score int")
    low = [(r["threshold"], r["retained"], r["total"]) for r in A.threshold_curve(df, ["g"], "score").orderBy("threshold").collect()]
    assert low == [(1, 3, 4), (2, 2, 4), (3, 2, 4), (4, 0, 4)]
    high = [(r["threshold"], r["retained"]) for r in A.threshold_curve(df, ["g"], "score", "max", 0).orderBy("threshold").collect()]
    assert high == [(0, 0), (1, 1), (2, 1), (3, 3), (4, 3)]


def test_contingency_curve_counts_missing_scores_as_failing(spark):
    df = spark.createDataFrame([("s", 1, True), ("s", 2, False), ("s", None, True)], "g string, score int, y boolean")
    found = [tuple(r)[1:] for r in A.contingency_curve(df, ["g"], "score", F.col("y")).orderBy("threshold").collect()]
    assert found == [(2, 0, 1, 2, 0), (3, 0, 0, 2, 1)]


def test_complete_means_precedence_and_grids(spark, rows):
    df = spark.createDataFrame([("a", [1, 2]), ("b", [2, 3])], "k string, at array<long>")
    scores = spark.createDataFrame([(1, 1.0), (2, 3.0)], "pos long, score double")
    assert rows(A.mean_if_complete(df, ["k"], "at", scores, [], "pos", "score")) == [("a", 2.0), ("b", None)]
    s = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("c", "z")], "k string, s string")
    assert rows(A.precedence(s, ["k"], "s", ("y", "x")))[:2] == [("a", "y"), ("b", "y")]
    n = s.groupBy("k").count()
    assert rows(A.on_grid(n, {"k": spark.createDataFrame([("a",), ("q",)], "k string")}, ["count"])) == [("a", 2), ("q", 0)]


def test_masks(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "z"), (4, None)], "k long, m string")
    m = M.membership_mask(df, "k", "m", ("x", "y", "z"))
    assert rows(m) == [(1, 3), (2, 1), (3, 4), (4, 0)]
    h = M.mask_histogram(m)
    assert rows(M.member_counts(h, ("x", "y", "z"))) == [("x", 2, 1), ("y", 1, 0), ("z", 1, 1)]
    assert {(a, b): j for a, b, *_, j in rows(M.pairwise_overlap(h, ("x", "y", "z")))}["x", "y"] == 0.5
    with pytest.raises(ValueError):
        M.member_bit("m", [str(k) for k in range(64)])
    t = spark.createDataFrame([("s1, s2",), ("s2",), ("other",)], "t string").select(M.mask_of_text("t", ("s1", "s2")).alias("m"))
    assert [r["m"] for r in t.collect()] == [3, 2, 0]


def test_hierarchy_against_sets(spark):
    rng = random.Random(11)
    scopes, ranks = {"all": "", "clade": "c1"}, ("genus", "family")
    for _ in range(6):
        taxa = [(t, [f"c{rng.randrange(3)}"], rng.choice(["", "g1", "g2"]), rng.choice(["f1", "f2"])) for t in range(10)]
        members = [(rng.randrange(4), f"o{k}", rng.choice([*range(10), None])) for k in range(40)]
        profiles = spark.createDataFrame(taxa, "taxon long, lineage array<string>, genus string, family string")
        df = spark.createDataFrame(members, "gene long, item string, taxon long")
        found = {tuple(r)[:3]: r["n"] for r in H.distinct_counts(H.member_units(df, profiles, "item", "taxon", "lineage", scopes, ranks), ["gene"]).collect()}
        want = {}
        by = {t: (lineage, g, f) for t, lineage, g, f in taxa}
        for gene, item, t in members:
            if t is None:
                continue
            lineage, g, f = by[t]
            for s, a in scopes.items():
                if not a or a in lineage or a == str(t):
                    for u, v in (("item", item), ("genus", g or ("taxon", t)), ("family", f)):
                        want.setdefault((gene, s, u), set()).add(v)
        assert found == {k: len(v) for k, v in want.items()}


def test_selector_cube_counts_overlaps_once_in_all(spark, rows):
    df = spark.createDataFrame([(1, ["p", "q"]), (2, ["q"]), (3, [])], "k long, groups array<string>")
    out = S.cube_counts(df, {"g": S.with_all(F.col("groups"))}, [F.count("*").alias("n")])
    assert rows(out) == [("all", 3), ("p", 1), ("q", 2)]


def test_ecdf_is_monotone_and_ends_at_one(spark):
    rng = random.Random(1)
    rows = [("g", f, r, rng.random()) for f in range(30) for r in ("observed", "control", "control")]
    out = T.weighted_ecdf(spark.createDataFrame(rows, "g string, focal long, role string, score double"), ["g"], "focal", "role", "score", 21).toPandas()
    for _, part in out.sort_values("k").groupby("role"):
        assert part["fraction"].is_monotonic_increasing and len(part) == 21
    x = out[out["role"] == "observed"].sort_values("k")
    own = np.array([s for _, _, r, s in rows if r == "observed"])
    assert list(x["fraction"]) == pytest.approx([(own <= v + 1e-12).mean() for v in x["x"]])
    assert isinstance(out, pd.DataFrame)


def test_registered_bootstrap_draws_as_often_as_the_operator(spark):
    from tessera.plans import association

    out = association.paired_bootstrap(spark, "/root/testdata/sf0.001").collect()
    assert out and {r["valid_resamples"] for r in out} == {1000}
