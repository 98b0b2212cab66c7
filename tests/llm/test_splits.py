import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from taskloom.llm import splits

NAMES = [
    ("swesynth/kinuho__lunu.c8a816ae", "kinuho/lunu"), ("SweSynth/a__b.core.c8a816ae", "a/b.core"), ("x-y/z__io", "x-y/z__io"),
    ("https://forge.example/Own/re__po.git", "own/re__po"), ("https://forge.example/own/repo/", "own/repo"), ("git@forge.example:own/repo.js.git", "own/repo.js"),
    (" own/repo", "own/repo"), ("own__repo__io", "own/repo__io"), ("mirror/a__b__io.0123abcd", "a/b__io"), ("OWN/Repo.git", "own/repo"),
    ("swesynth/a__b", "a/b"), ("ssh://git@forge.example/own/repo.git", "own/repo"), ("", None), (None, None), ("plain", "plain"),
]
INSTANCES = [
    ("a__b.core.c8a816ae.func_pm_x__p5x6u1y5", "a/b.core"), ("A__b__io.c8a816ae.pr_12", "a/b__io"), ("other", "id:other"), ("", None), (None, None),
]


def test_notations(spark):
    t = spark.createDataFrame([(a,) for a, _ in NAMES], "repo string")
    got = [r[0] for r in t.select(splits.project_of_repo(F.col("repo"), ["swesynth"])).collect()]
    assert got == [b for _, b in NAMES]
    t = spark.createDataFrame([(a,) for a, _ in INSTANCES], "i string")
    assert [r[0] for r in t.select(splits.project_of_instance(F.col("i"))).collect()] == [b for _, b in INSTANCES]


def tables(spark):
    profiles = [("a__b.c8a816ae", "swesynth/a__b.c8a816ae", "a", "b", "old/b"), ("c__d.c8a816ae", "swesynth/c__d.c8a816ae", "c", "d", "a/b"),
                ("e__b.c8a816ae", "swesynth/e__b.c8a816ae", "e", "b", None)]
    p = spark.createDataFrame(profiles, "repo_name string, mirror_name string, owner string, repo string, former_name string")
    repos = ["a/b", "A/B", "old/b", "c__d", "e/b", "swesynth/a__b.c8a816ae", None, None, None, " "]
    ids = [None, "x", "x", "x", "x", "x", "a__b.c8a816ae.pr_1", "zz", None, "e__b.c8a816ae.pr_2"]
    rows = [(i, a, b, "k", 1) for i, (a, b) in enumerate(zip(repos, ids, strict=True))] + [(0, "a/b", None, "k", 1)]
    return rows, spark.createDataFrame(rows, "row_id bigint, repo string, instance_id string, split string, component int"), p


def test_pairs(spark):
    _, t, p = tables(spark)
    got = {tuple(r) for r in splits.same_project_pairs(t, p).collect()}
    one = sorted(["a/b", "A/B", "old/b", "c__d", "swesynth/a__b.c8a816ae"])
    assert got == {(x, y) for i, x in enumerate(one) for y in one[i + 1 :]}
    assert splits.same_project_pairs(t.limit(0), p).collect() == [] == splits.same_project_pairs(t, p.limit(0)).where("repo_a = 'old/b'").collect()


def test_rows_of_a_project_stay_together(spark):
    rows, t, p = tables(spark)
    got = splits.project_splits(t, p).collect()
    assert sorted(r.row_id for r in got) == sorted(r[0] for r in rows)
    by = defaultdict(set)
    for r in got:
        by[r.project].add(r.split)
    assert all(len(s) == 1 for s in by.values())
    of = {r.row_id: r.project for r in got}
    assert of[0] == of[1] == of[2] == of[3] == of[5] == of[6] and of[4] == of[9] != of[0] and of[7] != of[8]
    assert splits.project_splits(t.limit(0), p).collect() == []


def test_proportions_with_a_hot_project(spark):
    rng = random.Random(4)
    repos = ["hot/one"] * 400 + [f"o{int(rng.paretovariate(1)) % 40}/r{rng.randrange(60)}" for _ in range(800)]
    t = spark.createDataFrame([(i, r, None) for i, r in enumerate(repos)], "row_id bigint, repo string, instance_id string")
    p = tables(spark)[2]
    got = Counter(r.split for r in splits.project_splits(t, p).collect())
    assert abs(got["train"] - 960) <= 2 and abs(got["validation"] - 120) <= 2 and abs(got["test"] - 120) <= 2


@pytest.mark.parametrize("bins", [2, 5, 50])
def test_differencing_places_everything(bins):
    rng = random.Random(bins)
    weights = {rng.randint(1, 300): rng.randint(1, 40) for _ in range(40)}
    placed, sums = splits.difference_bins(weights, bins)
    check = [0] * bins
    for w, (each, rest) in placed.items():
        assert each * bins + len(rest) == weights[w]
        for b in range(bins):
            check[b] += w * each
        for b in rest:
            check[b] += w
    assert check == sums and sum(sums) == sum(w * n for w, n in weights.items())
    if bins <= 5:
        assert max(sums) - min(sums) <= 3


def test_no_weights():
    assert splits.plan_splits({}, [0.8, 0.1, 0.1]) == {}


def test_many_mirror_organisations_change_nothing(spark):
    rows, t, p = tables(spark)
    extra = spark.createDataFrame([(f"x{i}/y__z.c8a816ae",) for i in range(1001)], "mirror_name string")
    many = p.unionByName(extra, allowMissingColumns=True)
    more = spark.createDataFrame([(90, "swesynth/a__b", None), (91, "other/a__b", None), (92, "https://h.example/x7/c__d", None)], "row_id bigint, repo string, instance_id string")
    t = t.select("row_id", "repo", "instance_id").unionByName(more)
    pairs = {tuple(r) for r in splits.same_project_pairs(t, many).collect()}
    assert ("a/b", "swesynth/a__b") in pairs and ("a/b", "https://h.example/x7/c__d") in pairs and not any("other/a__b" in x for x in pairs)
    of = {r.row_id: r.project for r in splits.project_splits(t, many).collect()}
    assert of[90] == of[92] == of[0] != of[91]
    names = spark.createDataFrame([(a,) for a, _ in NAMES], "repo string")
    for most in (1000, 0):
        got = splits.with_project(names, p, "n", most).collect()
        assert sorted(map(str, ((r.repo, r.n) for r in got))) == sorted(map(str, NAMES))


def test_memory_of_differencing_is_bounded():
    import tracemalloc

    weights = {w: 199 for w in range(1, 10_001)}
    tracemalloc.start()
    placed, sums = splits.difference_bins(weights, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
    check = [0] * 200
    for w, (each, rest) in placed.items():
        assert each == 0 and len(rest) == 199 == len(set(rest.tolist()))
        for b in rest.tolist():
            check[b] += w
    assert check == sums and max(sums) - min(sums) <= 2


def test_blocks_change_only_the_order_of_differencing():
    weights = {w: w % 7 + 1 for w in range(1, 200)}
    placed, sums = splits.difference_bins(weights, 10, block=16)
    assert all(each * 10 + len(rest) == weights[w] for w, (each, rest) in placed.items())
    assert sum(sums) == sum(w * c for w, c in weights.items()) and max(sums) - min(sums) <= 200
