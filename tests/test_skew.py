from collections import defaultdict

from taskloom.functions.ranking import rank_within
from taskloom.operators import skew

SCHEMA = "row_id bigint, instance_id string, repo string, patch string, FAIL_TO_PASS array<string>, PASS_TO_PASS array<string>, n_rows int, __k int"


def brute(rows):
    out = defaultdict(lambda: [0, 0, 0, 0, set()])
    for _, inst, repo, patch, f, p, *_ in rows:
        r = out[repo]
        r[0] += 1
        r[1] += len(f or []) + len(p or [])
        r[2] += len(patch or "")
        r[3] += bool(patch)
        if inst is not None:
            r[4].add(inst)
    return {k: (*v[:4], len(v[4])) for k, v in out.items()}


def rows():
    out = []
    for i in range(600):  # one key holds a third, another instance is repeated, keys and lists may be null
        repo = "hot" if i % 3 == 0 else None if i % 7 == 0 else f"r{i % 11}"
        out.append((i, None if i % 13 == 0 else f"i{i % 50}", repo, None if i % 5 == 0 else "" if i % 5 == 1 else "x" * (i % 40),
                    None if i % 4 == 0 else ["a"] * (i % 3), [] if i % 2 else ["b"], 5, 6))
    return out


def test_salted_results_equal_brute_force(spark):
    data = rows()
    got = skew.repo_results(spark.createDataFrame(data, SCHEMA)).collect()
    found = {r.repo: (r.n_rows, r.n_fail_to_pass + r.n_pass_to_pass, r.patch_chars, r.n_patches, r.n_instances) for r in got}
    assert found == brute(data)
    assert len(got) == len(found)


def test_heavy_repos_counts_null_and_repeated_rows(spark):
    data = rows()
    got = {r.repo for r in skew.heavy_repos(spark.createDataFrame(data, SCHEMA)).collect()}
    counts = {k: v[0] for k, v in brute(data).items()}
    assert got == {k for k, n in counts.items() if k is not None and n * 20 > len(data)}
    assert "hot" in got


def test_exactly_five_percent_is_not_heavy(spark):
    data = [(i, "i", "a" if i < 5 else f"b{i}", None, None, None, 0, 0) for i in range(100)]
    assert skew.heavy_repos(spark.createDataFrame(data, SCHEMA)).collect() == []


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert skew.repo_results(empty).collect() == []
    assert skew.heavy_repos(empty).collect() == []


def test_ranks_are_unique_and_complete_in_buckets(spark):
    data = [(None if i % 5 == 0 else i % 3, i % 40) for i in range(900)]  # ties, nulls
    got = rank_within(spark.createDataFrame(data, "k int, v int"), "k", ["v"], bucket_rows=50).collect()
    by = defaultdict(list)
    for r in got:
        by[r.k].append(r["rank"])
    assert {k: sorted(v) for k, v in by.items()} == {k: list(range(len(v))) for k, v in by.items()}
    assert len(got) == len(data)
    assert rank_within(spark.createDataFrame([], "k int, v int"), "k", ["v"]).collect() == []


def test_look_up_of_hot_and_cold_keys(spark):
    from taskloom.operators.skew import look_up

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(900, None)], "id int, k string")
    mapping = spark.createDataFrame([("hot", 1), *((f"k{i}", i) for i in range(0, 300, 6)), ("unused", 5)], "k string, v int")
    got = {(r.id, r.v) for r in look_up(rows, mapping, "k").collect()}
    assert got == {(i, 1) for i in range(300) if i % 3} | {(i, i) for i in range(0, 300, 6)}


def test_salted_join_equals_a_join(spark):
    from taskloom.operators.skew import salted_join

    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 40}") for i in range(400)] + [(900, None)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3), *((f"k{i}", i) for i in range(0, 40, 4))], "k string, v int")
    key = lambda f: sorted((r.id, r.k, r.v) for r in f.collect())
    assert key(salted_join(left, right, "k", ["id"])) == key(left.join(right, "k"))
