import random
from collections import defaultdict
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from taskloom.functions import scalar
from taskloom.operators import aggregates, graph, joins, modularity, windows
from taskloom.plans import texts


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(60):02}", f"n{rng.randrange(60):02}") for _ in range(45)] + [("hub", f"h{i:03}") for i in range(100)]
    edges += [(f"c{i:02}", f"c{i + 1:02}") for i in range(40)] + [("self", "self"), (None, "x")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {n: find(n) for n in list(root)}


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a string, b string")).collect() == []


def test_call_graph(spark):
    rows = [("f1", "a", "x.rs", ["b", "b", "zz"], "pub", False), ("f2", "b", "y.rs", ["c"], "", False), ("f3", "b", "x.rs", ["b"], "", True), ("f4", "c", "z.rs", [], "", False)]
    f = spark.createDataFrame(rows, "func_key string, name string, file_path string, calls array<string>, visibility string, is_accessor boolean")
    e = graph.call_edges(f)
    assert {tuple(r) for r in e.collect()} == {("f1", "f2"), ("f1", "f3"), ("f2", "f4"), ("f3", "f2")}
    start = spark.createDataFrame([("f1",)], "node string")
    assert {tuple(r) for r in graph.reach(e, start, 1).collect()} == {("f1", 0), ("f2", 1), ("f3", 1)}
    assert dict(map(tuple, graph.reach(e, start, 5).collect())) == {"f1": 0, "f2": 1, "f3": 1, "f4": 2}
    deps = {r.file_path: (r.calls, r.called_by) for r in graph.file_dependencies(e, f).collect()}
    assert deps == {"x.rs": (["y.rs"], []), "y.rs": (["z.rs"], ["x.rs"]), "z.rs": ([], ["y.rs"])}
    assert [(r.func_key, r.score) for r in graph.hotspots(f, e, 2).collect()] == [("f1", 8), ("f2", 3)]
    assert {r[0] for r in graph.connected_files(e, f, start, 5).collect()} == {"y.rs", "z.rs"}
    i = spark.createDataFrame([("m.rs", "crate::net::io"), ("m.rs", "io")], "file_path string, module string")
    files = spark.createDataFrame([("src/io.rs",), ("io/x.rs",), ("m.rs",)], "file_path string")
    assert {tuple(r) for r in graph.import_edges(i, files).collect()} == {("m.rs", "src/io.rs"), ("m.rs", "io/x.rs")}


def test_intervals(spark):
    rng = random.Random(2)
    rows = [(g, f"k{i}", s, s + rng.randrange(12)) for g in "ab" for i, s in enumerate(rng.choices(range(120), k=25))]
    t = spark.createDataFrame(rows, "g string, k string, s int, e int")
    want = {(g, *sorted((a, b))) for g, a, s, e in rows for h, b, x, y in rows if g == h and a != b and s <= y and x <= e}
    got = [tuple(r) for r in windows.overlapping_pairs(t, "g", "k", "s", "e", 10).collect()]
    assert set(got) == want and len(got) == len(want)
    points = defaultdict(set)
    for r in windows.merged_intervals(t, "g", "s", "e").collect():
        points[r.g].add((r["first"], r["last"]))
    for g, spans in points.items():
        spans = sorted(spans)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert all(any(x <= s and e <= y for x, y in spans) for h, _, s, e in rows if h == g)
    kept = [tuple(r) for r in windows.disjoint_ranges(t, "g", "k", "s", "e").collect()]
    assert not [(a, b) for a in kept for b in kept if a[0] == b[0] and a[1] < b[1] and a[2] <= b[3] and b[2] <= a[3]]


def test_samples_caps_and_parts(spark):
    rows = spark.range(100).select("id", F.pmod("id", F.lit(7)).alias("k"))
    capped = windows.cap_per_key(rows, "k", 3, 24, ["id"]).collect()
    assert len(capped) == 21 and len({r.id for r in capped}) == 21
    assert {r.id for r in windows.sample(rows, 10, 1, ["id"]).collect()} == {r.id for r in windows.sample(rows.repartition(5), 10, 1, ["id"]).collect()}
    assert len({r.k for r in windows.diverse(rows, "k", 7, 42, ["id"]).collect()}) == 7
    sizes = [r["count"] for r in windows.near_equal_parts(rows, 7, ["id"]).groupBy("part").count().orderBy("part").collect()]
    assert sizes == [15, 15, 14, 14, 14, 14, 14]
    assert windows.near_equal_parts(rows, 200, ["id"]).select("part").distinct().count() == 100
    share = windows.split_by_hash(spark.range(5000), 0.8, 42, ["id"]).where("split = 'train'").count() / 5000
    assert abs(share - 0.8) < 0.03
    chosen = {r[0]: r[1] for r in windows.weighted_choice(spark.range(5000), {"a": 1, "b": 3}, 1, ["id"], "c").groupBy("c").count().collect()}
    assert abs(chosen["b"] / 5000 - 0.75) < 0.03
    combos = [tuple(r.combo) for r in windows.capped_combinations(rows.where("k = 0"), "k", "id", 2, 4).collect()]
    assert combos == [(0, 7), (0, 14), (0, 21), (0, 28)]


def test_windows(spark):
    rows = [("g", 1, "h1", True), ("g", 2, None, True), ("g", 3, "h2", None), ("g", 4, None, True), ("x", 1, None, True)]
    t = spark.createDataFrame(rows, "g string, n int, h string, ok boolean")
    assert [r.c for r in windows.carry_forward(t, "g", "n", F.col("h"), "c").orderBy("g", "n").collect()] == ["h1", "h1", "h2", "h2", None]
    assert [(r.g, r.n) for r in windows.prefix_until(t, "g", ["n"], F.col("ok")).orderBy("g", "n").collect()] == [("g", 1), ("g", 2), ("x", 1)]


@pytest.mark.parametrize(("value", "patterns", "want"), [
    ("a.b.c", None, True), ("a.b.c", [], False), ("a.b.c", ["a.b.c"], True), ("a.b.c", ["a.*"], True), ("a.b.c", ["a?b?c"], True), ("axbxc", ["a.b.c"], False),
    ("a.b.c", ["[ab].b.*"], True), ("a.b.c", ["[!a].b.*"], False), ("a+b", ["a+*"], True), ("aab", ["a+b"], False), (None, ["*"], False), ("a\nb", ["a*"], True),
])
def test_instance_filter(spark, value, patterns, want):
    t = spark.createDataFrame([(value,)], "v string")
    assert t.select(scalar.matches_any(F.col("v"), patterns)).first()[0] is want


def test_identity_grammar(spark):
    ids = ["o__r.c8a816ae.lm_rewrite__ab12cd34", "o__r.c8a816ae.func_pm_op_change__x", "o__r.c.c8a816ae.pr_12"]
    t = spark.createDataFrame([(i,) for i in ids], "i string")
    got = t.select(scalar.bug_type(F.col("i")), scalar.modifier(F.col("i")), scalar.repo_part(F.col("i"))).collect()
    assert [tuple(r) for r in got] == [("lm_rewrite_", "lm_rewrite", "o__r.c8a816ae"), ("func_pm", "func_pm_op_change", "o__r.c8a816ae"), ("pr", "o", "o__r.c.c8a816ae")]


def test_joins(spark):
    a = spark.createDataFrame([("x", 1), ("y", None), ("z", 3)], "k string, v int")
    b = spark.createDataFrame([("y", None), ("z", 4), ("w", 5)], "k string, v int")
    assert {tuple(r) for r in joins.compared(a, b, ["k"], "v").collect()} == {("x", "removed", 1, None), ("z", "modified", 3, 4), ("w", "added", None, 5)}
    assert {r.k for r in joins.todo(a, b, "k").collect()} == {"x"}
    assert joins.unique_union([a, b.where("k = 'w'")], ["k"]).count() == 4
    with pytest.raises(Exception, match="repeated key"):
        joins.unique_union([a, b], ["k"]).collect()
    changed = spark.createDataFrame([("src/a.py",), ("lib/b.py",), ("src/none.py",)], "path string")
    tests = spark.createDataFrame([("tests/test_a.py",), ("lib/tests/other_test.py",), ("src/x_test.py",)], "test_path string")
    got = {tuple(r) for r in joins.test_files_of(changed, tests).collect()}
    assert got == {("src/a.py", "tests/test_a.py", 1), ("lib/b.py", "lib/tests/other_test.py", 2), ("src/none.py", "src/x_test.py", 2)}
    assert {tuple(r) for r in joins.tests_by_suffix(spark.createDataFrame([("a/t.py",)], "path string"), spark.createDataFrame([("b/t.py",), ("c.py",)], "test_path string")).collect()} == {("a/t.py", "b/t.py")}


def test_statistics(spark):
    one = aggregates.spread(spark.createDataFrame([(4,)], "v int"), "v").first()
    assert (one.n, one["mean"], one.std, one["median"]) == (1, 4.0, 0.0, 4.0)
    pairs = spark.createDataFrame([("e", "e"), ("e", "h"), (None, "e"), ("h", "e"), ("m", "e")], "t string, g string")
    assert tuple(aggregates.accuracy(pairs, "t", "g", ("e", "h")).first()) == (4, 0.25, 2)


@pytest.mark.parametrize("seed", range(2))
def test_components_above_the_bound_are_the_same(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(200, i) for i in range(100, 130)] + [(500, 500)]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    one = {r.node: r.component for r in graph.components(table).collect()}
    assert one == {r.node: r.component for r in graph.components(table, few=0).collect()}


def test_import_edges(spark):
    files = ["a/util.js", "b/c.js", "src/payment/service.rs", "src/x.rs", "lib/utility/y.py"]
    imports = [("b/c.js", "./a/util.js"), ("src/x.rs", "crate::payment::service"), ("src/x.rs", "service"), ("src/x.rs", "a::b::x"),
               ("b/c.js", None), ("src/x.rs", "crate::nothing"), ("src/x.rs", "crate::payment::service")]
    f = spark.createDataFrame([(x,) for x in [*files, files[0], None]], "file_path string")
    got = {tuple(r) for r in graph.import_edges(spark.createDataFrame(imports, "file_path string, module string"), f).collect()}
    brute = {(s, t) for s, part in (("b/c.js", "util"), ("src/x.rs", "service"), ("src/x.rs", "x")) for t in files if part in t}
    assert got == brute


@pytest.mark.parametrize("at_once", [1_000_000, 20])
def test_running_values_of_groups_of_any_size(spark, at_once):
    from taskloom.functions.running import running

    rng = random.Random(2)
    data = [(g, n, rng.choice([None, 1, 2, 7]), rng.choice([None, "a", "b"])) for g in ("hot", "cold", None) for n in range(90 if g == "hot" else 15)]
    t = spark.createDataFrame(data, "g string, n int, v int, h string").repartition(3)
    measures = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("last", F.col("h")), "p": ("previous", F.col("h"))}
    got = {(r.g, r.n): (r.s, r.m, r.l, r.p) for r in running(t, "g", ["n"], measures, at_once).collect()}
    want = {}
    for g in ("hot", "cold", None):
        s, m, last, prev = 0, None, None, None
        for _, n, v, h in sorted((x for x in data if x[0] == g), key=lambda x: x[1]):
            s, m, last = s + (v or 0), v if m is None else m if v is None else max(m, v), h or last
            want[(g, n)] = (s, m, last, prev)
            prev = h
    assert got == want


@pytest.mark.parametrize("at_once", [1_000_000, 5])
def test_parts_and_chunks_follow_the_order(spark, at_once):
    rows = spark.range(12).select("id", F.lit("g").alias("g")).repartition(4, "id")
    parts = [r.part for r in windows.near_equal_parts(rows, 5, ["id"], at_once).orderBy("id").collect()]
    assert parts == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4, 5, 5]
    assert [r.chunk for r in windows.chunks(rows, "g", ["id"], 5, at_once).orderBy("id").collect()] == [0] * 5 + [1] * 5 + [2] * 2


def brute_betweenness(edges):
    nodes, out = sorted({x for e in edges for x in e}), defaultdict(float)
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
    for s in nodes:
        depth, paths, order = {s: 0}, defaultdict(int, {s: 1}), [s]
        for v in order:
            for w in near[v]:
                if w not in depth:
                    depth[w] = depth[v] + 1
                    order.append(w)
                if depth[w] == depth[v] + 1:
                    paths[w] += paths[v]
        owed = defaultdict(float)
        for v in reversed(order):
            for w in near[v]:
                if depth[w] == depth[v] + 1:
                    owed[v] += paths[v] / paths[w] * (1 + owed[w])
            if v != s:
                out[v] += owed[v]
    n = len(nodes)
    return {v: out[v] / ((n - 1) * (n - 2)) for v in nodes}


def test_betweenness_equals_brute_force(spark):
    rng = random.Random(3)
    edges = [(f"n{rng.randrange(14):02}", f"n{rng.randrange(14):02}") for _ in range(30)]
    table = spark.createDataFrame([*edges, edges[0]], "caller string, callee string")
    every = spark.createDataFrame([(x,) for x in sorted({x for e in edges for x in e})], "node string")
    got = {r.node: r.score for r in graph.betweenness(table, every).collect()}
    want = brute_betweenness(edges)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_communities(spark):
    clique = lambda names: [(a, b) for a in names for b in names if a < b]
    edges = clique("abcd") + clique("efgh") + [("d", "e")] + [("x", "y"), ("y", "x")]
    table = spark.createDataFrame(edges, "caller string, callee string")
    got = {r.node: (r.community, r.greedy) for r in graph.communities(table).collect()}
    assert got == {n: ("a", True) for n in "abcd"} | {n: ("e", True) for n in "efgh"} | {n: ("x", True) for n in "xy"}
    large = {r.node: (r.community, r.greedy) for r in graph.communities(table, most_nodes=4).collect()}
    assert large["h"] == ("a", False) and large["y"] == ("x", True)


def random_functions(spark, seed):
    """Functions of few names, some with a key or a call repeated, of a null key or name, or that call themselves alone."""
    rng = random.Random(seed)
    rows = [(f"f{i:02}", rng.choice("abcdefgh"), [rng.choice("abcdefghz") for _ in range(rng.randrange(3))]) for i in range(30)]
    rows += [(key, rng.choice("abcdefgh"), [rng.choice("abcdefgh")]) for key, *_ in rows[:6]]
    rows += [("own", "own", ["own"]), (None, "a", ["b"]), ("none", None, ["a", None]), ("p", "p", ["p", "q"]), ("q", "q", []), ("r", "r", ["r"]), ("s", "r", [])]
    rows += [(f"c{i}", f"c{i}", [f"c{i + 1}"]) for i in range(10)]
    return spark.createDataFrame(rows, "func_key string, name string, calls array<string>")


@pytest.mark.parametrize("seed", range(3))
def test_blocks_hold_the_edges(spark, seed):
    f = random_functions(spark, seed)
    calls, held = ([tuple(r) for r in t.collect()] for t in graph.call_blocks(f))
    edges = [(a, b) for a, x in calls for b, y in held if x == y and a != b]
    want = {tuple(r) for r in graph.call_edges(f).collect()}
    assert set(edges) == want and len(edges) == len(want)
    assert {a for a, _ in calls} == {a for a, _ in want} and {b for b, _ in held} == {b for _, b in want}


@pytest.mark.parametrize("seed", range(2))
def test_betweenness_by_blocks_equals_brute_force(spark, seed):
    f = random_functions(spark, seed)
    edges = [tuple(r) for r in graph.call_edges(f).collect()]
    every = spark.createDataFrame([(x,) for x in sorted({x for e in edges for x in e})], "node string")
    got = {r.node: r.score for r in graph.block_betweenness(*graph.call_blocks(f), every).collect()}
    want = brute_betweenness(edges)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.fixture
def many_of_a_name(spark, tmp_path):
    """600 functions ``run`` that call ``stop`` and 600 ``stop`` that call ``run``: 720,000 edges of 1,200 calls."""
    bodies = [f"def a_{x}(v):\n    v.{y}()\n" for x, y in (("run", "stop"), ("stop", "run"))]
    rows = [(i, "\n\n".join(bodies * 20), "source") for i in range(30)]
    spark.createDataFrame(rows, "doc_id bigint, text string, kind string").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def checkpointed(spark):
    """MB in the folder of checkpoints, which this session doesn't clear."""
    path = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return sum(p.stat().st_size for p in path.rglob("part-*")) / 1e6


def test_betweenness_of_many_functions_of_a_name(spark, many_of_a_name):
    before = checkpointed(spark)
    got = [r.score for r in texts.call_betweenness(spark, many_of_a_name).collect()]
    # From each of 16 sources: 600 of the other name in one step, the other 599 of its own in two, by way of any of the 600.
    assert len(got) == 1200 and abs(sum(got) - 16 * 599 * 1200 / 16 / (1199 * 1198)) < 1e-5
    assert checkpointed(spark) - before < 3


@pytest.mark.parametrize("seed", range(2))
def test_components_by_blocks_are_those_of_the_edges(spark, seed):
    f = random_functions(spark, seed)
    want = {tuple(r) for r in graph.components(graph.call_edges(f).toDF("a", "b")).collect()}
    got = [tuple(r) for r in graph.block_components(*graph.call_blocks(f)).collect()]
    assert set(got) == want and len(got) == len(want) and len({c for _, c in got}) > 1


def test_components_of_many_functions_of_a_name(spark, many_of_a_name):
    before = checkpointed(spark)
    assert [tuple(r) for r in texts.call_components(spark, many_of_a_name).collect()] == [("0:0", 1200)]
    assert checkpointed(spark) - before < 3


def test_components_of_links_to_oneself(spark):
    table = spark.createDataFrame([("x", "x"), ("y", "y")], "a string, b string")
    assert {tuple(r) for r in graph.components(table).collect()} == {("x", "x"), ("y", "y")}


@pytest.mark.parametrize("seed", range(2))
def test_communities_by_blocks_are_those_of_the_links(spark, seed):
    f = random_functions(spark, seed)
    links = {tuple(sorted(r)) for r in graph.call_edges(f).collect()}
    of = {r.node: r.component for r in graph.components(spark.createDataFrame(sorted(links), "a string, b string")).collect()}
    want = {}
    for component in set(of.values()):
        part = pd.DataFrame([x for x in sorted(links) if of[x[0]] == component], columns=["a", "b"])
        want |= {n: (min(m), True) for m in graph._modular(part, len(links)) for n in m}
    blocks = graph.call_blocks(f)
    assert graph._n_links(*blocks) == len(links)
    got = [(r.node, (r.community, r.greedy)) for r in graph.block_communities(*blocks).collect()]
    assert dict(got) == want and len(got) == len(want)


def listed(calls, held):
    """The links of blocks, each once, as a frame (a, b)."""
    links = {(min(a, b), max(a, b)) for a, x in calls for b, y in held if x == y and a != b}
    return pd.DataFrame(sorted(links), columns=["a", "b"])


def test_communities_of_components_of_any_size(spark):
    rng = random.Random(5)
    names = [f"n{i}" for i in range(150)]
    rows = [(f"f{i}", rng.choice(names), [rng.choice(names), rng.choice(names)]) for i in range(600)]
    rows += [("small:1", "small", []), ("small:10", "other", ["small"])]
    blocks = graph.call_blocks(spark.createDataFrame(rows, "func_key string, name string, calls array<string>"))
    links = listed(*([tuple(r) for r in t.collect()] for t in blocks))
    want = {n: (min(m), True) for m in graph._modular(links, len(links)) for n in m}
    got = [(r.node, (r.community, r.greedy)) for r in graph.block_communities(*blocks).collect()]
    assert dict(got) == want and len(got) == len(want) > 500 and len(set(want.values())) < 100


@pytest.mark.parametrize("seed", range(40))
def test_search_of_communities_is_the_definition(monkeypatch, seed):
    """Whatever the names, classes, calls of one's own block, rows kept and number of all links, beyond 64 bits of gain too."""
    rng = random.Random(seed)
    size, most = rng.choice([6, 20, 60]), rng.choice([2, 3, 5])
    blocks = rng.choice([1, 3, 8, size])
    keys = [f"{i}{rng.choice(['', ':1', ':10'])}" for i in range(size)]
    calls = sorted({(k, rng.randrange(blocks)) for k in keys for _ in range(rng.randrange(most))})
    held = [(k, rng.randrange(blocks)) for k in keys if rng.random() < 0.8]
    links = listed(calls, held)
    linked = {*links["a"], *links["b"]}
    frames = [pd.DataFrame([x for x in rows if x[0] in linked], columns=["node", "block"]) for rows in (calls, held)]
    total = len(links) + rng.choice([0, 7, 10**6, 10**15])
    monkeypatch.setattr(modularity, "ROW_BYTES", rng.choice([0, 1 << 20]))
    got = modularity.Search(*frames, total).run()
    assert all(m[0] == min(m) for m in got)
    assert sorted(map(sorted, got)) == sorted(map(sorted, graph._modular(links, total)))


def test_communities_by_query_of_many_functions_of_a_name(spark, many_of_a_name):
    before = checkpointed(spark)
    got = texts.call_communities(spark, many_of_a_name).collect()
    # Pairs of a ``run`` and a ``stop`` gain; two such pairs have as many links as by chance.
    assert len(got) == 600 and {(r.greedy, r.n) for r in got} == {(True, 2)}
    assert checkpointed(spark) - before < 3


def test_communities_of_many_functions_of_a_name(spark, many_of_a_name):
    before = checkpointed(spark)
    assert [tuple(r) for r in texts.call_communities(spark, many_of_a_name).collect()] == [("0:0", False, 1200)]
    assert checkpointed(spark) - before < 3
