"""Graphs as edge tables: code graph, reachability, components and hotspots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, prepare
from .modularity import Search
from .skew import look_up


def _merged(links: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, component) of all links, given in one task: trees whose root is their least node."""
    root: dict = {}

    def find(x: object) -> object:
        top = x
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in links:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            root.setdefault(a, a)
            root.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    if nodes := sorted(root):  # columns of no value would have no type
        yield pd.DataFrame({"node": nodes, "component": [find(n) for n in nodes]})


def components(edges: DataFrame, most_rounds: int = 100, few: int = 200_000) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the least node it is linked to.

    At most ``few`` distinct links, which are counted, are merged in one task. More go through alternating stars, with
    the same result: each node's larger neighbours are linked to its least one, then each node with its smaller
    neighbours to the least of them, until nothing changes, after a logarithmic number of rounds. A hub's neighbours are
    combined on the map side; every round is cut by a reliable checkpoint.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else (
            pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        )
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        near = look_up(both.withColumnRenamed("a", "u"), least, "u")
        if large:
            out = near.where("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    edges = edges.select("a", "b").where("a is not null and b is not null")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    state, before = cut(edges.where("a <> b").distinct()), None
    if state.limit(few + 1).count() <= few:
        kind = dict(edges.dtypes)["a"]
        prepare(edges.sparkSession)
        found = state.repartition(1).mapInPandas(_merged, f"node {kind}, component {kind}")
        return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    for _ in range(most_rounds):
        state = cut(star(star(state, large=True), large=False))
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    return nodes.join(state.toDF("__a", "__b"), F.col("node") == F.col("__a"), "left").select(
        "node", F.coalesce("__b", "node").alias("component")
    )


def call_edges(functions: DataFrame) -> DataFrame:
    """(caller, callee): a function to every function of a name that it calls, itself excepted.

    functions: func_key, name, calls array<string>. An equality join on the name replaces comparing all
    pairs; a name called twice gives one edge.
    """
    called = functions.select(F.col("func_key").alias("caller"), F.explode(F.array_distinct("calls")).alias("name"))
    named = functions.select(F.col("func_key").alias("callee"), "name")
    return called.join(named, "name").where("caller <> callee").select("caller", "callee").distinct()


def call_blocks(functions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``calls`` and ``held``, both (node, block): the edges of ``call_edges``, not multiplied out.

    A block is the functions with the same names, of names that are called; a node calls all that its blocks hold, itself
    excepted. A function is held by at most one block, and every row lies on an edge. So both tables grow with the calls and
    the functions, while the edges of a name grow with its callers times its functions.
    """
    rows = cut(functions.select("func_key", "name", "calls").where("func_key is not null"))
    called = rows.select(F.col("func_key").alias("node"), F.explode(F.array_distinct("calls")).alias("name")).distinct()
    named = look_up(rows.select(F.col("func_key").alias("node"), "name"), called.select("name").distinct(), "name")
    sets = named.groupBy("node").agg(F.array_sort(F.collect_set("name")).alias("names"))
    sets = cut(sets.select("node", "names", F.to_json("names").alias("block")))
    by_name = sets.select("block", F.explode("names").alias("name")).groupBy("name").agg(F.collect_set("block").alias("blocks"))
    calls = cut(look_up(called, by_name, "name").select("node", F.explode("blocks").alias("block")).distinct())
    held = sets.select("node", "block")

    def but_own(rows: DataFrame, others: DataFrame) -> DataFrame:
        """The rows whose block has any other node on the other side."""
        only = others.groupBy("block").agg(F.when(F.count(F.lit(1)) == 1, F.min("node")).alias("only"))
        return cut(look_up(rows, only, "block").where("only is null or only <> node").select("node", "block"))

    return but_own(calls, held), but_own(held, calls)


def _as_blocks(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (caller, callee) as ``calls`` and ``held``, with a block for each callee."""
    calls = cut(edges.select(F.col("caller").alias("node"), F.col("callee").alias("block")).where("node <> block").distinct())
    held = calls.select(F.col("block").alias("node"), "block").distinct()
    return calls, held


def _steps(calls: DataFrame, held: DataFrame) -> DataFrame:
    """(node, a, b): a function held by block ``a`` that calls block ``b``."""
    return held.withColumnRenamed("block", "a").join(calls.withColumnRenamed("block", "b"), "node")


def block_components(calls: DataFrame, held: DataFrame) -> DataFrame:
    """(node, component): ``components`` of the edges of ``call_blocks``.

    All nodes of a block, callers and held, are linked, whichever edges are to oneself. So blocks that share a node are linked
    instead of nodes, and each component of blocks is then named after its least node.
    """
    rows = calls.unionByName(held)
    first = cut(rows.groupBy("node").agg(F.min("block").alias("b")))
    of_block = components(rows.join(first, "node").select(F.col("block").alias("a"), "b").distinct())
    parts = cut(look_up(first, of_block.select(F.col("node").alias("b"), F.col("component").alias("part")), "b").select("node", "part"))
    return look_up(parts, parts.groupBy("part").agg(F.min("node").alias("component")), "part").select("node", "component")


#: Endings of file names that a module's name may carry; they are no segment.
_ENDINGS = "jsx?|tsx?|[cm]js|vue|py|rs|go|rb|php|java|cs|cc|cpp|c|hpp|h"


def _pieces(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))


def import_edges(imports: DataFrame, files: DataFrame) -> DataFrame:
    """(file_path, target): an import of two or more segments to every file whose path contains its last segment, the
    importing file included.

    imports: file_path, module (segments joined by ``::``, ``.`` or ``/``); files: file_path. Containment becomes an
    equality join: paths are listed under their pieces of one to three characters, a segment is looked up under the one
    of its pieces that the fewest paths hold, and what meets is checked. Nulls and shorter imports give no edge.
    """
    parts = F.filter(F.split(F.regexp_replace("module", rf"[.](?:{_ENDINGS})$", ""), r"::|[./]"), lambda p: p != "")
    wanted = imports.select("file_path", parts.alias("p")).where(F.size("p") >= 2).select(
        "file_path", F.element_at("p", -1).alias("part")
    ).distinct()
    paths = files.select(F.col("file_path").alias("target")).where("target is not null").distinct()
    held = paths.select("target", F.explode(F.concat(*(_pieces(F.col("target"), n) for n in (1, 2, 3)))).alias("piece"))
    rare = held.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    own = F.coalesce(*(F.nullif(_pieces(F.col("part"), n), F.array().cast("array<string>")) for n in (3, 2, 1)))
    by_piece = wanted.select("part").distinct().select("part", F.explode(own).alias("piece"))
    best = by_piece.join(rare, "piece", "left").groupBy("part").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece"))["piece"].alias("piece")
    )
    met = best.join(held, "piece").where(F.contains("target", F.col("part"))).select("part", "target")
    return wanted.join(met, "part").select("file_path", "target").distinct()


def reach(edges: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(node, depth): what ``start`` (node) reaches along out-edges (caller, callee) in at most ``hops`` steps,
    with the least depth, start nodes at 0."""
    seen = start.select("node").distinct().withColumn("depth", F.lit(0))
    last = seen
    for depth in range(1, hops + 1):
        step = last.join(edges, F.col("node") == F.col("caller")).select(F.col("callee").alias("node")).distinct()
        last = cut(step.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        seen = seen.unionByName(last)
    return seen


def file_dependencies(edges: DataFrame, functions: DataFrame) -> DataFrame:
    """(file_path, calls, called_by): sorted distinct files that a file's functions call, or are called by."""
    of = functions.select("func_key", "file_path")
    pairs = (
        edges.join(of.toDF("caller", "from_file"), "caller").join(of.toDF("callee", "to_file"), "callee")
        .where("from_file <> to_file").select("from_file", "to_file").distinct()
    )
    out = pairs.select(F.col("from_file").alias("file_path"), F.col("to_file").alias("c"), F.lit(None).cast("string").alias("b"))
    back = pairs.select(F.col("to_file").alias("file_path"), F.lit(None).cast("string").alias("c"), F.col("from_file").alias("b"))
    both = out.unionByName(back).groupBy("file_path")
    return both.agg(F.array_sort(F.collect_set("c")).alias("calls"), F.array_sort(F.collect_set("b")).alias("called_by"))


def hotspots(functions: DataFrame, edges: DataFrame, top: int) -> DataFrame:
    """The ``top`` functions by calls plus callers, 5 more for public ones, 3 less for accessors.

    functions also has visibility and is_accessor; ties go by key.
    """
    callers = edges.groupBy(F.col("callee").alias("func_key")).agg(F.count(F.lit(1)).alias("n_callers"))
    score = (
        F.size("calls") + F.coalesce("n_callers", F.lit(0))
        + F.when(F.col("visibility") == "pub", 5).otherwise(0) - F.when(F.col("is_accessor"), 3).otherwise(0)
    )
    scored = functions.join(callers, "func_key", "left").select("func_key", "name", score.cast("bigint").alias("score"))
    return scored.orderBy(F.desc("score"), "func_key").limit(top)


def connected_files(edges: DataFrame, functions: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(file_path): files of what ``start`` (node) reaches in ``hops`` steps, without the start's own files."""
    of = functions.select(F.col("func_key").alias("node"), "file_path")
    found = reach(edges, start, hops).join(of, "node").select("file_path").distinct()
    return found.join(start.join(of, "node").select("file_path").distinct(), "file_path", "left_anti")


# Names of constructors and of what is written without thought.
BOILERPLATE = (
    "new", "default", "from", "into", "clone", "drop", "eq", "partial_eq", "fmt", "display", "debug", "as_ref", "as_mut", "as_ptr", "deref",
    "deref_mut", "to_string", "try_from", "try_into", "build",
)


def targets(functions: DataFrame, least: int = 50, enough: int = 80) -> DataFrame:
    """The functions worth changing: at least ``least`` characters, no accessor, constructor or test, and asynchronous, with a
    call, or of ``enough`` characters. functions: name, body, n_calls."""
    size = F.length("body")
    plain = (F.col("name") != "") & ~F.col("name").rlike("^(?:get_|set_|is_|test_)") & ~F.col("name").isin(*BOILERPLATE)
    return functions.where(plain & (size >= least) & (F.contains("body", F.lit("async")) | (F.col("n_calls") > 0) | (size >= enough)))


def betweenness(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """``block_betweenness`` of edges (caller, callee), which count once."""
    return block_betweenness(*_as_blocks(edges), sources)


def block_betweenness(calls: DataFrame, held: DataFrame, sources: DataFrame) -> DataFrame:
    """(node, score): the share of shortest paths from ``sources`` (node) through each node along the edges of ``call_blocks``,
    summed over pairs and scaled as if every node were a source: exact if all are, else an estimate by sampled sources.

    From a source, all nodes of a block but the source itself are reached in the same step by as many paths. So the search in levels
    goes from block to block, from all sources at once: each level is a join of the last one with the links of blocks, cut by a
    checkpoint, so the state grows with sources times blocks reached, and the rounds with the longest shortest path. Then the
    levels give their dependencies back, from the last to the first. What a source itself calls is on the first level, so as a
    member of a block it adds nothing to a later one. Scores are divided by (n - 1)(n - 2).
    """
    nodes = cut(calls.select("node").union(held.select("node")).distinct())
    start = cut(sources.select("node").distinct().join(nodes, "node", "left_semi"))
    steps = cut(_steps(calls, held))
    links = cut(steps.groupBy("a", "b").agg(F.count(F.lit(1)).alias("w")))
    n_held = held.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    own = held.join(start, "node", "left_semi").select(F.col("node").alias("source"), "block", F.lit(1).alias("own"))
    first = calls.join(start, "node", "left_semi").select(F.col("node").alias("source"), "block", F.lit(1.0).alias("paths"))
    levels, seen = [], None
    level = cut(first)
    while level.limit(1).count():
        levels.append(level)
        seen = level.select("source", "block") if seen is None else seen.unionByName(level.select("source", "block"))
        if len(levels) % 8 == 0:
            seen = cut(seen)
        step = level.join(links, F.col("block") == F.col("a")).groupBy("source", F.col("b").alias("block")).agg(F.sum(F.col("paths") * F.col("w")).alias("paths"))
        level = cut(step.join(seen, ["source", "block"], "left_anti"))
    owed, gains = None, []
    for level in reversed(levels):
        given = level.join(n_held, "block").join(own, ["source", "block"], "left").select(
            "source", "block", ((F.col("n") - F.coalesce("own", F.lit(0))) / F.col("paths")).alias("owed")
        )
        if owed is not None:
            back = level.join(links, F.col("block") == F.col("a")).join(owed.withColumnRenamed("block", "b"), ["source", "b"])
            gains.append(cut(back.groupBy("a", "b").agg(F.sum(F.col("paths") * F.col("owed")).alias("gain"))))
            sums = back.groupBy("source", "block").agg(F.sum(F.col("w") * F.col("owed")).alias("later"))
            given = given.join(sums, ["source", "block"], "left").select("source", "block", (F.col("owed") + F.coalesce("later", F.lit(0.0))).alias("owed"))
        owed = cut(given)
    every = links.select("a", "b", F.lit(0.0).alias("gain"))
    for part in gains:
        every = every.unionByName(part)
    every = cut(every.groupBy(F.struct("a", "b").alias("pair")).agg(F.sum("gain").alias("gain")))
    score = look_up(steps.select("node", F.struct("a", "b").alias("pair")), every, "pair").groupBy("node").agg(F.sum("gain").alias("owed"))
    n, k = nodes.count(), start.count()
    scale = n / k / ((n - 1) * (n - 2)) if k and n > 2 else 0.0
    return nodes.join(score, "node", "left").select("node", (F.coalesce("owed", F.lit(0.0)) * scale).alias("score"))


def _modular(links: pd.DataFrame, total: int) -> list[set]:
    """The communities of ``modularity.Search`` by their definition, from links listed, for tests: every merge compares all pairs."""
    near: dict[str, dict[str, int]] = {}
    for a, b in zip(links["a"], links["b"], strict=True):
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = 1
    members = {n: {n} for n in near}
    degree = {n: len(x) for n, x in near.items()}
    while True:
        loss, a, b = min(((degree[a] * degree[b] - 2 * total * near[a][b], a, b) for a in near for b in near[a] if a < b), default=(0, "", ""))
        if loss >= 0:
            return sorted(members.values(), key=lambda m: (-len(m), min(m)))
        members[a] |= members.pop(b)
        degree[a] += degree.pop(b)
        for c, w in near.pop(b).items():
            near[c].pop(b, None)
            if c != a:
                near[a][c] = near[c][a] = near[a].get(c, 0) + w


def communities(edges: DataFrame, most_nodes: int | None = None) -> DataFrame:
    """``block_communities`` of edges (caller, callee)."""
    return block_communities(*_as_blocks(edges), most_nodes)


def _n_links(calls: DataFrame, held: DataFrame) -> int:
    """The number of pairs that an edge of ``call_blocks`` links in either direction, without listing them: edges, less the pairs
    that have both. ``w`` functions of block a call b, and as many pairs of one of these and one of b's that call a have both;
    those of a that call a are no edge to themselves."""
    a, b = (t.groupBy("block").agg(F.count(F.lit(1)).alias(n)) for t, n in ((calls, "n"), (held, "m")))
    w = cut(_steps(calls, held).groupBy("a", "b").agg(F.count(F.lit(1)).alias("w")))
    back = w.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("w").alias("v"))
    total = lambda t, c: t.agg(F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")).scalar()
    sums = calls.sparkSession.range(1).select(
        total(a.join(b, "block"), F.col("n") * F.col("m")).alias("all"), total(w.join(back, ["a", "b"]), F.col("w") * F.col("v")).alias("both"),
        total(w.where("a = b"), F.col("w")).alias("own"),
    ).first()
    return int(sums["all"] - sums["own"] - (sums["both"] - sums["own"]) / 2)


def block_communities(calls: DataFrame, held: DataFrame, most_nodes: int | None = None) -> DataFrame:
    """(node, community, greedy): the communities of greedy modularity, each named after its least node.

    Edges of ``call_blocks`` count once, in either direction. Merging two components never raises the modularity, so each
    component is searched on its own, with the number of all links, in one task: which merge is next depends on all before it.
    The task holds the component's rows of ``calls`` and ``held``, not its links, whatever its size. A caller may let components of
    more than ``most_nodes`` nodes stay whole (``greedy`` false); none does unless that is given.
    """
    prepare(calls.sparkSession)
    total = _n_links(calls, held)
    of = cut(block_components(calls, held))
    whole = None
    if most_nodes is not None:
        sized = cut(look_up(of, of.groupBy("component").agg(F.count(F.lit(1)).alias("n")), "component"))
        whole = sized.where(F.col("n") > most_nodes).select("node", F.col("component").alias("community"), F.lit(False).alias("greedy"))
        of = sized.where(F.col("n") <= most_nodes).select("node", "component")
    own = calls.withColumn("calls", F.lit(True)).unionByName(held.withColumn("calls", F.lit(False))).join(of, "node")

    def search(part: pd.DataFrame) -> pd.DataFrame:
        found = Search(part[part["calls"]], part[~part["calls"]], total).run()
        return pd.DataFrame([(n, m[0]) for m in found for n in m], columns=["node", "community"])

    found = own.groupBy("component").applyInPandas(search, "node string, community string").withColumn("greedy", F.lit(True))
    return found if whole is None else found.unionByName(whole)
