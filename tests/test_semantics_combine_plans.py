import json

import pytest
from pyspark.sql import functions as F

from taskloom.operators import combine, diffs, plans, semantics

BEFORE = "import os\n\ndef f(a):\n    return a + 1\n\n\ndef g():\n    return 2\n"


def patch(before, after, path="src/a.py"):
    return diffs.unified(path, before, after)


@pytest.mark.parametrize(("after", "change", "item", "meaning"), [
    (BEFORE.replace("a + 1", "a - 1"), "modified", "f", "body_change"),
    (BEFORE.replace("def f(a)", "def f(a, b)"), "modified", "f", "signature_change"),
    (BEFORE.replace("def g", "def h"), "removed", "g", "deletion"),
    (BEFORE + "\n\ndef k():\n    return 3\n", "added", "k", "addition"),
])
def test_meaning_of_changes(after, change, item, meaning):
    (row,) = semantics.changes(patch(BEFORE, after).replace("+++ b/src/a.py\n@@ -1,8 +1,8 @@\n", "+++ b/src/a.py\n@@ -1,8 +1,8 @@\n"))
    if change == "modified":
        assert row[5] == change and row[7] in (meaning, "signature_change")
    else:
        assert row[5] in (change, "modified") and row[7] in (meaning, "signature_change")


def test_import_only():
    rows = list(semantics.changes(patch(BEFORE, BEFORE.replace("import os", "import sys"))))
    assert rows[0][9] is True
    assert list(semantics.changes(None)) == []


def test_changed_lines_and_context():
    assert semantics.changed_lines("a\nb\nc", "a\nx\nc") == ([1], [1])
    assert semantics.changed_lines("a", "a\n") == ([0], [0])
    assert semantics.line_context("a\nb\nc\nd\ne\nf", [3]) == "b\nc\nd\ne\nf"
    assert semantics.line_context("a", []) == ""


def test_columns(spark):
    good = patch(BEFORE, BEFORE.replace("a + 1", "a - 1"))
    rows = [(1, good), (2, good.replace("-1,8", "-1,9").replace("-1,7", "-1,9")), (3, "x"), (4, None)]
    t = spark.createDataFrame(rows, "id int, patch string")
    files = F.array(F.lit("src/a.py"))
    got = {r.id: r.p for r in t.select("id", semantics.patch_problem(F.col("patch"), files, files).alias("p")).collect()}
    assert got == {1: None, 2: "hunk counts", 3: "no header", 4: "no header"}
    assert t.where("id = 1").select(semantics.patch_problem(F.col("patch"), F.array(F.lit("b")))).first()[0] == "unknown file"
    report = semantics.change_report(semantics.semantic_changes(t.where("id = 1"), ["id"]), ["id"]).first()
    assert report.n == report.n_modified == 1 and "`f`" in report.report
    code = spark.createDataFrame([("def f():\n    pass",), ("def f(:",), (" ",), ("def f():\n  pass",), (None,)], "c string")
    assert [r[0] for r in code.select(semantics.python_problem(F.col("c"))).collect()] == [None, "syntax error at line 1", "empty", "indentation at line 2", None]
    ok = {"task": "t", "reasoning_selection": "r", "selected_functions": ["f"], "reasoning_update": {"f": "x"}}
    answers = [json.dumps(ok), json.dumps(ok | {"selected_functions": ["f", "g"]}), json.dumps(ok | {"task": " "}), "no json", None]
    t = spark.createDataFrame([(a,) for a in answers], "a string")
    assert [r[0] for r in t.select(semantics.sound_task(F.col("a"))).collect()] == [True, False, False, False, False]
    t = spark.createDataFrame([("Map::new()", ["use std::Map;", "use a::{B, Vec};", "use c::D;"])], "c string, i array<string>")
    assert t.select(semantics.used_imports(F.col("c"), F.col("i"))).first()[0] == ["use std::Map;"]
    t = spark.createDataFrame([("a/t.py::C::test_x[p::q]",), ("a.py::test_y",), ("name only",)], "t string")
    assert [tuple(r[0]) for r in t.select(semantics.test_node(F.col("t"))).collect()] == [("a/t.py", "C", "test_x"), ("a.py", None, "test_y"), ("test.py", None, "name")]
    t = spark.createDataFrame([("bug", ["a", "b"], None)], "x string, l array<string>, n string")
    text = t.select(semantics.render("{x}:\n{l}{n}", {"x": F.col("x"), "l": semantics.bullet_list(F.col("l")), "n": F.col("n")})).first()[0]
    assert text == "bug:\n- a\n- b"
    t = spark.createDataFrame([("src/a.py",), ("x.rs",), ("Makefile",)], "p string")
    assert [r[0] for r in t.select(semantics.language(F.col("p"))).collect()] == ["python", "rust", "general"]
    lines = semantics.changed_line_indices(spark.createDataFrame([(1, "a\nb", None)], "id int, b string, a string"), ["id"], "b", "a").first()
    assert (lines.before_lines, lines.after_lines, lines.before_context) == ([0, 1], [], "a\nb")


def test_test_source():
    source = "class T:\n    def test_a(self):\n        assert 1\n\ndef test_b():\n    assert 2\n"
    assert semantics.test_source(source, "test_a", "T").startswith("def test_a")
    assert semantics.test_source(source, "test_b").startswith("def test_b")
    assert semantics.test_source(source, "test_a") is None and semantics.test_source("def (", "x") is None


def test_joined_texts(spark):
    pulls = spark.createDataFrame([(1, ["7", "5", "9"]), (2, [])], "number int, resolved_issues array<string>")
    issues = spark.createDataFrame([(5, "five", "b5"), (7, "seven", None)], "number int, title string, body string")
    assert [tuple(r) for r in semantics.issue_texts(pulls, issues).collect()] == [(1, "seven\n\nfive\nb5")]
    i = spark.createDataFrame([("a", "pytest"), ("b", "go test")], "instance_id string, cmd string")
    f = spark.createDataFrame([("a", "t/y.py"), ("a", "t/x.py"), ("a", "t/x.py")], "instance_id string, test_path string")
    assert {tuple(r) for r in semantics.test_commands(i, f, F.col("cmd")).collect()} == {("a", "pytest t/x.py t/y.py"), ("b", "go test")}
    functions = spark.createDataFrame([(f"f{n}", "a" if n < 4 else "b", "1\n2\n3") for n in range(6)], "func_key string, file_path string, body string")
    edges = spark.createDataFrame([("f0", "f4"), ("f0", "f5"), ("f0", "f3"), ("f5", "f0")], "caller string, callee string")
    pack = semantics.context_pack(functions, edges, spark.createDataFrame([("f0",)], "func_key string"), 2, 2).collect()
    assert {(r.role, r.related) for r in pack} == {("callee", "f3"), ("callee", "f4"), ("caller", "f5"), ("sibling", "f1"), ("sibling", "f2")}
    assert all(r.body == "1\n2" for r in pack)


SOURCE = "\n".join(f"line {i}" for i in range(60))


def at(*lines):
    text = SOURCE.split("\n")
    for n in lines:
        text[n] = f"changed {n}"
    return patch(SOURCE, "\n".join(text))


def test_merging_patches():
    whole = combine.merged([at(5), at(30), at(50)])
    text = diffs.apply_to(SOURCE, diffs.parse(whole)[0].hunks)
    assert [i for i, x in enumerate(text.split("\n")) if x.startswith("changed")] == [5, 30, 50]
    assert combine.merged([at(5), at(6)]) is None
    assert combine.applied(SOURCE, "src/a.py", [at(5), at(30)]) is not None
    assert combine.merged([]) is None


def test_greedy_combinations_share_no_patch(spark):
    rows = [("g", f"p{n}", at(n), 0) for n in (2, 3, 20, 21, 40, 41)] + [("h", "only", at(3), 0), ("g", "none", None, 0)]
    t = spark.createDataFrame(rows, "folder string, name string, patch string, members int")
    got = combine.combined(t, "folder", 2).collect()
    used = [m for r in got for m in r.members]
    assert len(used) == len(set(used)) == 4 and combine.merged([at(40), at(41)]) is None and {r.folder for r in got} == {"g"}
    for r in got:
        assert diffs.apply_to(SOURCE, diffs.parse(r.patch)[0].hunks)
    assert combine.combined(t, "folder", 2, files=2).collect() == []


def test_large_groups_lose_no_result(spark):
    one = "--- a/{0}\n+++ b/{0}\n@@ -1,1 +1,1 @@\n-a\n+b\n"
    rows = [("g", f"{n:05d}", "diff --git a/f{0} b/f{0}\n".format(n) + one.format(f"f{n}")) for n in range(2100)]
    t = spark.createDataFrame(rows, "folder string, name string, patch string")
    assert combine.combined(t, "folder", 2, most=1050, tries=3).count() == 1050


def test_nothing_in_reach_of_the_search_is_left_out(spark):
    rows = [("g", f"{n:02d}", at(5)) for n in range(12)] + [("g", f"{n}", at(n - 50)) for n in range(70, 78, 2)]
    t = spark.createDataFrame(rows, "folder string, name string, patch string")
    for size, most, tries in ((2, 1, 12), (2, 3, 15), (3, 2, 40), (1, 4, 1), (2, 2, 1)):
        want = combine.greedy([r[1:] for r in rows], size, most, tries)
        got = combine.combined(t, "folder", size, most=most, tries=tries).collect()
        assert [(r.members, r.patch) for r in got] == want


RUST = "fn f(a: i32) -> Result<i32> {\n    if a == 3 {\n        return Err(x);\n    }\n    let b = g(a, c)?;\n    lock_a();\n    lock_b();\n    Ok(b < 10 && a > 2)\n}\n"


@pytest.mark.parametrize(("kind", "fragment", "details", "want"), [
    ("flip_comparison", "a == 3", {}, "a != 3"), ("change_operator", "b < 10", {"operator": "<", "new_operator": ">"}, "b > 10"),
    ("logic_swap", "b < 10 && a > 2", {}, "b < 10 || a > 2"), ("remove_error_handling", "g(a, c)?", {}, "g(a, c);"),
    ("swap_arguments", "g(a, c)", {"argument1": "a", "argument2": "c"}, "g(c, a)"), ("off_by_one", "b < 10", {}, "b <= 10"),
    ("lock_ordering", "", {"statement1": "lock_a();", "statement2": "lock_b();"}, "lock_b();\n    lock_a();"), ("missing_return", "return Err(x);", {}, "//return Err(x);"),
    ("remove_guard", "if a == 3 {", {}, "{\n        return Err(x);\n"), ("type_confusion", "a: i32", {"old_type": "i32", "new_type": "u8"}, "a: u8"),
])
def test_transforms(kind, fragment, details, want):
    out, error = plans.apply_instruction(RUST, kind, fragment, details)
    assert error is None and want in out


def test_plans_table(spark):
    assert len(plans.TRANSFORMS) == 20
    plan = {"strategy": "s", "mutations": [{"type": "flip_comparison", "original_fragment": "a == 3", "mutation_details": {}}, {"type": "nope", "original_fragment": "x"}]}
    t = spark.createDataFrame([(1, json.dumps(plan), RUST), (2, "broken", RUST), (3, None, RUST)], "id int, plan string, src string")
    got = {(r.id, r.position): r for r in plans.apply_plans(t, ["id"], "plan", F.col("src")).collect()}
    assert set(got) == {(1, 0), (1, 1)} and "a != 3" in got[1, 0].code and got[1, 1].error == "unknown transform"


@pytest.mark.parametrize(("text", "lang", "found"), [
    ("async def f(a=(1, 2),\n      b=3) -> int:  # note\n    x\n\n    y\nz", "python", [("function", "f", 0, 0, 1, 4)]),
    ("class A(B):\n    def g(self):\n        pass", "python", [("class", "A", 0, 0, 0, 2), ("function", "g", 4, 1, 1, 2)]),
    ("pub(crate) async fn f<T: A>(\n    a: T,\n) -> T {\n    a\n}\nlet x = 1;", "rust", [("function", "f", 0, 0, 2, 4)]),
    ("impl<T> Foo for Bar {\n}", "rust", [("type", "Foo", 0, 0, 0, 1)]),
    ("func (r *T) Name(x int) error {\n\treturn nil\n}", "go", [("function", "Name", 0, 0, 0, 2)]),
    ("define(x)\n# def f(", "python", []),
])
def test_declared_items(text, lang, found):
    got = semantics.declared(text.split("\n"), lang)
    assert [(x.kind, x.name, x.indent, x.first, x.head, x.last) for x in got] == found


def test_a_touched_signature_decides_the_meaning():
    head = "diff --git a/m.rs b/m.rs\n--- a/m.rs\n+++ b/m.rs\n@@ -1,4 +1,4 @@ fn outer()\n"
    of = lambda body, h=head: [r[4:8] + (r[10],) for r in semantics.changes(h + body)]
    assert of(" fn f(\n-    a: u8,\n+    a: u16,\n ) {\n") == [("function", "modified", "f", "signature_change", True)]
    assert of(" fn f() {\n-    1\n+    2\n }\n") == [("function", "modified", "f", "body_change", False)]
    assert of("-    1\n+    2\n") == [("function", "modified", "outer", "body_change", False)]
    assert of("-) -> u8 {\n+) -> u16 {\n") == [("function", "modified", "outer", "signature_change", True)]
    assert of("+fn g() {\n+}\n") == [("function", "added", "g", "addition", True)]
    assert of("-fn g() {\n+fn h() {\n") == [("function", "removed", "g", "deletion", True)]
    assert of("-x \n+x\n") == []


def test_composites(spark):
    text = "".join(f"line {i}\n" for i in range(60))
    rows = []
    for f in ("a.py", "b.py", "c.py", "d.py"):
        for k in range(4 if f == "b.py" else 2):
            at = 5 + 12 * k
            rows.append(("g", f, f"{f}-{k}", diffs.unified(f, text, text.replace(f"line {at}\n", f"changed {at}\n"))))
    rows += [("small", "a.py", f"s{i}", rows[0][3]) for i in range(5)] + [("g", "a.py", "empty", ""), ("g", "a.py", "none", None)]
    t = spark.createDataFrame(rows, "g string, file string, name string, patch string")
    for level, (size, one) in combine.LEVELS.items():
        got = combine.composites(t, "g", level, 2).collect()
        assert got and len(got) <= 2 and {r.g for r in got} == {"g"}
        used = [m for r in got for m in r.members]
        assert len(used) == len(set(used))
        for r in got:
            files = {m.split("-")[0] for m in r.members}
            assert len(r.members) == size and (files == {"b.py"} if one else len(files) == size)
            assert {d.new_path for d in diffs.parse(r.patch)} == files
    assert combine.composites(t.limit(0), "g", "hard", 2).collect() == []
