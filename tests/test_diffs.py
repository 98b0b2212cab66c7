import difflib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from taskloom.operators import diffs

PATCH = """diff --git a/src/a.py b/src/a.py
index 1111111..2222222 100644
--- a/src/a.py
+++ b/src/a.py
@@ -1,3 +1,4 @@ def f
 x = 1
-y = 2
+y = 3
+z = 4
 w = 5
diff --git a/tests/test_a.py b/tests/test_a.py
new file mode 100644
--- /dev/null
+++ b/tests/test_a.py
@@ -0,0 +1 @@
+import a
diff --git a/old.txt b/old.txt
deleted file mode 100644
--- a/old.txt
+++ /dev/null
@@ -1 +0,0 @@
-gone
\\ No newline at end of file
"""


def test_line_numbers():
    rows = list(diffs.line_rows(PATCH))
    assert [(r[8], r[9], r[10], r[11]) for r in rows[:5]] == [
        ("context", 1, 1, "x = 1"), ("removal", 2, None, "y = 2"), ("addition", None, 2, "y = 3"), ("addition", None, 3, "z = 4"), ("context", 3, 4, "w = 5"),
    ]
    assert [(r[1], r[2], r[3]) for r in rows[5:]] == [("tests/test_a.py", True, False), ("old.txt", False, True)]


@pytest.mark.parametrize("text", [None, "", "no header\n+x", "@@ -1 +1 @@\n+x"])
def test_nothing_without_a_file_header(text):
    assert list(diffs.line_rows(text)) == []


def test_inversion_is_an_involution():
    once = diffs.inverted(PATCH)
    assert diffs.inverted(once) == diffs.inverted(diffs.inverted(diffs.inverted(once)))
    assert "new file mode" in once and "deleted file mode" in once
    assert diffs.inverted(diffs.inverted(PATCH)) == diffs.render(diffs.parse(PATCH))


def test_repair_counts_bodies():
    broken = PATCH.replace("-1,3 +1,4", "-1,9 +1,9")
    assert "@@ -1,3 +1,4 @@ def f" in diffs.repaired(broken)


LINES = st.lists(st.sampled_from(["a", "b", "c", "", "x = 1", "def f():"]), max_size=30)


@settings(max_examples=100, deadline=None)
@given(LINES, LINES)
def test_diffs_apply_and_undo(before, after):
    a, b = "\n".join(["head", *before, "tail"]), "\n".join(["head", *after, "tail"])
    patch = diffs.unified("f.py", a, b)
    if patch is None:
        assert a == b
        return
    assert diffs.apply_to(a, diffs.parse(patch)[0].hunks) == b
    assert diffs.apply_to(b, diffs.parse(diffs.inverted(patch))[0].hunks) == a
    assert all(h.counts() == (h.old_lines, h.new_lines) for h in diffs.parse(patch)[0].hunks)


def test_misplaced_hunks_do_not_apply():
    assert diffs.apply_to("other\ntext", diffs.parse(PATCH)[0].hunks) is None


def test_splice():
    assert diffs.spliced("a\nb\nc\n", 2, 2, "x\ny\n", 2) == "a\n  x\n  y\nc\n"
    assert diffs.spliced("a\nb", 2, 3, "x") is None
    assert diffs.spliced("a\nb", 0, 1, "x") is None
    assert diffs.spliced("a\nb", 1, 1, "a") is None


def test_tables(spark):
    rows = [(1, PATCH, "c"), (2, None, "c"), (3, "", "c"), (4, PATCH, "c")]
    t = spark.createDataFrame(rows, "id int, patch string, content string")
    assert diffs.patch_lines(t, ["id"]).count() == 2 * 7
    assert diffs.patch_lines(t.limit(0), ["id"]).collect() == []
    parts = {r.id: (r.fix, r.tests) for r in diffs.split_tests(t, ["id"]).collect()}
    assert "src/a.py" in parts[1][0] and "tests/test_a.py" in parts[1][1] and parts[2] == ("", "")
    from pyspark.sql import functions as F

    pair = spark.createDataFrame([("abcd", "bcde"), (None, "x"), ("same", "same")], "a string, b string")
    got = [r[0] for r in pair.select(diffs.similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [difflib.SequenceMatcher(None, "abcd", "bcde").ratio(), None, 1.0]


ODD = st.lists(st.sampled_from(["a", "b\r", "c\x0cd", "e f", "", "\r", "-x", "+y", " z", "\\ q"]), max_size=12)


@settings(max_examples=150, deadline=None)
@given(ODD, ODD, st.booleans(), st.booleans())
def test_odd_line_ends_survive(before, after, a_ends, b_ends):
    a, b = "\n".join(["head", *before, "tail"]) + "\n" * a_ends, "\n".join(["head", *after, "tail"]) + "\n" * b_ends
    patch = diffs.unified("f.py", a, b)
    if patch is None:
        return
    undo = diffs.inverted(patch)
    assert diffs.apply_to(a, diffs.parse(patch)[0].hunks) == b
    assert diffs.apply_to(b, diffs.parse(undo)[0].hunks) == a
    assert diffs.inverted(undo) == diffs.render(diffs.parse(patch))


def test_carriage_returns_of_structural_lines_stay():
    text = PATCH.replace("\n", "\r\n")
    (first, second, third) = diffs.parse(text)
    assert (first.new_path, second.is_new, third.is_deleted, first.hunks[0].section) == ("src/a.py", True, True, "def f")
    assert diffs.inverted(diffs.inverted(text)) == diffs.render(diffs.parse(text))
    assert diffs.render(diffs.parse(text)).count("\r\n") == text.count("\r\n")
    assert diffs.apply_to("x = 1\r\ny = 2\r\nw = 5\r\n", first.hunks) == "x = 1\r\ny = 3\r\nz = 4\r\nw = 5\r\n"


def test_renames_and_modes_swap():
    text = "diff --git a/x b/y\nold mode 100644\nnew mode 100755\nrename from x\nrename to y\n"
    back = diffs.inverted(text)
    assert back == "diff --git a/y b/x\nold mode 100755\nnew mode 100644\nrename from y\nrename to x\n"
    assert diffs.inverted(back) == text


def test_summaries_and_cosmetic_hunks(spark):
    from pyspark.sql import functions as F

    t = spark.createDataFrame([(1, PATCH), (2, None), (3, ""), (4, PATCH)], "id int, patch string")
    rows = {r.id: r for r in diffs.patch_summaries(t, ["id"]).collect()}
    assert set(rows) == {1, 4} and (rows[1].n_files, rows[1].n_hunks, rows[1].n_added, rows[1].n_removed) == (3, 3, 3, 2)
    assert rows[1].places == ["old.txt:0", "src/a.py:0", "tests/test_a.py:0"] and rows[1].functions == ["def f"]
    assert (rows[1].removed, rows[1].added) == ("y = 2 gone", "y = 3 z = 4 import a")
    cut = t.select(diffs.without_hunks(F.col("patch"), ["@@ -0,0 +1 @@"]).alias("p")).first().p
    assert cut == PATCH[: PATCH.index("@@ -0,0")].rstrip() + "\n"
