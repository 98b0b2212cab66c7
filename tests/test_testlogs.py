import pytest

from taskloom.operators import testlogs

CASES = [
    ('pytest', 'tests/a.py::b PASSED [1%]\ntests/a.py::b FAILED', {'tests/a.py::b': 'FAILED'}),
    ('go', '--- PASS: A (0.1s)\n    --- FAIL: B\n--- SKIP: C\nFAIL github.com/x 0.1s', {'A': 'PASSED', 'B': 'FAILED', 'C': 'SKIPPED', 'github.com/x': 'FAILED'}),
    ('cargo', 'test a::b ... ok\ntest a::c ... FAILED', {'a::b': 'PASSED', 'a::c': 'FAILED'}),
    ('minitest', 'FooTest:\n  test_x:     .: (0.01)\n  test_y:  F: (0.1)\nA#test_z = 0.01 s = .', {'FooTest#test_x': 'PASSED', 'FooTest#test_y': 'FAILED', 'A#test_z': 'PASSED'}),
    ('surefire', '[INFO] a.b -- Time elapsed: 0.1 s\n[ERROR] a.c -- Time elapsed: 0.2 s <<< FAILURE!\nm(k.C)  Time elapsed: 0.1 sec', {'a.b': 'PASSED', 'a.c': 'FAILED', 'k.C.m': 'PASSED'}),
    ('phpunit', 'Conn (D\\CT)\n ✔ works\n ✘ fails\n ↩ skips', {'D\\CT::works': 'PASSED', 'D\\CT::fails': 'FAILED', 'D\\CT::skips': 'SKIPPED'}),
    ('jest', '  ✓ a (5 ms)\n  ✕ b\n  ○ c', {'a': 'PASSED', 'b': 'FAILED', 'c': 'SKIPPED'}),
    ('mocha', '  ✔ a (5ms)\n  1) b', {'a': 'PASSED', 'b': 'FAILED'}),
    ('vitest', '✓ test/foo.test.js (9 tests)\n❯ test/b.js (9 tests | 5 failed) 22ms', {'test/foo.test.js': 'PASSED', 'test/b.js': 'FAILED'}),
    ('karma', 'Executed 3 of 5 SUCCESS\nExecuted 5 of 5 (2 FAILED)', {'karma_unit_test_1': 'PASSED', 'karma_unit_test_2': 'PASSED', 'karma_unit_test_3': 'PASSED', 'karma_unit_test_failed_1': 'FAILED', 'karma_unit_test_failed_2': 'FAILED'}),
    ('jasmine', '4 specs, 1 failure, 1 pending spec', {'jasmine_spec_1': 'PASSED', 'jasmine_spec_2': 'PASSED', 'jasmine_spec_failed_1': 'FAILED', 'jasmine_spec_pending_1': 'SKIPPED'}),
    ('lit', 'FAIL: S :: T (1 of 3)\nExpected Passes: 1\nUnexpected Failures: 2', {'T': 'FAILED', 'lit_pass_1': 'PASSED', 'lit_fail_1': 'FAILED'}),
    ('ctest', ' 1/2 Test #1: a ....   Passed  1 sec\n 2/2 Test #2: b ...***Failed 1\n\nThe following tests FAILED:\n\t  2 - b (Failed)\n', {'a': 'PASSED', 'b': 'FAILED'}),
    ('ctest', '50% tests passed, 1 tests failed out of 2', {'synthetic_pass_0': 'PASSED', 'synthetic_fail_0': 'FAILED'}),
    ('gtest', '[       OK ] A.B (1 ms)\n[  FAILED  ] A.C (2 ms)\n[  PASSED  ] 1 test.\n[  FAILED  ] 1 test, listed below:', {'A.B': 'PASSED', 'A.C': 'FAILED'}),
    ('catch2', '<TestCase name="x"><OverallResult success="true"', {'x': 'PASSED'}),
    ('catch2', 'test cases: 3 | 2 passed | 1 failed', {'test_passed_1': 'PASSED', 'test_passed_2': 'PASSED', 'test_failed_1': 'FAILED'}),
    ('pugixml', 'Test a failed: x\nFAILURE: 1 out of 3 tests failed.', {'a': 'FAILED', 'test_passed_1': 'PASSED', 'test_passed_2': 'PASSED'}),
    ('pugixml', 'Success: 2 tests passed.', {'test_passed_1': 'PASSED', 'test_passed_2': 'PASSED'}),
    ('coost', '> begin test: s\n case a:\n EXPECT_EQ(1) failed', {'s::a': 'PASSED', 's': 'FAILED'}),
    ('kakoune', '\x1b[32mfoo\x1b[0m\n\x1b[31mbar\x1b[0m\n\x1b[33mbaz\x1b[0m', {'foo': 'PASSED', 'bar': 'FAILED', 'baz': 'SKIPPED'}),
    ('boost', 'Entering test case "a"\nEntering test case "b"\nerror: in "b": x', {'a': 'PASSED', 'b': 'PASSED'}),
    ('boost', 'Entering test case "a"\nerror in "b": x', {'a': 'PASSED', 'b': 'FAILED'}),
    ('cppunit', 'FAILURES!!!\nTests run: 3,  Failures: 1', {'test_0': 'PASSED', 'test_1': 'PASSED', 'test_fail_0': 'FAILED'}),
    ('turbo', 'pkg:test: ok\nweb:test: ERROR: x', {'pkg:test': 'PASSED', 'web:test': 'PASSED'}),
    ('unittest_lines', "a (m) ... ok\nb ... skipped 'x'\nFAIL: c (m.C)", {'a (m)': 'PASSED', 'b': 'SKIPPED', 'c (m.C)': 'FAILED'}),
    ('dotnet', 'Passed A.B [1 ms]\nFailed A.C', {'A.B': 'PASSED', 'A.C': 'FAILED'}),
    ('bracket', '[ok]: a (5 ms)\n[err]: b in tests/x.tcl\n[skip]: c', {'a': 'PASSED', 'b': 'FAILED', 'c': 'SKIPPED'}),
    ('qtest', 'PASS   : T::a()\nFAIL!  : T::b() Comp\nSKIP   : T::c() x', {'T::a': 'PASSED', 'T::b()': 'FAILED', 'T::c()': 'SKIPPED'}),
    ('pycdc', '*** a: PASS (3)\n*** b: FAIL (2)', {'a': 'PASSED', 'b': 'FAILED'}),
    ('libsass', 'b/t: Passed: 1, failed: 1.', {'b/t_pass_1': 'PASSED', 'b/t_fail_1': 'FAILED'}),
    ('tippecanoe', 'cmp tests/x/out/a.check.out tests/a\ncmp t/b.check.out x\nmake: *** [t] Error 1', {'a': 'PASSED', 'b': 'FAILED'}),
    ('jakttest', '[ FAIL ] a\n2 passed', {'a': 'FAILED', 'jakt_pass_1': 'PASSED', 'jakt_pass_2': 'PASSED'}),
]


@pytest.mark.parametrize(("parser", "log", "want"), CASES)
def test_parsers(parser, log, want):
    assert testlogs.parse_log(log, parser) == want


@pytest.mark.parametrize("parser", sorted(testlogs.PARSERS))
def test_foreign_logs_give_nothing_and_do_not_fail(parser):
    for log in (None, "", "\n\n", "just a line\nand another"):
        assert testlogs.parse_log(log, parser) == {}


def test_last_write_wins_and_table(spark):
    rows = [(1, "a PASSED\na FAILED\nb SKIPPED", "pytest", 0), (2, None, "pytest", 0), (3, "x", "unknown", 0), (4, "--- PASS: T", "go", 0)]
    logs = spark.createDataFrame(rows, "id int, log string, parser string, test int")
    from pyspark.sql import functions as F

    got = {(r.id, r.test, r.status) for r in testlogs.parse_logs(logs, ["id"], "log", F.col("parser")).collect()}
    assert got == {(1, "a", "FAILED"), (1, "b", "SKIPPED"), (4, "T", "PASSED")}


def test_markers(spark):
    s, e = f"+ : '{testlogs.START}'", f"+ : '{testlogs.END}'"
    rows = [(f"x\n{s}\nbody\n{e}\ny",), ("raw",), (f"{testlogs.NO_OUTPUT[1]} {s} {e}",), (None,)]
    t = spark.createDataFrame(rows, "log string")
    from pyspark.sql import functions as F

    got = t.select(testlogs.has_output(F.col("log")).alias("f"), testlogs.marked_output(F.col("log")).alias("o")).collect()
    assert [tuple(r) for r in got] == [(True, "\nbody\n"), (False, "raw"), (False, None), (False, None)]
    with pytest.raises(Exception, match="wrong order"):
        spark.createDataFrame([(e + s,)], "log string").select(testlogs.marked_output(F.col("log"))).collect()
