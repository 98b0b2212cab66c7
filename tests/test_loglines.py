from datetime import datetime

import pytest

from taskloom.operators import loglines

LINES = [
    ("[2025-09-05 01:34:10] WARNING in template_filter: late", ("2025-09-05 01:34:10.000000", "WARN", "template_filter", "late")),
    ("I0722 14:09:52.224003    3416 suffix_namespace.go:386] x", ("2024-07-22 14:09:52.224003", "INFO", "suffix_namespace.go", "x")),
    ("2025-05-15 04:53:18.526  INFO 4476 --- [main] org.garuva.CallbackClient : m", ("2025-05-15 04:53:18.526000", "INFO", "org.garuva.CallbackClient", "m")),
    ("2025-08-29 14:57:56,163 - target.snapshot - DEBUG - m", ("2025-08-29 14:57:56.163000", "DEBUG", "target.snapshot", "m")),
    ("2025/08/29 14:58:57 edge: m", ("2025-08-29 14:58:57.000000", None, "edge", "m")),
    ("Jan  2 00:16:42 node-7 decoder_locale[3473]: m", ("2024-01-02 00:16:42.000000", None, "decoder_locale", "m")),
    ("2025-06-17T00:25:03.100+05:30 [warning] filter: m", ("2025-06-16 18:55:03.100000", "WARN", "filter", "m")),
    ('time=2025-03-08T15:55:16.017Z level=fatal component=fixture msg="a \\"b\\"" attempt=2', ("2025-03-08 15:55:16.017000", "FATAL", "fixture", 'a "b"')),
    ("[2025-03-20T02:39:02Z TRACE gradient::timezone] m", ("2025-03-20 02:39:02.000000", "TRACE", "gradient::timezone", "m")),
    ('{"level": "ERROR", "time": 1756479803798, "msg": "m", "component": "c-d"}', ("2025-08-29 15:03:23.798000", "ERROR", "c-d", "m")),
    ("CRITICAL validator.timezone:timezone.py:388 m", (None, "FATAL", "validator.timezone", "m")),
    ("\x1b[2m2025-07-18T22:52:02.941591Z\x1b[0m \x1b[35m WARN\x1b[0m node::gateway: m", ("2025-07-18 22:52:02.941591", "WARN", "node::gateway", "m")),
    ('{"timestamp":"2025-08-29T14:59:15.270Z","severity":"trace","pid":5,"target":"kernel","fields":{"message":"m"}}', ("2025-08-29 14:59:15.270000", "TRACE", "kernel", "m")),
]
PLAIN = [
    "    2025-08-29 15:04:13,298 - nebigi - ERROR - quoted", "  ERROR x twice", "E   INFO stream at 14:59:29", "{", '  "level": "INFO"',
    "Traceback (most recent call last):", "ValueError: missing x", "collected 65 items", "thread 'main' panicked at src/a.rs:1:9:",
    '{"a": 1}', '{"level": "INFO"}', '{"level": "INFO", "component": 5', "2025-13-41", "", "ERROR: no such file", "level=info only",
]


@pytest.mark.parametrize(("line", "want"), LINES)
def test_headers(line, want):
    shape = loglines.signature(loglines.plain(line))
    assert loglines.header(loglines.plain(line), loglines.resolve(shape), 2024) == want


@pytest.mark.parametrize("line", PLAIN)
def test_no_headers(line):
    assert list(loglines.entries(line, 2024, None)) == []


def test_entries_span_lines_and_drop_trailing_blanks():
    text = "before\n" + LINES[4][0] + "\r\n  more\r\n\r\nlast\r\n\r\n\n" + LINES[1][0] + "\n\n"
    got = list(loglines.entries(text, 2024, None))
    assert [e[:2] for e in got] == [(2, 5), (8, 8)]
    assert got[0][5] == "m\n  more\n\nlast"


def test_unknown_year_gives_no_time():
    assert next(loglines.entries(LINES[5][0], None, None))[2] is None


def test_table(spark):
    schema = "output_id bigint, output string, captured_at timestamp_ntz, component string, line_start int"
    at = datetime(2024, 5, 1)
    rows = [(1, "\n".join(x for x, _ in LINES), at, "z", 3), (2, None, at, "z", 3), (3, "", at, "z", 3), (4, "no entry\n" * 50_000, at, "z", 3),
            (5, LINES[5][0], None, "z", 3), (5, LINES[5][0], None, "z", 3)]
    got = loglines.log_entries(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(LINES) + 2
    assert {(r.line_start, r.ts, r.level, r.component) for r in got if r.output_id == 1} == {(i, *w[:3]) for i, (_, w) in enumerate(LINES, 1)}
    few = loglines.log_entries(spark.createDataFrame(rows, schema), max_broadcast_rules=1).collect()
    assert sorted(map(str, few)) == sorted(map(str, got))
    assert loglines.log_entries(spark.createDataFrame([], schema)).collect() == []


AT = "2025-01-02 03:04:05.123000"
LONG = [
    ("2025-01-02 03:04:05.123 [pool-1-thread-2] INFO a.b.C - m", (AT, "INFO", "a.b.C", "m")),
    ("2025-01-02 03:04:05.123 [http-nio-8080-exec-1] WARN  a.b.C - m", (AT, "WARN", "a.b.C", "m")),
    ("2025-01-02 03:04:05.123 [main]            INFO       a.b.C - m", (AT, "INFO", "a.b.C", "m")),
    ("2025-01-02 03:04:05.123   INFO    4476 --- [pool-1-thread-2] a.b.C : m", (AT, "INFO", "a.b.C", "m")),
    ("INFO my_mod2.sub3_x4:test_1_2_3.py:12 m", (None, "INFO", "my_mod2.sub3_x4", "m")),
    ("INFO my_mod2.sub3_x4.part5_y6:test_1_2_3_4.py:12 m", (None, "INFO", "my_mod2.sub3_x4.part5_y6", "m")),
    ("ERROR:a1.b2_c3.d4_e5_f6.g7_h8_i9.j1:m", (None, "ERROR", "a1.b2_c3.d4_e5_f6.g7_h8_i9.j1", "m")),
]


@pytest.mark.parametrize(("line", "want"), LONG)
def test_headers_of_any_length(line, want):
    assert loglines.header(line, loglines.resolve(loglines.signature(line)), 2024) == want
    got = list(loglines.entries(f"{LINES[0][0]}\n{line}\nmore", 2024, None))
    assert [e[:2] for e in got] == [(1, 1), (2, 3)]


ZONED = "2025-01-02T04:04:05.123+01:00"
MORE = [
    ("2025-01-02 03:04:05.123 [http-nio-8080-exec-1] INFO com.acme.App - m", (AT, "INFO", "com.acme.App", "m")),
    (f"{ZONED}  INFO 4242 --- [main] a.b.C : m", (AT, "INFO", "a.b.C", "m")),
    (f"{ZONED}  INFO   4242 --- [nio-8080-exec-10]   a.b.C   : m", (AT, "INFO", "a.b.C", "m")),
    ("2025-01-02T03:04:05.123Z  INFO 4242 --- [main] a.b.C : m", (AT, "INFO", "a.b.C", "m")),
    (f"{ZONED} - a.b - DEBUG - m", (AT, "DEBUG", "a.b", "m")),
    (f"{ZONED} [pool 1] WARN  a.b - m", (AT, "WARN", "a.b", "m")),
    (f"[{ZONED}] ERROR in views: m", (AT, "ERROR", "views", "m")),
    (f"[{ZONED} WARN  a::b] m", (AT, "WARN", "a::b", "m")),
    (f"{ZONED} edge: m", (AT, None, "edge", "m")),
    ("[INFO] 2025-01-02 03:04:05,123 a: m", (AT, "INFO", "a", "m")),
    ("[INFO ] [2025-01-02 03:04:05,123] a: m", (AT, "INFO", "a", "m")),
    ("INFO 2025-01-02 03:04:05,123 a.b m", (AT, "INFO", "a.b", "m")),
    ("INFO 2025-01-02 03:04:05,123 a - m", (AT, "INFO", "a", "m")),
    ("2025-01-02 03:04:05,123 INFO [main] a.b.C: m", (AT, "INFO", "a.b.C", "m")),
    ("2025-01-02 03:04:05,123 NOTICE a.b.C m", (AT, "INFO", "a.b.C", "m")),
    ("[2025-01-02 03:04:05,123][WARN ][o.e.n.Node] m", (AT, "WARN", "o.e.n.Node", "m")),
    ("WARN  a_1.b-2:f_3.py:4", (None, "WARN", "a_1.b-2", "")),
]


@pytest.mark.parametrize(("line", "want"), MORE)
def test_zones_paddings_and_more_layouts(line, want):
    assert loglines.header(line, loglines.resolve(loglines.signature(line)), 2024) == want


@pytest.mark.parametrize("line", ["INFO 2025-01-02 03:04:05 started up", "2025-01-02 03:04:05 INFO started up", "[INFO] Building x 1.0", "1 2 3 4", "[1, 2, 3]", "[==] 3 tests ran"])
def test_more_lines_that_are_no_headers(line):
    assert list(loglines.entries(line, 2024, None)) == []
