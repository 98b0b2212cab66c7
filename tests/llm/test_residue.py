from taskloom.llm import residue
from taskloom.llm.residue_seeds import samples

NOUNS = "matrix template interval builder callback target pattern retry budget resolver charset writer column pointer gateway planner".split()
ADJECTIVES = "stale lazy frozen hidden shared private custom optional nested partial".split()
PROSE = (
    "The documentation says the {a} is {b} yet the {c} reopens it.", "After {n} retries the {b} {a} of the {c} blocks the loop.",
    "We noticed that the {a} twice sorts its {c} if the {a} has {n} entries.", "Only the {b} {a} is affected because the {c} merges it early.",
    "Moving the {a} out of the {c} makes the release {b}.", "Retry logic in the {a} treats {n} Too Many Requests as final.",
    "Our {a} answers {n} Bad Gateway instead of 200 when the {c} times out.", "It should skip such pages.",
    "TODO comments in the {a} are reported as findings by the {c}.", "The placeholder text of the {a} stays visible after the {c} gets focus.",
)
REPORTS = (
    'The sanitizer strips `<noscript>` blocks, so the message "please enable JavaScript" never reaches readers.',
    "The renderer leaves `{{ title }}` in the output when the gauge is stale.", "```\n<h1>404 Not Found</h1>\nLorem ipsum dolor sit amet\n```\nThe writer drops it.",
    "The error page shows \"Something went wrong\" twice because the parser splits the bucket.", "> Please enable JavaScript to continue to this page.\n\nThe crawler stores it.",
)
CASES = (
    "Hi, I am using {{ version }} on linux and the parser is stale.", "# ${TITLE}\n\n## Steps\n[insert steps]\n", "Found in <describe the component>",
    "lorem ipsum dolor sit amet magna vitae sed porta nibh dictum.", "Steps:\ntbd\nExpected:\n...\nActual:\nx", "foo, bar, foo, foo, bar, bar, foo, bar, foo",
    "HTTP 503: Service Unavailable", "Please enable JavaScript in your browser to view this page.", "<noscript>This page requires scripts. Check your settings.</noscript>",
    "Access denied. You do not have permission to view this issue. Sign in to continue.", "Checking your browser before loading the ticket. This requires JS and cookies.",
    '{"error": {"code": 404, "message": "not found", "request": "ab-12"}}', "Write your summary here.",
)


def statements():
    out, n = [], 0
    for i in range(600):
        p = [PROSE[(i + k * 3) % len(PROSE)].format(a=NOUNS[(i * 7 + k) % len(NOUNS)], b=ADJECTIVES[(i + k) % len(ADJECTIVES)],
             c=NOUNS[(i * 3 + k + 1) % len(NOUNS)], n=(i * 13) % 900) for k in range(3)]
        out.append((n, " ".join(p), False))
        n += 1
    for r in REPORTS:
        out.append((n, f"{out[n % 50][1]}\n\n{r}", False))
        n += 1
    for c in CASES:
        out.append((n, c, True))
        out.append((n + 1, f"{out[n % 40][1]}\n\n{c}", True))
        n += 2
    return out


def test_cases_are_found_and_reports_kept(spark):
    rows = statements()
    extra = [(9000, None, False), (9001, "", False), (9002, "  \n", False), (9003, rows[0][1] * 2000, False), (rows[-1][0], rows[-1][1], True)]
    t = spark.createDataFrame([(i, s, "x", 0.5) for i, s, _ in rows + extra], "row_id bigint, problem_statement string, kinds string, coverage double")
    found = residue.residue(t).collect()
    got = {r.row_id for r in found}
    want = {i for i, _, case in rows + extra if case}
    assert not got - want
    assert len(want - got) <= 0.05 * len(want)
    assert sum(r.row_id == rows[-1][0] for r in found) == 2  # every copy
    kept = residue.real_content(t).select("row_id").collect()
    assert len(kept) == len(rows) + len(extra) - len(found)
    assert residue.residue(t.limit(0)).collect() == []


def test_a_hot_case_is_no_prose(spark):
    rows = [(i, s) for i, s, _ in statements()] + [(10_000 + i, CASES[7]) for i in range(400)]
    t = spark.createDataFrame(rows, "row_id bigint, problem_statement string")
    assert residue.residue(t).where("row_id >= 10000").count() == 400


def test_coverage_tells_whole_from_part(spark):
    rows = [(i, s) for i, s, _ in statements()]
    t = spark.createDataFrame(rows, "row_id bigint, problem_statement string")
    cover = {r.row_id: r.coverage for r in residue.residue(t).collect()}
    whole = [i for i, s in rows if s == CASES[7]]
    part = [i for i, s in rows if s.endswith(CASES[7]) and s != CASES[7]]
    assert cover[whole[0]] > 0.9 and cover[part[0]] < 0.5


def test_masks_keep_offsets_of_plain_text():
    assert residue.masked('say "no" and `x`') == "say \x1a and \x1a"
    assert residue.masked('{"a": "b"}') == '{"a": "b"}'
    assert len(residue.letters("İx9")) == 3
    for text in ("Ab 12_xYZ {{ a }}", "Äb 12_жYZ «a»"):
        assert len(residue.shape(text)) == len(residue.shape_places(text))


def test_the_labelled_sample_is_bounded():
    for name in ("slot", "worded", "filler", "notice"):
        assert 0 < len(samples(name, 24)) <= 4000
        assert samples(name, 4) == samples(name, 4)


def test_residue_that_many_different_statements_share_is_no_prose(spark):
    plain = [(i, s) for i, s, case in statements() if not case and i % 3]
    heads = [(i, f"## Description\n\n{s}" if i % 2 else s) for i, s in plain]
    shared = (lambda i: "Version: {{version}}", lambda i: CASES[7], lambda i: f"The {NOUNS[i % 16]} is at {{{{version}}}} since {NOUNS[i % 7]} {ADJECTIVES[i % 9]}.")
    for line in shared:
        rows = heads + [(i, f"{s}\n\n{line(i)}") for i, s, case in statements() if not case and i % 3 == 0]
        t = spark.createDataFrame(rows, "row_id bigint, problem_statement string")
        assert {r.row_id for r in residue.residue(t).collect()} == {i for i, _ in rows if i % 3 == 0}


def test_an_error_text_that_quotes_is_a_case(spark):
    rows = statements() + [(8000, 'The requested page "/issues/12" was not found on this server.', True), (8001, "The `page` option of the server was not found by the lazy builder.", False)]
    t = spark.createDataFrame([(i, s) for i, s, _ in rows], "row_id bigint, problem_statement string")
    got = {r.row_id for r in residue.residue(t).collect()}
    assert 8000 in got and not got & {i for i, _, case in rows if not case}


# Phrases in nobody's words but their own: none is an expansion of a labelled phrase.
HELD_OUT = (
    "You don't have access to this repository. Request access from its owner.", "Hmm, this page doesn't seem to exist.",
    "Please turn JavaScript on and reload the page.", "JavaScript must be enabled in order to use this site.",
    "Your request has been blocked by our security rules.", "503 Service Temporarily Unavailable",
    "We are checking that your connection is secure.", "I am unable to generate that content.", "Description goes here.",
    "<insert summary of the bug>", "{{ summary }}", "Some text some text some text some text",
    "You need to log in before you can view this page.", "An internal server error has occurred, please retry later.",
    "Content blocked because scripts are disabled.", "Write your report below this line.",
)
HELD_OUT_REPORTS = (
    "The parser drops the last token when the input ends with a comment.", "After upgrading, calling connect() twice raises a timeout in the pool.",
    "The login page shows a blank screen when cookies are disabled.", "Our docs say JavaScript is optional, but the menu breaks without it.",
    "The 404 page should use the same layout as the others.", "I cannot complete the build on Windows since version 2.",
    "The template engine leaves `{{name}}` untouched when the variable is null.", "Please add an option to skip the browser check in tests.",
    "The server returns 503 when the pool is empty; it should queue instead.", "Retry logic treats 429 as final.",
)


def test_held_out_phrases(spark, data):
    from taskloom.llm.residue import Models, Settings, prose_counts

    expansions = {x.strip().lower() for kind in ("filler", "notice", "worded") for x in samples(kind, 24)}
    assert not expansions & {x.lower() for x in HELD_OUT}
    t = spark.read.parquet(data.replace("sf0.001", "sf0.01") + "/task_instances.parquet")
    models = Models(*prose_counts(t, "problem_statement", Settings()), Settings())
    assert sum(bool(models.spans(x)) for x in HELD_OUT) >= 0.85 * len(HELD_OUT)
    assert not [x for x in HELD_OUT_REPORTS if models.spans(x)]
