import itertools
import unicodedata as ud
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from taskloom.llm import canon

SAME = [
    ("café", "café"), ("a b", "a b"), ("a b", "a　b"), ("fi", "ﬁ"), ("a-b", "a‐b"), ("a-b", "a‑b"),
    ("abc", "a​b­c"), ("ABC1,", "ＡＢＣ１，"), ("second call", "ѕесond cаll"),
    ("A second", "А second"), ("Test", "Τest"), ("ё", "ё"), ("が", "が"), ("é", "e‍́"),
    ("Этот сервер kebopa", "Этот сервер kebоpа"), ("👩‍💻", "👩​‍💻"),
]
OTHER = [
    ("a", "A"), ("1", "l"), ("a.", "a"), ("e", "é"), ("a\nb", "a b"), ("a\r\nb", "a\nb"), ("a–b", "a-b"), ("сор", "cop"), ("“a”", '"a"'),
    ("x²", "x2"), ("①", "1"), ("👩‍💻", "👩💻"), ("…", "..."), ("0", "O"), ("a\tb", "a b"),
]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same_look(a, b):
    assert canon.consistent(a) == canon.consistent(b)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_different_look_or_script(a, b):
    assert canon.consistent(a) != canon.consistent(b)


def test_genuine_scripts_stay():
    for text in ("Этот сервер закрывает запрос", "Αγορά και", "日志的索引重复；"[:7], "naïve Ångström", "حتى"):
        assert canon.consistent(text) == ud.normalize("NFC", text)


def test_rules_are_checked_for_conflicts():
    with pytest.raises(ValueError, match="mapped again"):
        canon._check({"x": "y", "y": "z"})
    with pytest.raises(ValueError, match="two rules"):
        canon._check({"а": "b"})


ALPHABET = "aceopxAMT xyz-.1\n ​‍́еаошЖοΑﬁａé👩💻が"


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=30))
def test_idempotent(text):
    once = canon.consistent(text)
    assert canon.consistent(once) == once


def brute(rows):
    groups = defaultdict(set)
    for i, t in rows:
        if t is not None and canon.consistent(t).strip():
            groups[canon.consistent(t)].add((i, t))
    return {(min(a, b), max(a, b)) for g in groups.values() for (a, x), (b, y) in itertools.combinations(g, 2) if x != y and a != b}


def test_pairs_equal_brute_force(spark):
    texts = [t for pair in SAME + OTHER for t in pair]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(1000 + i, "a b") for i in range(300)] + [(2000, "a b"), (2001, None), (2002, ""), (2003, "​"), (2004, " "), (2005, " ")]
    rows += [(0, texts[0])]  # a repeated row
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, n int, doc_a string")
    got = [tuple(r) for r in canon.look_alike_pairs(table).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert canon.look_alike_pairs(table.limit(0)).collect() == []


def test_text_column(spark):
    rows = [(1, "plain"), (2, None), (3, ""), (4, "cafе́ " * 20_000)]
    got = {r.doc_id: r.text for r in canon.consistent_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: "plain", 2: None, 3: "", 4: "café " * 20_000}


def test_other_alphabets_and_mixtures():
    same = [("раураl", "paypal"), ("ոice one", "nice one"), ("ᎪBC tree", "ABC tree"), ("Ⅳ", "IV"), ("ɡreat", "great"), ("ｶﾞ", "ガ"), ("각", "각")]
    for a, b in same:
        assert canon.consistent(a) == canon.consistent(b)
    for text in ("բարև ոս", "ᎠᎴ ᎠᏂ", "ısı", "μ and λ"):
        assert canon.consistent(text) == text


def test_a_cluster_is_read_whole():
    assert [c.forms[None] for c in canon.clusters("e​́x̣̂👩‍💻a")] == ["é", "x̣̂", "👩‍💻", "a"]
    assert canon.consistent("q̣̂") == canon.consistent("q̣̂")


def test_full_tables_of_states_are_emptied(monkeypatch):
    monkeypatch.setattr(canon, "_MOST_STATES", 50)
    text = "".join(f"{b}{m}" for b in "abcdefg" for m in map(chr, range(0x300, 0x340)))
    canon._written.cache_clear()
    canon._STATES.clear()
    canon._START.ahead.clear()
    assert canon.consistent(text) == ud.normalize("NFC", text) and len(canon._STATES) <= 51


def test_classes(spark):
    rows = [(5, "café"), (3, "café"), (9, "cafe"), (7, None), (8, " "), (4, "")] + [(100 + i, "hot") for i in range(300)]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, class_id int").drop("class_id")
    got = {r.doc_id: r.class_id for r in canon.look_alike_classes(table).collect()}
    assert got == {5: 3, 3: 3, 9: 9} | {100 + i: 100 for i in range(300)}
    assert canon.look_alike_classes(table.limit(0)).collect() == []
