import random
from collections import defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from taskloom.llm import encode, pack

pytestmark = pytest.mark.skipif(not Path(encode.VOCABULARY).exists(), reason="the vocabulary is not mounted")
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'", "'s", "'re", "ll", "1", "!", "é", "日本", "​", " ", "“", "\r\n", "🚀", "<|endoftext|>", "\x1c", "\x85", "×", "，", "ー", "٣", "½", "e\u0301"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), st.sampled_from([1, 2, 3, 7]))
def test_tree_equals_encoding_at_once(text, size):
    want = encode.encoding(encode.VOCABULARY).encode_ordinary(text)
    assert encode.encode_text(text, size=size) == want
    assert encode.decode_ids(want) == text


@settings(max_examples=100, deadline=None)
@given(*[st.lists(st.sampled_from(PIECES), max_size=12).map("".join)] * 3)
def test_join_is_associative(a, b, c):
    x, y, z = map(encode.leaf, (a, b, c))
    left, right = encode.join(encode.join(x, y), z), encode.join(x, encode.join(y, z))
    assert left == right == encode.leaf(a + b + c)


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 50_000, "\n" * 30_000 + "x", "ab " * 30_000, "é" * 20_000])
def test_long_runs(text):
    assert encode.encode_text(text, size=4096) == encode.encoding(encode.VOCABULARY).encode_ordinary(text)


def test_ids_that_are_no_text_raise():
    ids = encode.encode_text("日本" * 9)
    assert encode.decode_ids(ids, size=1) == "日本" * 9 and encode.decode_ids([]) == ""
    with pytest.raises(UnicodeDecodeError):
        encode.decode_ids(encode.encoding(encode.VOCABULARY).encode_ordinary("\U0001f680")[:1])


def test_every_text_goes_through_the_tree(monkeypatch):
    seen = []
    join = encode.join
    monkeypatch.setattr(encode, "join", lambda a, b, v=encode.VOCABULARY: seen.append(1) or join(a, b, v))
    encode.encode_text("word " * 205)
    assert len(seen) == 2  # leaves of 512, 256 and 257 characters


def test_other_library_agrees():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(encode.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    for text in ("Hello <|endoftext|> wörld 日本\n\n  x", "'s 're it's", "  lead"):
        assert encode.encode_text(text, size=5) == t.encode(text, add_special_tokens=False).ids


def test_documents(spark):
    texts = ["", None, "one two", "<|endoftext|>", "long words, " * 3000, " " * 500, "one two"]
    rows = [(i % 6, t, [0], "x") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, ids array<int>, id string")
    got = sorted((r.doc_id, list(r.ids)) for r in encode.encode_documents(table, spread_chars=4000, leaf_chars=500).collect())
    e = encode.encoding(encode.VOCABULARY)
    assert got == sorted((i, e.encode_ordinary(t or "")) for i, t, *_ in rows)
    assert encode.encode_documents(table.limit(0)).collect() == []


def test_plan_gives_every_item_one_slot_and_fills_well():
    rng = random.Random(1)
    for _ in range(100):
        capacity = rng.choice([5, 16, 64])
        counts = {n: rng.randint(1, 60) for n in range(1, capacity + 1) if rng.random() < 0.6}
        plan = pack.plan_containers(counts, capacity)  # raises if a length has more or fewer slots
        total = sum(k * v for k, v in counts.items())
        large = sum(v for k, v in counts.items() if 2 * k > capacity)
        assert max(-(-total // capacity), large) <= plan.containers <= 11 / 9 * max(-(-total // capacity), large) + 4
    huge = pack.plan_containers({n: 10**9 for n in range(1, 1025)}, 1024)
    assert len(huge.keys) < 40_000
    with pytest.raises(ValueError, match="capacity"):
        pack.plan_containers({6: 1}, 5)


def check(rows, got, capacity):
    e = encode.encoding(encode.VOCABULARY)
    want = defaultdict(int)
    for i, t in rows:
        want[i] += len(e.encode_ordinary(t or ""))
    have, places = defaultdict(int), defaultdict(list)
    for r in got:
        have[r.doc_id] += r.n_tokens
        if r.container is None:
            assert r.n_tokens == 0
        else:
            places[r.container].append((r.place, r.n_tokens))
    assert dict(have) == dict(want)
    for c in places.values():  # no overlap, no gap, nothing over the edge
        at = 0
        for place, n in sorted(c):
            assert place == at
            at += n
        assert at <= capacity
    return len(places), sum(want.values())


def test_packing(spark):
    rng = random.Random(3)
    rows = [(i, " word" * rng.randint(1, 60)) for i in range(500)] + [(i, " word" * 7) for i in range(500, 900)]
    rows += [(900, None), (901, ""), (902, " word" * 333), (903, " word" * 64), (903, " word" * 64)]
    table = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, place int")
    got = pack.pack_documents(table, capacity=64).collect()
    n, total = check(rows, got, 64)
    assert n <= -(-total // 64) + 3
    split = [r for r in got if r.piece > 0]
    assert {r.doc_id for r in split} == {902}
    assert pack.pack_documents(table.limit(0), capacity=64).collect() == []
