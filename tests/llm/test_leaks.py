import random

import numpy as np
import pytest

from taskloom.llm import leaks

VOCABULARY = [f"w{i}" for i in range(400)]


def text(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def brute(docs, items, k=15):
    windows = {}
    for name, *texts in items:
        for t in texts:
            w = leaks.words(t)
            for i in range(len(w) - k + 1):
                windows.setdefault(tuple(w[i : i + k]), set()).add(name)
    out = set()
    for key, t in docs:
        w = leaks.words(t)
        for i in range(len(w) - k + 1):
            out |= {(key, n) for n in windows.get(tuple(w[i : i + k]), ())}
    return out


def tables(spark, seed=1):
    rng = random.Random(seed)
    items = [(f"i{n}", " ".join(text(rng, 40)), "+".join(text(rng, 30))) for n in range(20)]
    items += [("twin", items[0][1], None), ("short", "only three words", ""), ("none", None, None), ("i0", items[0][1], items[0][2])]
    docs = []
    for n in range(200):
        w = text(rng, 60)
        if n % 4 == 0:  # a passage in another layout, case and script, long enough or one word short
            p = leaks.words(items[n % 20][1])[5 : 5 + (15 if n % 8 else 14)]
            p = [x.upper() if n % 3 else x for x in p]
            w[10:10] = ["\n> " + " _*​ ".join(p) + "\n"]
        docs.append((n, " ".join(w)))
    docs += [(300, None), (301, ""), (302, "x " * 100_000), (0, docs[0][1])]
    d = spark.createDataFrame([(i, t, "a") for i, t in docs], "doc_id bigint, text string, instance_id string")
    e = spark.createDataFrame(items, "instance_id string, problem_statement string, patch string")
    return docs, items, d, e


def test_pairs_equal_brute_force(spark):
    docs, items, d, e = tables(spark)
    got = [tuple(r) for r in leaks.leaked_pairs(d, e).collect()]
    assert set(got) == brute(docs, items) and len(got) == len(set(got)) > 20
    assert any(n == "twin" for _, n in got)
    assert leaks.leaked_pairs(d.limit(0), e).collect() == [] == leaks.leaked_pairs(d, e.limit(0)).collect()


def test_shuffled_way_gives_the_same(spark):
    docs, items, d, e = tables(spark)
    small = leaks.leaked_items(d.where("doc_id < 60"), e)
    for filter_bytes in (64 << 20, 1 << 16):
        joined = leaks.leaked_items(d.where("doc_id < 60"), e, max_index_bytes=0, max_filter_bytes=filter_bytes)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, joined.collect()))


def test_items_shorter_than_a_window_are_windows_of_their_size(spark):
    docs = [(1, "we saw that the green kettle sings at noon, as ever"), (2, "the green kettle hums at noon"), (3, "green kettle"), (4, "x y z u v w")]
    items = [("six", "The green kettle sings at noon", None), ("two", "green kettle", None), ("five", "x y z u v", "")]
    d = spark.createDataFrame(docs, "doc_id int, text string")
    e = spark.createDataFrame(items, "instance_id string, problem_statement string, patch string")
    for limit in (256 << 20, 0):
        got = {tuple(r) for r in leaks.leaked_items(d, e, shortest=5, max_index_bytes=limit).collect()}
        assert {r for r in got if r[2] == 0} == {(1, "six", 0, 1), (4, "five", 0, 1)}
        assert {r[:2] for r in got} <= {(1, "six"), (2, "six"), (4, "five")}
    assert leaks.leaked_items(d, e).collect() == []


@pytest.mark.parametrize(("window", "edits", "sampled"), [(15, 1, 12), (15, 2, 8), (40, 3, 10), (8, 1, 6)])
def test_recall_on_real_passages_with_planted_edits(data, window, edits, sampled):
    """Held-out texts of the test tables with random word edits, against the exact distance of the windows."""
    import pandas as pd

    rng = random.Random(window * edits)
    texts = [leaks.words(t) for t in pd.read_parquet(f"{data}/eval_instances.parquet")["problem_statement"].dropna()]
    texts = [t for t in texts if len(t) >= window + 6]
    walks = leaks.Walks(window=window, edits=edits, sampled=sampled)
    index = leaks.Index(walks, [(str(i), [leaks.word_codes(t)]) for i, t in enumerate(texts)])
    true = hit = 0
    for _ in range(1200):
        i = rng.randrange(len(texts))
        at = rng.randrange(len(texts[i]) - window - edits)
        changed = texts[i][at : at + window + edits]
        for _ in range(edits):
            k, kind = rng.randrange(1, window - 1), rng.randrange(3)
            changed[k : k + (kind != 1)] = [] if kind == 2 else [rng.choice(rng.choice(texts))]
        codes = leaks.word_codes(changed[:window])
        near = leaks.edit_distances(codes[None], leaks.word_codes(texts[i][at : at + window])[None], edits)[0] <= edits
        true += near
        hit += near and any(item == i for _, item, _, _ in index.matches([codes]))
    assert true > 250 and hit / true >= 0.9, hit / true


def test_recall_of_edited_windows():
    walks, rng = leaks.Walks(), random.Random(5)
    hit = n = 0
    for edits in ("change", "insert", "drop"):
        for _ in range(200):
            item = text(rng, 15)
            doc = list(item)
            at = rng.randrange(1, 14)
            if edits == "change":
                doc[at] = "other"
            elif edits == "insert":
                doc = [*doc[:at], "other", *doc[at:-1]]
            else:
                doc = [*doc[:at], *doc[at + 1 :], "other"]
            index = leaks.Index(walks, [("i", [leaks.word_codes(item)])])
            found = list(index.matches([leaks.word_codes(doc)]))
            near = leaks.edit_distances(leaks.word_codes(doc)[None], leaks.word_codes(item)[None], 1)[0] <= 1
            n += near
            hit += near and bool(found)
    assert n > 150 and hit / n >= 0.9


def test_edit_distances():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i, *row[1:]], row
            for j, y in enumerate(b, 1):
                row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
        return row[-1]

    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 3, (300, 9)).astype(np.uint64) for _ in range(2))
    got = leaks.edit_distances(a, b, 3)
    for x, y, g in zip(a, b, got, strict=True):
        want = plain(x, y)
        assert (g == want) if want <= 3 else (g > 3)


def test_equal_windows_always_meet():
    walks, rng = leaks.Walks(), np.random.default_rng(3)
    w = rng.integers(1, 50, 15).astype(np.uint64)
    codes = np.concatenate([rng.integers(1, 50, 7).astype(np.uint64), w, rng.integers(1, 50, 9).astype(np.uint64)])
    for r in range(walks.repetitions()):
        assert walks.hashes(codes, np.array([7]), r) == walks.hashes(w, np.array([0]), r)


def test_a_recall_out_of_reach_is_an_error():
    with pytest.raises(ValueError, match="sample fewer positions"):
        leaks._repetitions(leaks.Walks(edits=8, sampled=40))
