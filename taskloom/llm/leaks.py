"""Passages of held-out items in a corpus, whole or in part, in any layout and with small edits.

Texts become words (runs of letters or digits of the consistent form, case folded). Every window of an
item's words is embedded by the CGK random walk, which maps edit distance to Hamming distance: a
walk reads a window word by word and, at each step, a random bit of step and word decides whether it
moves on. Each repetition has walks of its own and hashes a sample of the embedding's positions. Windows
of corpus and items that share a hash are candidates, and candidates are verified by the exact edit
distance of the two windows. A text of an item that is shorter than a window may be sought as a window of
its own size.

Equal windows have equal embeddings, so they meet in every repetition: passages copied word by word are
found with certainty, edited ones with the recall that the number of repetitions is derived from.

The items' hashes are a sorted array that is broadcast if its size is below a limit; then the corpus is
read once and nothing but hits leaves a task. Beyond the limit a bit table of the items' hashes, of bounded size,
is broadcast, and only corpus windows that pass it are shuffled to the items' windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from ..session import cut, prepare
from .canon import skeleton

_WORDS = re.compile(r"[^\W_]+")
_GAPS = {i: " " for i in range(128) if not chr(i).isalnum()}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Case-folded words of the consistent form; whatever stands between them is ignored."""
    if not text:
        return []
    plain = skeleton(text)
    return plain.lower().translate(_GAPS).split() if plain.isascii() else _WORDS.findall(plain.casefold())


def word_codes(found: list[str]) -> np.ndarray:
    """64-bit codes of words, the same in every process."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found), dtype=np.uint64, count=len(found))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@dataclass(frozen=True)
class Walks:
    """Parameters of the embedding and of the bit sampling.

    window: words of a window, any number. edits: word edits of a window that are to be found. recall: the share of
    windows with that many edits that is to be found. sampled: positions of the embedding that are
    hashed in each repetition; the more, the fewer false candidates and the more repetitions.
    """

    window: int = 15
    edits: int = 1
    recall: float = 0.9
    sampled: int = 12
    seed: int = 7

    @property
    def steps(self) -> int:
        """Steps of a walk; past the window's end it reads padding."""
        return 3 * self.window

    def repetitions(self) -> int:
        return _repetitions(self) if self.edits else 1

    def of_size(self, words: int) -> Walks:
        """The same for windows of another size, with at least a third of their words free of edits."""
        return self if words == self.window else replace(self, window=words, sampled=min(self.sampled, max(4, words)), edits=min(self.edits, words // 3))

    def plan(self, repetition: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled steps, and the salts of the walk's bits: one for every 64 steps."""
        rng = np.random.default_rng((self.seed, repetition))
        sampled = np.sort(rng.choice(self.steps, self.sampled, replace=False))
        return sampled, rng.integers(1, 2**63, (self.steps + 63) // 64, dtype=np.uint64) | np.uint64(1)

    def hashes(self, codes: np.ndarray, starts: np.ndarray, repetition: int) -> np.ndarray:
        """One hash for each window ``codes[start : start + window]``.

        Bit ``step`` of a word's hashes, 64 bits each, decides whether the walk moves on after that step.
        """
        sampled, salts = self.plan(repetition)
        padded = np.append(codes, np.zeros(self.steps, dtype=np.uint64))  # a walk never runs off the end
        picked = set(sampled.tolist())
        at, end = starts.astype(np.int64), starts.astype(np.int64) + self.window
        out = np.full(len(starts), repetition + 1 + (self.window << 20), dtype=np.uint64)
        for step in range(int(sampled[-1]) + 1):
            if step % 64 == 0:
                bits = _mixed(padded * salts[step // 64])
            if step in picked:
                word = padded[at]
                if step >= self.window:
                    word = np.where(at < end, word, np.uint64(0))
                out = _mixed(out * _MIX + word)
            move = bits[at]
            move >>= np.uint64(step % 64)
            move &= np.uint64(1)
            at += move.view(np.int64)
        return out


@lru_cache(maxsize=16)
def _repetitions(walks: Walks) -> int:
    """From the chance that windows with ``edits`` random edits share a repetition's hash, measured
    on random windows under the walks that are used: the embedding's distortion has no closed form."""
    rng = np.random.default_rng(walks.seed)
    n, k = 4000, walks.window
    a = rng.integers(1, 2**62, (n, k + walks.edits), dtype=np.uint64)
    rows = [list(r) for r in a]
    for row in rows:
        for _ in range(walks.edits):
            at, kind = int(rng.integers(0, k)), int(rng.integers(0, 3))
            fresh = int(rng.integers(1, 2**62))
            row[at : at + (kind != 1)] = [] if kind == 2 else [fresh]
        row += [0] * (k - len(row))
    b = np.array([r[:k] for r in rows], dtype=np.uint64)
    starts = np.arange(n) * k
    first, second = np.ascontiguousarray(a[:, :k]).ravel(), b.ravel()
    missed, repetition = np.ones(n, dtype=bool), 0
    while repetition < 512 and missed.mean() > 1 - walks.recall:
        missed &= walks.hashes(first, starts, repetition) != walks.hashes(second, starts, repetition)
        repetition += 1
    if missed.mean() > 1 - walks.recall:
        raise ValueError(
            f"{repetition} repetitions find {1 - missed.mean():.3f} of windows with {walks.edits} edits, not {walks.recall}: sample fewer positions"
        )
    return max(1, repetition)


def edit_distances(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Levenshtein distances of the rows of two code matrices; values above ``most`` are not exact."""
    n, k = a.shape
    far = np.full(n, most + 1, dtype=np.int16)
    row = [np.full(n, min(j, most + 1), dtype=np.int16) for j in range(k + 1)]
    for i in range(1, k + 1):
        fresh = [np.full(n, min(i, most + 1), dtype=np.int16), *([far] * k)]
        for j in range(max(1, i - most), min(k, i + most) + 1):
            change = row[j - 1] + (a[:, i - 1] != b[:, j - 1])
            fresh[j] = np.minimum(np.minimum(change, row[j] + 1), fresh[j - 1] + 1).astype(np.int16)
        row = fresh
    return row[k]


def _sized(words: int, walks: Walks, whole: bool) -> bool:
    return words == walks.window if whole else words >= walks.window


class Index:
    """Hashes of the items' distinct windows: per repetition sorted, with a bit table before them."""

    def __init__(self, walks: Walks, items: list[tuple[str, list[np.ndarray]]], whole: bool = False) -> None:
        """whole: only texts of exactly a window's size."""
        self.walks, self.names, self.whole = walks, [name for name, _ in items], whole
        texts = [(i, codes) for i, (_, many) in enumerate(items) for codes in many if _sized(len(codes), walks, self.whole)]
        views = [np.lib.stride_tricks.sliding_window_view(c, walks.window) for _, c in texts]
        windows = np.concatenate(views) if views else np.zeros((0, walks.window), dtype=np.uint64)
        owner = np.repeat([i for i, _ in texts], [len(v) for v in views]).astype(np.int64)
        self.windows, which = np.unique(windows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.reshape(-1), owner], axis=1), axis=0)
        self.item = pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        flat, starts = self.windows.ravel(), np.arange(len(self.windows)) * walks.window
        self.tables = []
        for r in range(walks.repetitions()):
            hashed = walks.hashes(flat, starts, r)
            order = np.argsort(hashed, kind="stable")
            self.tables.append((hashed[order], order.astype(np.int32)))
        self.bits = max(12, int(len(self.windows)).bit_length() + 5)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "filters"}

    def filter(self, r: int) -> np.ndarray:
        if "filters" not in self.__dict__:
            self.filters: dict[int, np.ndarray] = {}
        if r not in self.filters:
            seen = np.zeros(1 << self.bits, dtype=bool)
            seen[self.tables[r][0] >> np.uint64(64 - self.bits)] = True
            self.filters[r] = seen
        return self.filters[r]

    def probe(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates: (index into starts, window of the items), each once."""
        found = []
        for r, (keys, which) in enumerate(self.tables):
            hashed = self.walks.hashes(codes, starts, r)
            near = np.flatnonzero(self.filter(r)[hashed >> np.uint64(64 - self.bits)])
            low = np.searchsorted(keys, hashed[near], "left")
            many = np.searchsorted(keys, hashed[near], "right") - low
            near, low, many = near[many > 0], low[many > 0], many[many > 0]
            if len(near):
                offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                found.append(np.repeat(near, many) * len(self.windows) + which[np.repeat(low, many) + offset])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.concatenate(found))
        return both // len(self.windows), both % len(self.windows)

    def matches(self, texts: list[np.ndarray], block: int = 20_000) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, least edits, windows of the text): every verified pair of a text, given by the codes of its
        words, and an item. block: windows at once, as many as a processor's cache holds."""
        k, most = self.walks.window, self.walks.edits
        if not len(self.windows):
            return
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        codes = np.concatenate([np.zeros(0, dtype=np.uint64), *texts])
        begins = np.cumsum(sizes) - sizes
        starts = np.concatenate([np.zeros(0, np.int64), *(b + np.arange(n - k + 1) for b, n in zip(begins, sizes, strict=True) if n >= k)])
        hits = []
        for at in range(0, len(starts), block):
            part = starts[at : at + block]
            low = part[0]  # words outside the block are not looked at
            spot, window = self.probe(codes[low : part[-1] + k], part - low)
            for c in range(0, len(spot), block):
                s, w = part[spot[c : c + block]], window[c : c + block]
                edits = edit_distances(codes[s[:, None] + np.arange(k)], self.windows[w], most)
                good = edits <= most
                s, w, edits = s[good], w[good], edits[good]
                many = self.first[w + 1] - self.first[w]
                offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                item = self.item[np.repeat(self.first[w], many) + offset]
                text = np.searchsorted(begins, np.repeat(s, many), "right") - 1
                hits.append(np.stack([text, item, np.repeat(edits, many), np.repeat(s, many)], axis=1))
        if not hits:
            return
        table = pd.DataFrame(np.concatenate(hits), columns=["text", "item", "edits", "at"])
        for (text, item), g in table.groupby(["text", "item"], sort=True):
            yield int(text), int(item), int(g["edits"].min()), int(g["at"].nunique())


def _item_words(items: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    """(name, words array<string>) of each text of an item that has any."""
    texts = items.select(F.col(id_col).cast("string").alias("name"), F.explode(F.array(*text_cols)).alias("text"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"name": batch["name"], "words": batch["text"].map(words)})

    return texts.where("name is not null and text <> ''").distinct().mapInPandas(split, "name string, words array<string>")


def leaked_items(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "instance_id",
    item_texts: tuple[str, ...] = ("problem_statement", "patch"),
    walks: Walks = Walks(),
    shortest: int | None = None,
    max_index_bytes: int = 256 << 20,
    max_filter_bytes: int = 64 << 20,
) -> DataFrame:
    """(id, item, edits, windows): documents that contain passages of items.

    edits: the least number of word edits between a window of the document and one of the item (0: at
    least ``walks.window`` consecutive words are equal). windows: how many windows of the document match.
    shortest: texts of items with fewer words than a window, but at least so many, are sought as windows of
    their own size, with proportionally few edits; without it a text shorter than a window can't be contained.
    Items that share a text each get a row; null and empty texts match nothing; a repeated document row or item
    counts once. Extra columns are ignored.

    max_index_bytes: up to this size the items' index is broadcast. Beyond, with the same result, a table of at most
    ``max_filter_bytes`` that tells which hashes the items have is broadcast, and windows that pass it are joined.
    """
    spark = prepare(documents.sparkSession)
    kind = dict(documents.dtypes)[id_col]
    least = min(walks.window, shortest or walks.window)
    known = cut(_item_words(items, item_col, list(item_texts)).where(F.size("words") >= least))
    sizes = known.groupBy(F.least(F.size("words"), F.lit(walks.window)).alias("k")).agg(F.sum(F.size("words")).alias("n"))
    many = {r["k"]: r["n"] for r in sizes.collect()}  # at most a row for each size up to the window's
    each = [walks.of_size(k) for k in sorted(many)]
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    if sum(many[w.window] * (12 * w.repetitions() + 8 * w.window + 16) for w in each) <= max_index_bytes:
        grouped: dict[str, list[np.ndarray]] = {}
        for row in known.toLocalIterator():
            grouped.setdefault(row["name"], []).append(word_codes(row["words"]))
        named = sorted(grouped.items())
        shared = spark.sparkContext.broadcast([Index(w, named, w.window < walks.window) for w in each])

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids, texts = batch["id"].tolist(), [word_codes(words(t)) for t in batch["text"]]
                found = [(ids[t], index.names[i], e, n) for index in shared.value for t, i, e, n in index.matches(texts)]
                yield pd.DataFrame(found, columns=["id", "item", "edits", "windows"])

        out = docs.mapInPandas(search, f"id {kind}, item string, edits int, windows bigint")
    else:
        out = _joined(docs, known, kind, each, walks.window, max_filter_bytes)
    out = out.groupBy("id", "item").agg(F.min("edits").alias("edits"), F.max("windows").alias("windows"))
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def _window_hashes(codes: np.ndarray, each: list[Walks], most: int, item: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, starts, hashes) of a text's windows, for every size and repetition; an item's short texts are one window."""
    for w in each:
        if _sized(len(codes), w, item and w.window < most):
            for at in range(0, len(codes) - w.window + 1, 100_000):
                starts = np.arange(at, min(at + 100_000, len(codes) - w.window + 1))
                for r in range(w.repetitions()):
                    yield w.window, starts, w.hashes(codes, starts, r)


def _places(hashed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a table of ``2 ** bits``."""
    return (hashed >> np.uint64(64 - bits)).astype(np.int64), (_mixed(hashed) >> np.uint64(64 - bits)).astype(np.int64)


def _filter(hashes: DataFrame, n: int, max_bytes: int) -> tuple[np.ndarray, int]:
    """A table of bits in which both of every hash are on. Its size follows the number of hashes up to ``max_bytes``; beyond
    that more windows pass it in vain. Tasks send the blocks of the table in which they set bits, and blocks are merged."""
    bits = max(19, min((16 * max(n, 1)).bit_length(), (8 * max_bytes).bit_length() - 1))
    block = 1 << 19  # bits, that is 64 KB

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        on = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            for place in _places(batch["hash"].to_numpy(np.int64).view(np.uint64), bits):
                on[place] = True
        for k in np.flatnonzero(on.reshape(-1, block).any(axis=1)):
            yield pd.DataFrame({"block": [k], "data": [np.packbits(on[k * block : (k + 1) * block]).tobytes()]})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        data = np.bitwise_or.reduce([np.frombuffer(x, dtype=np.uint8) for x in part["data"]])
        return pd.DataFrame({"block": part["block"].iloc[:1], "data": [data.tobytes()]})

    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    blocks = hashes.select("hash").mapInPandas(mark, "block bigint, data binary")
    for row in blocks.groupBy("block").applyInPandas(merge, "block bigint, data binary").toLocalIterator():
        table[row["block"] * block // 8 : (row["block"] + 1) * block // 8] = np.frombuffer(row["data"], dtype=np.uint8)
    return table, bits


def _joined(docs: DataFrame, items: DataFrame, kind: str, each: list[Walks], most: int, max_filter_bytes: int) -> DataFrame:
    """The same pairs for item sets of any size: corpus windows that pass the filter of the items' hashes meet the items'
    distinct windows in a join salted by hot hashes; windows are given back their items last."""
    edits_of = {w.window: w.edits for w in each}

    def rows_of(codes: np.ndarray, item: bool, passes=None) -> Iterator[dict]:
        for size, starts, hashed in _window_hashes(codes, each, most, item):
            keep = np.ones(len(starts), dtype=bool) if passes is None else passes(hashed)
            if keep.any():
                starts, hashed = starts[keep], hashed[keep]
                yield {"hash": hashed.view(np.int64), "at": starts + (size << 40), "codes": [codes[s : s + size].tobytes() for s in starts]}

    def of_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, found in zip(batch["name"], batch["words"], strict=True):
                for rows in rows_of(word_codes(list(found)), True):
                    yield pd.DataFrame({"hash": rows["hash"], "item": name, "item_codes": rows["codes"]})

    windows = cut(items.mapInPandas(of_items, "hash bigint, item string, item_codes binary"))
    table, bits = _filter(windows, windows.count(), max_filter_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def of_docs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value

        def passes(hashed: np.ndarray) -> np.ndarray:
            a, b = _places(hashed, bits)
            on = lambda p: held[p >> 3] & (128 >> (p & 7)).astype(np.uint8) != 0
            return on(a) & on(b)

        for batch in batches:
            for key, text in zip(batch["id"].tolist(), batch["text"], strict=True):
                for rows in rows_of(word_codes(words(text)), False, passes):
                    yield pd.DataFrame({"id": key, **rows})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = (batch["at"].to_numpy(np.int64) >> 40) if len(batch) else np.zeros(0, np.int64)
            for size in np.unique(sizes):
                part = batch[(sizes == size) & (batch["item_codes"].map(len) == 8 * size)]
                if len(part):
                    a, b = (np.frombuffer(b"".join(part[c]), dtype=np.uint64).reshape(-1, size) for c in ("codes", "item_codes"))
                    edits = edit_distances(a, b, edits_of[int(size)])
                    yield part[["id", "at", "item_codes"]].assign(edits=edits.astype(np.int32))[edits <= edits_of[int(size)]]

    hits = cut(docs.mapInPandas(of_docs, f"hash bigint, id {kind}, at bigint, codes binary"))
    met = salted_join(hits, windows.select("hash", "item_codes").distinct(), "hash", ["id", "at"])
    good = met.mapInPandas(verify, f"id {kind}, at bigint, item_codes binary, edits int")
    good = cut(good.groupBy("id", "at", "item_codes").agg(F.min("edits").alias("edits")))
    owned = salted_join(good, windows.select("item_codes", "item").distinct(), "item_codes", ["id", "at"])
    by_size = owned.groupBy("id", "item", (F.shiftright("at", 40)).alias("size"))
    return by_size.agg(F.min("edits").alias("edits"), F.countDistinct("at").alias("windows"))


def leaked_pairs(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, instance_id): the text holds at least 15 consecutive words of the item's statement or
    patch: pairs of ``leaked_items`` in which some window needs no edit."""
    return leaked_items(documents, items).where("edits = 0").select("doc_id", "instance_id")
