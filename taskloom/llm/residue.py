"""Statements that hold unfilled templates, filler, error texts or notices instead of real content.

Character n-gram models of slots (over shapes), filler and notices are fitted on labelled phrases,
and one of natural prose on the distinct lines that are not residue themselves. A position's score is the log likelihood ratio of its
n-gram under a residue model and under prose; windows with a high mean localise residue. A sentence
or line covered by such windows is residue; a slot is residue wherever it stands. Code and quotations are
masked before: a report that shows such text is no case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import prepare
from .residue_seeds import CONTEXTS, HEADS, samples

_MASK = "\x1a"  #: stands for a piece of code or a quotation; texts that hold it get a space instead
_FENCE = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
_CODE = re.compile(r"``[^\n]+?``|`[^`\n]+`")
_QUOTE = re.compile(r'(?<![\w>])"[^"\n]+"(?!\w)|“[^”\n]+”|„[^“\n]+“')
_QUOTED_LINE = re.compile(r"^[ \t]*>.*$", re.M)
_RECORD_LINE = re.compile(r"^[ \t]*[{<\[].*$", re.M)
_SENTENCE = re.compile(r"[^\n]+?(?:[.!?…](?=\s)|(?=\n)|\Z)|\n+")
_ANCHOR = re.compile(r"[\[<(\])>]|\b(?:tbd|todo)\b")  #: where a slot known by its words starts or ends
_RUNS = re.compile(r"[A-Z]+|[^\W\d_A-Z]+|\d+")
_CLASSES = {i: "9" if chr(i).isdigit() else "A" if chr(i).isupper() else "a" for i in range(128) if chr(i).isalnum()}
_REPEATS = re.compile(r"([aA9])\1+")
_DIGIT = re.compile(r"\d")
_PART = re.compile(rf"(?:#+ *|\*\*)?(?:{'|'.join(map(re.escape, HEADS))})(?:\*\*)?:?(?:\*\*)?\s*", re.I)
_HEADING = re.compile(r"#+ *[^\W\d_]+(?: [^\W\d_]+)*:?\s*")
_SOLID = re.compile(r"[^\W_]|[._\-{}<>%@\[\]]")


@dataclass(frozen=True)
class Settings:
    """n: characters of a letter n-gram; shape_n: of a shape n-gram. bits: buckets are 2**bits.
    each: expansions of a labelled phrase (the labelled sample has at most 4,000 texts a class at 24).
    backoff: share of a model's mass spread over all buckets. window: n-grams of a window.
    ratio: mean log ratio of a residue window. coverage: share of a sentence that windows must cover.
    slot: summed log ratio of a slot, over slot_window shape n-grams.
    worded: the same of a slot known by its words, at best over as many letter n-grams from its start or end.
    masked: marks of code and quotations for each character of a sentence that its other characters may still condemn.
    known, marks: what a line of the first prose model must stay below: share of letter n-grams that labelled
    phrases hold, and shape n-grams of a slot window that only slots hold."""

    n: int = 5
    shape_n: int = 4
    bits: int = 20
    each: int = 24
    backoff: float = 0.05
    window: int = 12
    ratio: float = 1.0
    coverage: float = 0.6
    slot: float = 12.0
    slot_window: int = 6
    worded: float = 12.0
    masked: float = 0.05
    known: float = 0.5
    marks: int = 4


def masked(text: str) -> str:
    """The text with code and quotations replaced by a mark; lines that are records keep their quotes."""
    text = _FENCE.sub(_MASK, text.replace("\r\n", "\n").replace(_MASK, " "))
    text = _CODE.sub(_MASK, text)
    text = _QUOTED_LINE.sub(_MASK, text)
    return "\n".join(line if _RECORD_LINE.match(line) else _QUOTE.sub(_MASK, line) for line in text.split("\n"))


def letters(text: str) -> str:
    """What the letter models read: lower case (so that lengths stay), digits as 9."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return _DIGIT.sub("9", lower)


def shape(text: str) -> str:
    """Letter runs as a or A, digit runs as 9."""
    classes = text.translate(_CLASSES) if text.isascii() else _RUNS.sub(_class, text)
    return _REPEATS.sub(r"\1", classes)


def _class(m: re.Match) -> str:
    return "9" if m[0].isdigit() else "A" if m[0].isupper() else "a"


def shape_places(text: str) -> list[int]:
    """For each character of the shape, its place in the text."""
    out, at = [], 0
    for m in _RUNS.finditer(text):
        out.extend(range(at, m.start()))
        out.append(m.start())
        at = m.end()
    return [*out, *range(at, len(text))]


def grams(text: str, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram at each position; the text is padded by line ends."""
    codes = np.frombuffer(("\n" + text + "\n" * (n - 1)).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < n:
        return np.zeros(0, np.int64)
    out = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = (out ^ codes[j : j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return (out >> np.uint64(64 - bits)).astype(np.int64)


def _sentences(body: str) -> Iterator[re.Match]:
    return (m for m in _SENTENCE.finditer(body) if _SOLID.search(m[0]))


def _lines(statements: DataFrame, text: str) -> DataFrame:
    """Every distinct sentence or line of the masked statements, digits as 9, which both kinds of model read alike."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {_DIGIT.sub("9", m[0].strip()) for value in batch.iloc[:, 0] for m in _sentences(masked(value))}
            yield pd.DataFrame({"line": sorted(seen)}, dtype=object)

    return statements.select(F.col(text).alias("t")).where("t <> ''").mapInPandas(split, "line string").distinct()


class _Block:
    """Lines under one another, each after a gap that no n-gram spans: their n-grams, and where each line starts."""

    def __init__(self, lines: list[str], s: Settings) -> None:
        gap = "\n" * s.n
        body = gap.join(lines)
        shapes = shape(body)
        self.lines = lines
        self.grams = grams(letters(gap[1:] + body), s.n, s.bits), grams(gap[1:] + shapes, s.shape_n, s.bits)
        self.starts = [s.n + np.cumsum([0, *(len(x) + s.n for x in part.split(gap)[:-1])]) for part in (body, shapes)]

    def mean(self, values: np.ndarray) -> np.ndarray:
        """Mean over each line of a value of every letter n-gram."""
        sizes = np.array([len(x) for x in self.lines])
        total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return (total[self.starts[0] + sizes] - total[self.starts[0]]) / sizes

    def most(self, k: int, values: np.ndarray, width: int) -> np.ndarray:
        """Greatest sum in each line over a window of a value, not negative, of every n-gram (k: 0 letters, 1 shapes)."""
        return np.maximum.reduceat(np.convolve(values, np.ones(width), "same")[: len(values)], self.starts[k] - 1)


def _blocks(batches: Iterator[pd.DataFrame], s: Settings) -> Iterator[_Block]:
    for batch in batches:
        held, size = [], 0
        for line in batch["line"]:
            held.append(line)
            size += len(line)
            if size >= 200_000:
                yield _Block(held, s)
                held, size = [], 0
        if held:
            yield _Block(held, s)


@lru_cache(maxsize=2)
def _labelled(s: Settings) -> dict[str, np.ndarray]:
    """n-gram counts of the labelled phrases: letters, and shapes for slots."""

    def of(texts: list[str], n: int) -> np.ndarray:
        counts = np.zeros(1 << s.bits, dtype=np.int64)
        for t in texts:
            np.add.at(counts, grams(t, n, s.bits), 1)
        return counts

    out = {k: of([letters(t) for t in samples(k, s.each)], s.n) for k in ("filler", "notice", "worded")}
    out["slot"] = of([shape(t) for t in samples("slot", s.each)], s.shape_n)
    filled = of([shape(c.replace("@", w)) for c in CONTEXTS for w in ("name", "Title", "OS", "function_name")], s.shape_n)
    out["mark"] = np.where(filled > 0, 0, out["slot"])
    return out


def _marks(s: Settings) -> tuple[np.ndarray, np.ndarray, Settings]:
    """Which letter n-grams labelled phrases hold, and which shape n-grams only slots hold; made once, by the driver."""
    found = _labelled(s)
    return (found["filler"] + found["notice"] + found["worded"] > 0).astype(np.float32), (found["mark"] > 0).astype(np.float32), s


def _unlike(marks: tuple[np.ndarray, np.ndarray, Settings]):
    """Which lines of a block resemble no labelled phrase, whatever the table holds."""
    known, mark, s = marks

    def keep(block: _Block) -> np.ndarray:
        return (block.mean(known[block.grams[0]]) < s.known) & (block.most(1, mark[block.grams[1]], s.slot_window) < s.marks)

    return keep


def _unflagged(models: Models):
    """Which lines of a block are no residue under the models; only lines that could be are judged one by one."""
    s = models.s

    def keep(block: _Block) -> np.ndarray:
        open_ = block.most(1, np.maximum(models.slots[block.grams[1]], 0), s.slot_window) >= s.slot - 1e-3
        open_ |= block.most(0, np.maximum(models.ratios["worded"][block.grams[0]], 0), s.slot_window) >= s.worded - 1e-3
        for kind in ("filler", "notice"):
            open_ |= block.mean(models.ratios[kind][block.grams[0]]) >= s.ratio - 1e-3
        return np.array([not (o and models.spans(x)) for x, o in zip(block.lines, open_, strict=True)])

    return keep


def _counts(lines: DataFrame, choose, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts (letters, shapes) of the lines chosen block by block by ``choose.value``, a broadcast test.
    At most 2 * 2**bits rows reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        test, argument = choose.value
        keep = test(argument)
        total = np.zeros((2, 1 << s.bits), dtype=np.int64)
        for block in _blocks(batches, s):
            for k, stream in enumerate(block.grams):
                np.add.at(total[k], stream, 1)
            if dropped := [x for x, k in zip(block.lines, keep(block), strict=True) if not k]:
                for k, stream in enumerate(_Block(dropped, s).grams):
                    np.subtract.at(total[k], stream, 1)
        for k in range(2):
            bucket = np.flatnonzero(total[k])
            yield pd.DataFrame({"kind": np.int32(k), "bucket": bucket.astype(np.int32), "n": total[k][bucket]})

    rows = lines.mapInPandas(count, "kind int, bucket int, n bigint")
    found = rows.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((2, 1 << s.bits), dtype=np.int64)
    out[found["kind"].to_numpy(np.int64), found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out[0], out[1]


def prose_counts(statements: DataFrame, text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts (letters, shapes) of every distinct line that is no residue, so that neither copies nor a
    residue line that many different statements share, in one wording or in several, are taken for prose.

    A first model counts the lines that resemble no labelled phrase; it depends on no frequency of residue. The
    lines that are residue under it are left out, all others counted."""
    spark = statements.sparkSession
    lines = _lines(statements, text)
    first = Models(*_counts(lines, spark.sparkContext.broadcast((_unlike, _marks(s))), s), s)
    return _counts(lines, spark.sparkContext.broadcast((_unflagged, first)), s)


class Models:
    """Log likelihood ratios of every bucket: filler and notices over letters, slots over shapes."""

    def __init__(self, prose: np.ndarray, prose_shapes: np.ndarray, s: Settings) -> None:
        self.s = s

        def log(counts: np.ndarray) -> np.ndarray:
            share = counts / max(1, counts.sum())
            return np.log((1 - s.backoff) * share + s.backoff / len(counts))

        natural, shapes, found = log(prose), log(prose_shapes), _labelled(s)
        self.ratios = {k: (log(found[k]) - natural).astype(np.float32) for k in ("filler", "notice", "worded")}
        self.slots = (log(found["slot"]) - shapes).astype(np.float32)

    def spans(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, kind, score) of residue in the masked text, sentence by sentence. A heading of
        words alone, or a line that names a part of a report, is none over real text: reports have such lines too."""
        s, body = self.s, masked(text)
        found: list[tuple[int, int, str, float]] = []
        lower = letters(body)
        gram = grams(lower, s.n, s.bits)
        cover = {k: _windows(self.ratios[k][gram], s.window, s.ratio) for k in ("filler", "notice")}
        ratio = self.slots[grams(shape(body), s.shape_n, s.bits)]
        best = _sums(ratio, s.slot_window)
        slot_at = set()
        if best.max(initial=0.0) >= s.slot and (places := shape_places(body)):
            slot_at = {places[min(i, len(places) - 1)] for i in np.flatnonzero(best >= s.slot)}
        worded = np.maximum(self.ratios["worded"][gram], -4.0)
        told: dict[int, float] = {}
        able = np.convolve(np.maximum(worded, 0.0), np.ones(s.slot_window), "same").max() >= s.worded - 1e-3
        for a in _ANCHOR.finditer(lower) if able else ():  # forward from what opens a slot, backward from what closes it
            i, w = a.start() + 1, s.slot_window
            run = worded[max(0, i - s.n + 1 - w) : i - s.n + 2][::-1] if a[0] in "])>" else worded[i : i + w]
            told[a.start()] = float(np.cumsum(run).max()) if len(run) else 0.0
        slot_at.update(a for a, v in told.items() if v >= s.worded)
        if not slot_at and not any(on.any() for on in cover.values()):
            return found
        covered = {k: np.concatenate([[0], np.cumsum(on)]) for k, on in cover.items()}
        heads: list[tuple[int, int, str, float]] = []  # not yet known to stand before residue
        for m in _SENTENCE.finditer(body):
            part = m[0]
            if not _SOLID.search(part):
                if _MASK in part:
                    heads = []
                continue
            before, heads = heads, []
            if slot_at and any(m.start() <= i < m.end() for i in slot_at):
                found += [*before, (m.start(), m.end(), "slot", float(max([best.max(), *told.values()])))]
                continue
            for kind, total in covered.items():
                held, marks = total[m.end() + 1] - total[m.start() + 1], part.count(_MASK)
                if marks:
                    held -= sum(cover[kind][m.start() + 1 + i] for i, c in enumerate(part) if c == _MASK)
                if marks <= s.masked * len(part) and held >= s.coverage * (len(part) - marks):
                    mean = float(self.ratios[kind][gram[m.start() + 1 : m.end() + 1]].mean())
                    if mean >= s.ratio:
                        here = (m.start(), m.end(), kind, mean)
                        if _HEADING.fullmatch(part) or _PART.fullmatch(part):
                            heads = [*before, here]
                        else:
                            found += [*before, here]
                        break
        return found + [h for h in heads if not _PART.fullmatch(body[h[0] : h[1]])]


def _sums(ratio: np.ndarray, width: int) -> np.ndarray:
    """Sum of the window around each position; one n-gram counts for at most -4."""
    return np.convolve(np.maximum(ratio, -4.0), np.ones(width), "same")[: len(ratio)] if len(ratio) >= width else ratio


def _windows(ratio: np.ndarray, width: int, least: float) -> np.ndarray:
    """Positions inside a window whose mean ratio is at least ``least``; short texts are one window."""
    if not len(ratio):
        return np.zeros(0, dtype=bool)
    width = min(width, len(ratio))
    mean = np.convolve(ratio, np.ones(width) / width, "valid")
    on = np.zeros(len(ratio) + 1, dtype=np.int32)
    for i in np.flatnonzero(mean >= least):
        on[i] += 1
        on[i + width] -= 1
    return np.cumsum(on[:-1]) > 0


def residue(
    instances: DataFrame,
    id_col: str = "row_id",
    text_col: str = "problem_statement",
    settings: Settings = Settings(),
) -> DataFrame:
    """(id, coverage, kinds, passages): the rows whose statement is, or holds, residue.

    coverage: share of the statement's characters, code and quotations aside, in residue sentences, so a
    caller may exclude wholly residual rows only. kinds: slot, filler, notice. passages: the sentences,
    with code and quotations masked. Null, empty and blank statements are no case; every copy of a
    repeated row is judged alike; an empty table gives an empty result; other columns are ignored.
    """
    spark = prepare(instances.sparkSession)
    kind = dict(instances.dtypes)[id_col]
    models = spark.sparkContext.broadcast(Models(*prose_counts(instances, text_col, settings), settings))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = models.value
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"].tolist(), batch["text"], strict=True):
                if found := m.spans(text):
                    body = masked(text)
                    size = sum(not c.isspace() for c in body.replace(_MASK, ""))
                    held = sum(not c.isspace() for a, b, _, _ in found for c in body[a:b].replace(_MASK, ""))
                    kinds = sorted({k for _, _, k, _ in found})
                    rows.append((key, held / max(1, size), kinds, [body[a:b].strip() for a, b, _, _ in found]))
            yield pd.DataFrame(rows, columns=["id", "coverage", "kinds", "passages"])

    picked = instances.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    out = picked.mapInPandas(judge, f"id {kind}, coverage double, kinds array<string>, passages array<string>")
    return out.withColumnRenamed("id", id_col)


def real_content(instances: DataFrame, id_col: str = "row_id", most: float = 0.0, **options) -> DataFrame:
    """The table without the rows whose residue covers more than ``most``; ids must not be null."""
    bad = residue(instances, id_col, **options).where(F.col("coverage") > most).select(id_col).distinct()
    return instances.join(bad, id_col, "left_anti")
