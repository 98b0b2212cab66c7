"""Token ids of whole texts by a public byte-level BPE vocabulary, encoded as a tree of parts.

A part is a monoid element: its text and the ids of its text. A text is halved recursively into leaves, leaves are encoded,
and neighbours are joined up the tree. A join re-encodes a window around the boundary, which grows on both sides until each
end is a place where a pre-token ends whatever stands around it: after a letter before anything else, after a number before
anything else, or after anything before white space. The pre-tokenizer is a pattern without look-behind that is matched from
left to right, and a match before such a place doesn't depend on what follows it; so texts on both sides of the place are
encoded alike alone and together, tokens outside the window are proven to stay, and the result is that of encoding the text
at once. Decoding concatenates bytes up the same tree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import prepare

#: Fixed value: the pre-tokenizer pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Characters of a leaf.
LEAF_CHARS = 512


@lru_cache(maxsize=4)
def encoding(vocabulary: str):
    """The encoder of a rank file, one per worker process."""
    import tiktoken

    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Letters, and what may follow them, whose classes are the same in all versions of the standard that a library may hold.
_LETTER = r"(?<=\p{L})(?<=[A-Za-zÀ-ɏͰ-ϿЀ-ԯぁ-ゖァ-ヺ一-龥가-힣])"
_AFTER = r"(?=\P{L})(?=[\x00-\x7f -⁯　-〿＀-／])"


@lru_cache(maxsize=1)
def _fixed_ends():
    """Finds where a pre-token ends in any surroundings."""
    import regex

    return regex.compile(rf"{_LETTER}{_AFTER}|(?<=[0-9])(?=[\x00-\x2f\x3a-\x7f])|(?<=\P{{White_Space}})(?=[ \t\r\n])")


class Part(NamedTuple):
    """A text and its ids."""

    text: str
    ids: list[int]


def leaf(text: str, vocabulary: str = VOCABULARY) -> Part:
    """A part encoded at once."""
    return Part(text, encoding(vocabulary).encode_ordinary(text))


def _last_end(text: str) -> int:
    """The last place at which a pre-token surely ends, sought in windows that grow from the text's end; 0 if there is none."""
    width = 32
    while True:
        start = max(0, len(text) - width)
        at = -1
        for m in _fixed_ends().finditer(text, start + 1 if start else 0):
            at = m.start()
        if at > 0 or not start:
            return max(at, 0)
        width *= 4


def _first_end(text: str) -> int:
    """The first such place, or the text's length."""
    m = _fixed_ends().search(text)
    return m.start() if m else len(text)


def join(a: Part, b: Part, vocabulary: str = VOCABULARY) -> Part:
    """The part of the joined text. Associative; ``leaf("")`` is neutral.

    The window reaches from the last fixed end of the left text to the first of the right one. What the left part's tokens
    in the window are is known by encoding them alone, since they begin at a fixed end, and likewise on the right.
    """
    if not a.text or not b.text:
        return b if not a.text else a
    encode = encoding(vocabulary).encode_ordinary
    start, stop = _last_end(a.text), _first_end(b.text)
    gone, fresh = len(encode(a.text[start:])), encode(a.text[start:] + b.text[:stop])
    known = len(encode(b.text[:stop]))
    return Part(a.text + b.text, a.ids[: len(a.ids) - gone] + fresh + b.ids[known:])


def tree(parts: list[Part], vocabulary: str = VOCABULARY) -> Part:
    """Neighbours joined level by level."""
    while len(parts) > 1:
        pairs = [join(*parts[i : i + 2], vocabulary) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        parts = pairs
    return parts[0]


def halves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The leaves of a text: halved until no part is longer than ``size``."""
    if len(text) <= size:
        return [text]
    half = len(text) // 2
    return halves(text[:half], size) + halves(text[half:], size)


def encode_text(text: str | None, vocabulary: str = VOCABULARY, size: int = LEAF_CHARS) -> list[int]:
    """All ids of one text, by the tree; empty for null and empty texts."""
    if not text:
        return []
    return tree([leaf(p, vocabulary) for p in halves(text, size)], vocabulary).ids


def decode_ids(ids: list[int], vocabulary: str = VOCABULARY, size: int = 4096) -> str:
    """The text of token ids: halves of at most ``size`` ids are decoded to bytes and concatenated up the tree. Ids that
    aren't a text's raise an error."""
    parts = [encoding(vocabulary).decode_bytes(ids[i : i + size]) for i in range(0, len(ids), size)] or [b""]
    while len(parts) > 1:
        parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0].decode("utf-8")


def encode_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    leaf_chars: int = LEAF_CHARS,
    spread_chars: int = 100_000,
) -> DataFrame:
    """(id, ids array<int>): the token ids of every row's whole text, without special tokens.

    Null and empty texts give an empty list, strings that look like special tokens are ordinary text,
    and repeated rows, or ids, give a row each. Other columns are ignored. ``vocabulary`` is the path of
    the rank file, which must exist on every node.

    Texts of at most ``spread_chars`` are encoded as trees of leaves of ``leaf_chars`` in their own task. Longer ones are cut into segments in rows of their own that are spread over all tasks,
    encoded there as trees, and joined up the tree per text: only those texts are shuffled.
    """
    spark = prepare(documents.sparkSession)
    kind = dict(documents.dtypes)[id_col]
    rows = documents.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [encode_text(t, vocabulary, leaf_chars) for t in batch["__text"]]
            yield pd.DataFrame({"id": batch["__id"], "ids": ids})

    short = F.coalesce(F.length("__text"), F.lit(0)) <= spread_chars
    out = rows.where(short).mapInPandas(whole, f"id {kind}, ids array<int>")
    segments = (
        rows.where(~short)
        .withColumn("__row", F.monotonically_increasing_id())
        .select(
            "__id", "__row",
            F.posexplode(F.expr(
                f"transform(sequence(0, (length(__text) - 1) div {spread_chars}), "
                f"i -> substr(__text, i * {spread_chars} + 1, {spread_chars}))"
            )).alias("__no", "__segment"),
        )
        .repartition("__row", "__no")
    )

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(ids=[encode_text(t, vocabulary, leaf_chars) for t in batch["__segment"]])

    def joined(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("__no")
        parts = [Part(t, list(i)) for t, i in zip(batch["__segment"], batch["ids"], strict=True)]
        return pd.DataFrame({"id": [batch["__id"].iloc[0]], "ids": [tree(parts, vocabulary).ids]})

    long = (
        segments.mapInPandas(encoded, f"__id {kind}, __row bigint, __no int, __segment string, ids array<int>")
        .groupBy("__row")
        .applyInPandas(joined, f"id {kind}, ids array<int>")
    )
    return out.unionByName(long).withColumnRenamed("id", id_col)
