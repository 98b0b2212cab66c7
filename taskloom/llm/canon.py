"""One consistent form for text that looks the same but consists of different characters.

A transducer reads grapheme clusters: a base with its combining marks, conjoining letters, joined pictographs, and whatever
invisible characters stand between them. Its table of characters (wide and other presentation forms, ligatures, numerals
made as one character, spaces, hyphens, invisible characters) is precomputed from Unicode data and short lists, the
compositions of bases and marks are compiled into its states, and both are checked for conflicts. A state's output is known
when the state is made; other sequences of marks get their states when first met. The longest cluster is always taken.

Look-alike letters belong to the same pass: a state has a form in each alphabet, and the word's alphabet picks it. A word
with a letter that only one alphabet has belongs to it, and a word of look-alikes alone follows the nearest such word before
it (else after it, until when it waits). What decides is never itself a look-alike, so variants of a text decide alike. A
text with no deciding letter stays if it is in one alphabet, and is Latin if it mixes several. Letters of alphabets listed
as minor are look-alikes only in words that hold letters of another alphabet. Plain ASCII text is its own consistent form.
"""

from __future__ import annotations

import re
import unicodedata as ud
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import look_up
from ..session import cut, prepare

# Letters that look like a Latin letter, by alphabet, each beside the letter it looks like.
CYRILLIC = dict(zip("аеорсухѕіјһԁԛԝӏАВЕКМНОРСТХЅІЈУԚԜ", "aeopcyxsijhdqwlABEKMHOPCTXSIJYQW", strict=True))
GREEK = dict(zip("οϲϳνΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ocjvABEZHIKMNOPTYXCJ", strict=True))
# The same for alphabets, and for rare letters, that count as look-alikes only beside other letters.
ARMENIAN = dict(zip("ոսօհցզՕՍՏԼ", "nuohgqOUSL", strict=True))
CHEROKEE = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᏀᏃᏚᏙᏞᏟᏢᏦᏴ", "DRTiYAJEWMHGZSVLCPKB", strict=True))
RARE = dict(zip("ѵѴԌɑɡ", "vVGag", strict=True))
# Invisible characters, and the hyphens that look like the ASCII one.
INVISIBLE = "­͏؜᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿︎️"
HYPHENS = "‐‑﹣－"
#: Compatibility decompositions that change how a character is presented, not what it looks like it is.
PRESENTATION = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<font>", "<small>")
#: Blocks whose compatibility characters are letters in a row: Latin and Armenian ligatures, Roman numerals.
ROWS = (range(0xFB00, 0xFB50), range(0x2160, 0x2180))

ALPHABETS = ("latin", "cyrillic", "greek")
MINOR = ARMENIAN | CHEROKEE | RARE
_JOINER = "‍"
_PICTURE = "©®‼-㊙\U0001f000-\U0001faff"
#: Blocks that hold letters of the alphabets above: texts without any have no look-alikes to settle.
_BLOCKS = "ɐ-ʯͰ-ϿЀ-ԯ԰-֏Ꭰ-᏿ᴀ-ᶿἀ-῿Ωⷠ-ⷿꙀ-ꚟꭰ-ꮿ\U0001d6a8-\U0001d7cb"


def _rules() -> dict[str, str]:
    """Every mapped character and what it becomes; raises if two rules disagree."""
    table: dict[str, str] = {}

    def put(key: str, value: str) -> None:
        if table.setdefault(key, value) != value:
            raise ValueError(f"conflicting rules for {key!r}: {table[key]!r} and {value!r}")

    for c in INVISIBLE:
        put(c, "")
    for c in HYPHENS:
        put(c, "-")
    for code in [*range(0xA0, 0x3400), *range(0xA000, 0xA800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)]:
        c = chr(code)
        if c in table:
            continue
        kind = ud.decomposition(c).split(" ")[0]
        if ud.category(c) == "Zs":
            put(c, " ")
        elif kind in PRESENTATION or (kind == "<compat>" and any(code in r for r in ROWS)):
            put(c, ud.normalize("NFKC", c))
    while True:  # a rule's result is itself in the consistent form
        longer = {k: "".join(table.get(c, c) for c in v) for k, v in table.items()}
        if longer == table:
            return table
        table = longer


def _check(table: dict[str, str]) -> dict[str, str]:
    """No result may hold a mapped character, and no look-alike may be mapped away by another rule."""
    for key, value in table.items():
        if any(c in table for c in value):
            raise ValueError(f"{key!r} becomes {value!r}, which is mapped again")
    clash = [c for c in [*CYRILLIC, *GREEK, *MINOR] if c in table]
    if clash:
        raise ValueError(f"letters with two rules: {clash}")
    return table


TABLE = _check(_rules())

_TO_LATIN = CYRILLIC | GREEK | MINOR
#: Back from Latin; a v stays one, since it decides Latin words.
_BACK = {"cyrillic": {v: k for k, v in CYRILLIC.items()}, "greek": {v: k for k, v in GREEK.items() if v != "v"}}
_INTO = {"latin": str.maketrans(_TO_LATIN)} | {
    a: str.maketrans(back | {k: back[v] for k, v in _TO_LATIN.items() if v in back and k not in back.values()}) for a, back in _BACK.items()
}
#: Letters that may stand for one another; the others decide.
_OPEN = {*_TO_LATIN, *(c for back in _BACK.values() for c in back)} - set(MINOR)


def _alphabet(letter: str) -> str | None:
    name = ud.name(letter, "")
    return next((a for a in ALPHABETS if name.startswith(a.upper())), None)


class Cluster:
    """A state of the transducer: the cluster read so far, its forms, and where each next character leads.

    script: the alphabet that the cluster's letter decides; "open" for a look-alike, "minor" for one of a minor
    alphabet, None for anything else. own: the alphabet it is written in."""

    __slots__ = ("ahead", "forms", "joined", "own", "script", "text")

    def __init__(self, text: str, joined: bool = False) -> None:
        plain = ud.normalize("NFC", text)
        base = ud.normalize("NFD", plain)[:1]
        self.text, self.joined = text, joined
        self.ahead: dict[str, Cluster | None] = {}
        self.own = _alphabet(base) if base.isalpha() else None
        self.script = "minor" if base in MINOR else "open" if base in _OPEN else self.own
        self.forms = {None: plain} | {a: ud.normalize("NFC", ud.normalize("NFD", plain).translate(_INTO[a])) for a in ALPHABETS}

    def step(self, c: str) -> Cluster | None:
        """The state after one more character; None if the cluster ends before it."""
        value = TABLE.get(c, c)
        if not self.text:
            return _state(value) if value else self
        if not value:
            return _state(self.text, True) if c == _JOINER and _IS_PICTURE(self.text[-1]) else self
        if self.joined and _IS_PICTURE(value):
            return _state(self.text + _JOINER + value)
        if ud.category(value[0])[0] == "M":
            return _state(self.text + value)
        if "ᅠ" <= value[0] <= "ᇿ" and len(ud.normalize("NFC", self.text + value)) == len(ud.normalize("NFC", self.text)):
            return _state(self.text + value)
        return None


_IS_PICTURE = re.compile(f"[{_PICTURE}]").match
_STATES: dict[tuple[str, bool], Cluster] = {}
_MOST_STATES = 200_000  #: kept at once; a table that is full is emptied, and states are made again


def _state(text: str, joined: bool = False) -> Cluster:
    key = (text, joined)
    if key not in _STATES:
        if len(_STATES) >= _MOST_STATES:
            _STATES.clear()
            _START.ahead.clear()
        _STATES[key] = Cluster(text, joined)
    return _STATES[key]


_START = Cluster("")


def clusters(text: str) -> list[Cluster]:
    """The clusters of a text, each as the state in which it ends."""
    out, state = [], _START
    for c in text:
        ahead = state.ahead
        if c not in ahead:
            ahead[c] = state.step(c)
        if (further := ahead[c]) is None:
            out.append(state)
            if c not in _START.ahead:
                _START.ahead[c] = _START.step(c)
            further = _START.ahead[c]
        state = further
    out.append(state)
    return out


def _compile() -> None:
    """States of all composed characters, reached from the character and from its parts; raises if these two differ."""
    for code in [*range(0xC0, 0x3400), *range(0xF900, 0xFB50)]:
        c = chr(code)
        parts = ud.normalize("NFD", c)
        if parts != c and c not in TABLE and (one := [x.forms for x in clusters(c)]) != (two := [x.forms for x in clusters(parts)]):
            raise ValueError(f"{c!r} and its parts differ: {one} and {two}")


_compile()


def _class(chars: list[str]) -> str:
    """A character class, in ranges."""
    out, codes = [], sorted(map(ord, chars))
    for k, code in enumerate(codes):
        if k and code == codes[k - 1] + 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" if a < b else re.escape(chr(a)) for a, b in out)


_EVERY = [chr(c) for c in [*range(0x80, 0xD800), *range(0xE000, 0x10000)]]
_REST = "\U00010000-\U0010ffff"  #: read whole: one range is searched much faster than the marks among them
_MARKS = _class([c for c in _EVERY if ud.category(c)[0] == "M"])
_GOES_ON = _MARKS + _class([c for c, v in TABLE.items() if c < "\U00010000" and (not v or ud.category(v[0])[0] == "M")]) + "\u1160-\u11ff" + _REST
_CHANGES = _class([c for c in _EVERY if c in TABLE or not ud.is_normalized("NFC", c)]) + _REST
#: Clusters that may change: everything else passes untouched.
_SPOT = f"(?:[{_CHANGES}]|[\\s\\S](?=[{_GOES_ON}]))[{_GOES_ON}]*(?:(?<=[{INVISIBLE}])[{_PICTURE}][{_GOES_ON}]*)*"
_SPOTS = re.compile(_SPOT)
_FAR_MARKS = _class([c for c in map(chr, [*range(0x10000, 0x20000), *range(0xE0100, 0xE01F0)]) if ud.category(c)[0] == "M"])
_WORD = f"[^\\W\\d_](?:[^\\W\\d_]|[{_MARKS}{INVISIBLE}]|[{_FAR_MARKS}])*"
_TOKENS = re.compile(f"(?P<word>{_WORD})|{_SPOT}")
_OTHERS = re.compile(f"[{_BLOCKS}]")


@lru_cache(maxsize=65536)
def _read(word: str) -> tuple[str | None, frozenset[str]]:
    """The alphabet that a word's first deciding letter gives it, "open" if none does, None if it holds no letter
    that could change, and the alphabets it is written in."""
    found = clusters(word)
    script = next((c.script for c in found if c.script in ALPHABETS), None)
    held = {c.script for c in found}
    return script or ("open" if "open" in held else None), frozenset(c.own for c in found if c.own)


@lru_cache(maxsize=65536)
def _written(run: str, alphabet: str | None) -> str:
    return "".join([c.forms[alphabet] for c in clusters(run)])


def consistent(text: str | None) -> str | None:
    """The consistent form of a text; null for null."""
    if text is None or text.isascii():
        return text
    if not _OTHERS.search(text):
        return _SPOTS.sub(lambda m: _written(m[0], None), text)
    out: list[str] = []
    waits: list[int] = []  # words before the first that decides
    last, at, alphabets = None, 0, set()
    for m in _TOKENS.finditer(text):
        token = m[0]
        out.append(text[at : m.start()])
        at = m.end()
        if m.lastgroup != "word":
            out.append(_written(token, None))
            continue
        script, own = _read(token)
        if script is None:
            out.append(_written(token, None))
            continue
        if script != "open" and script != last:
            last = script
            for k in waits:
                out[k] = _written(out[k], last)
            waits = []
        if last is None:
            waits.append(len(out))
            alphabets |= own
            out.append(token)
        else:
            out.append(_written(token, last))
    for k in waits:
        out[k] = _written(out[k], "latin" if len(alphabets) > 1 else None)
    out.append(text[at:])
    return "".join(out)


_LATIN = {
    ord(c): v for c in map(chr, [*range(0x250, 0x2B0), *range(0x370, 0x590), *range(0x13A0, 0x1400), *range(0x1F00, 0x2000)])
    if (v := ud.normalize("NFC", ud.normalize("NFD", c).translate(_INTO["latin"]))) != c
}


def skeleton(text: str) -> str:
    """The consistent form with every look-alike as its Latin letter: for comparisons of passages
    that stand among words of any alphabet."""
    if text.isascii():
        return text
    text = _SPOTS.sub(lambda m: _written(m[0], "latin"), text)
    return text.translate(_LATIN) if _OTHERS.search(text) else text


def consistent_text(text: Column) -> Column:
    """Column of consistent forms. Only texts with a character beyond ASCII go through Python."""

    @F.pandas_udf("string")
    def apply(values: pd.Series) -> pd.Series:
        return values.map(consistent, na_action="ignore")

    return F.when(text.rlike(r"[^\x00-\x7f]"), apply(text)).otherwise(text)


def consistent_documents(documents: DataFrame, text: str = "text") -> DataFrame:
    """The table with ``text`` in its consistent form; null stays null and empty stays empty, equal
    texts stay equal, and all other columns are kept as they are."""
    prepare(documents.sparkSession)
    return documents.withColumn(text, consistent_text(F.col(text)))


def look_alike_pairs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: documents whose texts differ but have one consistent form.

    Null and blank texts are in no pair, nor are identical texts. Copies of a text are one class until
    the end: classes meet by the digest of the consistent form, and only classes that met are
    expanded to their documents. A form written in a single way, which is what nearly all are, is
    dropped before any text class is joined.
    """
    prepare(documents.sparkSession)
    text = F.col("__text")
    docs = documents.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where(text.isNotNull())
    form = consistent_text(text)
    digest = lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 32))  # noqa: E731  (128 bits)
    keyed = cut(
        docs.select("__id", digest(text).alias("__raw"), F.when(form.rlike(r"\S"), digest(form)).alias("__form"))
        .where(F.col("__form").isNotNull())
    )
    classes = keyed.select("__form", "__raw").distinct()
    many = classes.groupBy("__form").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__form")
    classes = classes.join(many, "__form", "left_semi")
    left, right = classes.toDF("__form", "__raw_a"), classes.toDF("__form", "__raw_b")
    met = left.join(right, "__form").where(F.col("__raw_a") < F.col("__raw_b"))
    members = keyed.join(many, "__form", "left_semi").select("__raw", "__id")
    pairs = met.join(members.toDF("__raw_a", "__a"), "__raw_a").join(members.toDF("__raw_b", "__b"), "__raw_b")
    return pairs.select(
        F.least("__a", "__b").alias("doc_a"), F.greatest("__a", "__b").alias("doc_b")
    ).where("doc_a < doc_b").distinct()


def look_alike_classes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id): one row per document with a text that isn't blank, with the least id among those of its consistent
    form. Documents look the same just if their classes are equal, so no pairs are made, however many copies a text has:
    the least id of a form combines on the map side, and forms of many documents are looked up as hot keys.

    Null and blank texts have no class; repeated rows give a row each; an empty table gives none.
    """
    prepare(documents.sparkSession)
    text = F.col(text_col)
    form = consistent_text(text)
    digest = F.unhex(F.substring(F.sha2(form, 256), 1, 32))
    keyed = cut(documents.select(F.col(id_col).alias("__id"), F.when(form.rlike(r"\S"), digest).alias("__form")).where("__form is not null"))
    least = keyed.groupBy("__form").agg(F.min("__id").alias("class_id"))
    return look_up(keyed, least, "__form").select(F.col("__id").alias(id_col), "class_id")
