"""Licence scans: Aho-Corasick finds identifier tags and notice phrases in whole texts, and a
shunting-yard parser evaluates the and/or/with expressions that follow a tag."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.rows import identified

# Phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Longer notices, as words, and the identifiers they stand for.
NOTICES = {
    "apache license version 2 0": "apache-2.0",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "cc by 4 0": "cc-by-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nc nd 4 0": "cc-by-nc-nd-4.0",
    "cc by nc sa 4 0": "cc-by-nc-sa-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "eclipse public license": "epl-2.0",
    "gnu affero general public license": "agpl-3.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released under the mit license": "mit",
    "released into the public domain": "public-domain",
}

# Fixed value: the tag before a licence expression.
TAG = "spdx-license-identifier:"

# Identifiers that ask for no more than credit.
PERMISSIVE = frozenset(
    "0bsd apache-2.0 bsd-2-clause bsd-3-clause bsl-1.0 cc-by-4.0 cc0-1.0 isc mit unlicense zlib".split()
)

# Identifiers of the published list that expressions may hold, besides references of
# one's own, which begin with "licenseref-". Those of the GNU licences may end in "-only",
# "-or-later" or "+".
IDENTIFIERS = PERMISSIVE | frozenset(
    """
    afl-3.0 agpl-1.0 agpl-3.0 apache-1.0 apache-1.1 apsl-2.0 artistic-1.0 artistic-2.0 beerware
    blueoak-1.0.0 bsd-1-clause bsd-3-clause-clear bsd-4-clause bzip2-1.0.6 cc-by-1.0 cc-by-2.0
    cc-by-2.5 cc-by-3.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0
    cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0
    cc-by-sa-4.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 curl ecl-2.0 efl-2.0 epl-1.0 epl-2.0 eupl-1.1
    eupl-1.2 ftl gfdl-1.1 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-3.0 hpnd icu ijg imagemagick ipl-1.0
    json lgpl-2.0 lgpl-2.1 lgpl-3.0 libpng libtiff lppl-1.3c mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl
    mulanpsl-2.0 ncsa none noassertion odbl-1.0 ofl-1.0 ofl-1.1 openssl osl-3.0 php-3.0 php-3.01
    postgresql psf-2.0 python-2.0 qpl-1.0 ruby sissl sleepycat sspl-1.0 tcl unicode-dfs-2016 upl-1.0
    vim w3c wtfpl x11 xnet zend-2.0 zpl-2.1
    """.split()
)

# How sure each kind of evidence is.
WEIGHTS = {"tag": 0.9, "notice": 0.8, "phrase": 0.5}

BINDING = {"or": 1, "and": 2, "with": 3}

# Words are runs of ASCII digits and letters and of anything that is not ASCII.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)
_TOKEN = regex.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
# The next token of the line; a slash between identifiers is an old way to write "or".
_NEXT = regex.compile(r"[ \t]*([()/]|[a-z0-9][a-z0-9.+:-]*)")
_GNU = regex.compile(r"([al]?gpl-[0-9.]+|gfdl-[0-9.]+)(?:-only|-or-later|\+)")


@dataclass
class Expression:
    """A parsed licence expression: its identifiers, and whether ``allowed`` ones satisfy it."""

    identifiers: set[str] = field(default_factory=set)
    allowed: bool = False
    valid: bool = False


def evaluate(
    text: str | Sequence[str], allowed: frozenset[str] = PERMISSIVE
) -> Expression:
    """Shunting-yard over identifiers, parentheses, and ``with`` before ``and`` before ``or``.

    ``or`` is satisfied by either side, ``and`` by both, ``x with y`` by ``x`` (an exception only
    adds rights). A malformed expression is not valid, satisfies nothing, and keeps no identifiers.
    """
    output: list[tuple[set[str], bool]] = []
    waiting: list[str] = []
    wants_operand = True

    def apply() -> bool:
        operator = waiting.pop()
        if len(output) < 2:
            return False
        (names, right), (more, left) = output.pop(), output.pop()
        ok = {"or": left or right, "and": left and right, "with": left}[operator]
        output.append((more if operator == "with" else more | names, ok))
        return True

    bad = Expression()
    for token in _TOKEN.findall(text.lower()) if isinstance(text, str) else text:
        if token == "(":
            if not wants_operand:
                return bad
            waiting.append(token)
        elif token == ")":
            if wants_operand:
                return bad
            while waiting and waiting[-1] != "(":
                if not apply():
                    return bad
            if not waiting:
                return bad
            waiting.pop()
        elif token in BINDING:
            if wants_operand:
                return bad
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[token]:
                if not apply():
                    return bad
            waiting.append(token)
            wants_operand = True
        else:
            if not wants_operand:
                return bad
            name = token.rstrip(".:")
            output.append(({name}, name in allowed))
            wants_operand = False
    while waiting:
        if waiting[-1] == "(" or not apply():
            return bad
    if len(output) != 1 or wants_operand:
        return bad
    return Expression(output[0][0], output[0][1], True)


def known(name: str) -> bool:
    """Whether a word names a licence: an identifier of the list, or a reference of one's own."""
    if name.startswith("licenseref-"):
        return True
    gnu = _GNU.fullmatch(name)
    return (gnu[1] if gnu else name) in IDENTIFIERS


def leading(text: str, at: int = 0) -> tuple[list[str], str]:
    """Tokens and text of the longest valid expression that begins at a place of lower-case text.

    Tokens are read one after the other and reading ends with the first that cannot continue an
    expression: a word that names no licence, an operator or parenthesis out of place, or the end
    of the line. So the work is that of the expression, not of its line.
    """
    tokens: list[str] = []
    depth, whole, end, pos = 0, 0, at, at
    wants_operand = True
    while found := _NEXT.match(text, pos):
        word = "or" if found[1] == "/" else found[1]
        if word in BINDING:
            if wants_operand:
                break
            wants_operand = True
        elif word == "(":
            if not wants_operand:
                break
            depth += 1
        elif word == ")":
            if wants_operand or not depth:
                break
            depth -= 1
        else:
            word = word.rstrip(".:")
            exception = bool(tokens) and tokens[-1] == "with"  # which only adds rights: any word
            if not wants_operand or not (exception or known(word)):
                break
            wants_operand = False
        tokens.append(word)
        pos = found.end()
        if not wants_operand and not depth:
            whole, end = len(tokens), pos
    return tokens[:whole], text[at:end].strip()


class Scanner:
    """The automata of one set of phrases; built once in each task."""

    def __init__(
        self,
        base: Mapping[str, str] = BASE_PHRASES,
        notices: Mapping[str, str] = NOTICES,
        allowed: frozenset[str] = PERMISSIVE,
    ) -> None:
        self.allowed = allowed
        self.phrases = ahocorasick.Automaton()
        for phrase in {*base, *notices}:
            # Spaces at both ends: a phrase is found as whole words only.
            self.phrases.add_word(
                f" {phrase} ", (len(phrase) + 2, base.get(phrase), notices.get(phrase))
            )
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        self.tags.add_word(TAG, len(TAG))
        self.tags.make_automaton()

    def scan(self, text: str | None) -> dict:
        """What one text holds: see ``scan_licences``."""
        raw = (text or "").encode()
        words = raw.translate(_WORDS).split()
        joined = (b" " + b" ".join(words) + b" ").decode()
        places: list[int] = []
        base, own, doubt = set(), set(), 1.0
        seen = set()
        at = index = 0
        for end, (length, label, notice) in sorted(
            self.phrases.iter(joined), key=lambda m: m[0] - m[1][0]
        ):
            start = end - length + 1
            index += joined.count(" ", at, start)
            at = start
            if label is not None:
                places.append(index)
                base.add(label)
                seen.add(("phrase", label))
            if notice is not None:
                own.add(notice)
                seen.add(("notice", notice))
        expressions, permissive = [], None
        if b":" in raw:
            lower = raw.lower().decode()
            for end, _ in self.tags.iter(lower):
                tokens, tail = leading(lower, end + 1)
                found = evaluate(tokens, self.allowed)
                expressions.append(tail)
                permissive = found.allowed and permissive is not False
                own |= found.identifiers
                seen |= {("tag", name) for name in found.identifiers}
        for kind, _ in sorted(seen):
            doubt *= 1 - WEIGHTS[kind]
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(places) if places else None,
            "last_word": max(places) if places else None,
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | own)),
            "score": 1 - doubt,
            "expressions": expressions,
            "permissive": permissive,
        }


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string,"
    " labels string, score double, expressions array<string>, permissive boolean"
)


def scan_licences(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    base: Mapping[str, str] = BASE_PHRASES,
    notices: Mapping[str, str] = NOTICES,
    allowed: frozenset[str] = PERMISSIVE,
) -> DataFrame:
    """One row per document: (key, n_words, n_base, first_word, last_word, base_labels, labels,
    score, expressions, permissive).

    ``n_base`` counts all places of base phrases, overlapping ones too; ``first_word`` and
    ``last_word`` are the word numbers of the first and last of them. ``labels`` adds what notices
    and tagged expressions name. ``score`` is how sure it is that the text states a licence: one
    minus the product of the doubts each distinct finding leaves. ``permissive`` tells whether
    allowed identifiers satisfy every tagged expression (null without a tag). The expression of a tag
    is the longest valid one that follows it (``leading``); where none does, it is empty, names
    nothing and satisfies nothing. A null or empty text
    has no words and no finds; repeated rows give repeated results; texts are read whole.
    """
    rows = identified(docs).select(F.col("row")[key].alias(key), F.col("row")[text].alias("_text"))
    kind = rows.schema[key].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, allowed)
        for batch in batches:
            found = pa.Table.from_pylist([scanner.scan(x.as_py()) for x in batch.column(1)], fields)
            yield from found.add_column(0, key, batch.column(0)).to_batches()

    fields = pa.schema(
        [
            ("n_words", pa.int64()),
            ("n_base", pa.int64()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("base_labels", pa.string()),
            ("labels", pa.string()),
            ("score", pa.float64()),
            ("expressions", pa.list_(pa.string())),
            ("permissive", pa.bool_()),
        ]
    )
    return rows.mapInArrow(scanned, f"`{key}` {kind}, {RESULT}")
