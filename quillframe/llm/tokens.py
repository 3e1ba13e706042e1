"""Token counts and token ids of whole texts, by tokenizers whose files every executor has.

Texts are handled in slices balanced by bytes. Inside a slice they are cut where the tokenizer ends
a piece whatever stands beside it, the distinct pieces are encoded in one batch, and the encodings
of pieces met before are taken from the worker's cache. Only lengths, or plain id arrays, leave it.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.rows import balanced, cut_at_space, flat, identified

SLICE_BYTES = 6 << 20
CACHED_WORDS = 250_000
CACHED_PIECES = 250_000
PIECES_AT_ONCE = 20_000

# White space as tokenizers see it, and what text libraries add to it.
_SPACE = r"\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# A space between white space and white space or the end: cutting there may cut a run.
_INSIDE_RUN = f"[{_SPACE}] (?:[{_SPACE}]|$)"
# One space between two other characters always begins a piece.
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, read once in a worker; without its own threads, as tasks are many."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def special_strings(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


# Words whose normal form and pieces follow from rules that no Unicode version changes: ASCII and
# Latin letters. All others go through the whole tokenizer.
_ODD = r"[^\t\n\r\x20-\x7e\x{a1}-\x{ac}\x{ae}-\x{12f}\x{131}-\x{24f}]"
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\u012f\u0131-\u024f]*")
_PIECES = {
    # How the two tokenizers split text before the merges.
    "spaced": regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    ),
    "words": regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"),
}


@lru_cache(maxsize=1)
def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printed."""
    printed = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    others = [c for c in range(256) if c not in set(printed)]
    letters = {c: chr(c) for c in printed} | {c: chr(256 + i) for i, c in enumerate(others)}
    return [letters[c] for c in range(256)]


class Encodings:
    """Ids of words, kept over the tasks of a worker; emptied at ``CACHED_WORDS`` and pieces."""

    def __init__(self, path: str) -> None:
        self.model = tokenizer(path).model
        self.path = path
        self.spaced = tokenizer(path).normalizer is None
        self.pattern = _PIECES["spaced" if self.spaced else "words"]
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii() or " " in piece or "\n" in piece or "\t" in piece or "\r" in piece:
            letters = _byte_letters()
            written = "".join([letters[b] for b in piece.encode()])
        else:
            written = piece
        ids = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
        self.pieces[piece] = ids
        return ids

    def of(self, words: pa.Array, plain: bool) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers; ``plain``: none is odd."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        if len(self.pieces) > CACHED_PIECES:
            self.pieces.clear()
        words = words.to_numpy(zero_copy_only=False).tolist()
        known, odd, pieces, new = self.words, [], self.pieces, self._piece
        for word in words:
            if word in known:
                continue
            if not plain and (not _PLAIN.fullmatch(word) or "<|" in word):
                odd.append(word)
                known[word] = b""
                continue
            if not self.spaced:
                word, written = word.lower(), word
                if word.isalpha():
                    known[written] = pieces.get(word) or new(word)
                    continue
                stem, last = word[:-1], word[-1:]
                if last in ",." and stem.isalpha():
                    known[written] = (pieces.get(stem) or new(stem)) + (pieces.get(last) or new(last))
                    continue
            else:
                written = word
            known[written] = b"".join(
                [pieces.get(p) or new(p) for p in self.pattern.findall(word)]
            )
        for at in range(0, len(odd), PIECES_AT_ONCE):
            some = odd[at : at + PIECES_AT_ONCE]
            encoded = tokenizer(self.path).encode_batch_fast(some, add_special_tokens=False)
            for word, found in zip(some, encoded, strict=True):
                known[word] = np.array(found.ids, "<u4").tobytes()
        return list(map(known.__getitem__, words))


@lru_cache(maxsize=4)
def encodings(path: str) -> Encodings:
    return Encodings(path)


def piece_counts(path: str, pieces: pa.Array, plain: bool = False) -> np.ndarray:
    """Tokens of each piece."""
    return np.fromiter(map(len, encodings(path).of(pieces, plain)), np.int64, len(pieces)) // 4


def _cut_safely(text: str, size: int) -> Iterator[str]:
    at = 0
    while len(text) - at > size and (found := _SAFE.search(text, at + size)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def count_batch(path: str, texts: pa.Array) -> np.ndarray:
    """Tokens of each text (null counts as empty), as a byte-level tokenizer counts the whole text.

    A piece begins at a space, unless white space stands on both sides of it. Texts with such runs,
    or with a special string in them, are cut only at single spaces between other characters.
    """
    out = np.zeros(len(texts), np.int64)
    special = special_strings(path)
    for rows, part in balanced(texts, SLICE_BYTES, _cut_safely):
        odd = pc.match_substring_regex(part, _INSIDE_RUN)
        for s in special:
            odd = pc.or_(odd, pc.match_substring(part, s))
        odd = odd.to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd):
            first, *rest = _SAFE.split(part[int(i)].as_py())
            pieces = pa.array([first, *[" " + p for p in rest]], pa.string())
            out[rows[i]] += piece_counts(path, pieces).sum()
        even = pa.array(~odd)
        rows, part = rows[~odd], part.filter(even)
        plain = _plain(part)
        for some in (plain, ~plain):
            if not some.any():
                continue
            offsets, words = flat(pc.split_pattern(part.filter(pa.array(some)), pattern=" "))
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            known = coded.dictionary
            spaced = pc.binary_join_element_wise("", known, " ")
            is_plain = bool(plain[some][0])
            tokens = piece_counts(path, spaced, is_plain)[codes]
            leading, back = np.unique(codes[offsets[:-1]], return_inverse=True)
            tokens[offsets[:-1]] = piece_counts(path, known.take(pa.array(leading)), is_plain)[back]
            np.add.at(out, rows[some], np.add.reduceat(tokens, offsets[:-1]))
    return out


def _plain(texts: pa.Array) -> np.ndarray:
    """Which texts hold nothing but characters whose handling is known, and no special string."""
    odd = pc.or_(pc.match_substring_regex(texts, _ODD), pc.match_substring(texts, "<|"))
    return ~odd.to_numpy(zero_copy_only=False)


def encode_batch(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of each text, how many; all ids in order) for a tokenizer that drops white space.

    Such a tokenizer never joins what white space separates, so every word is a piece.
    """
    lengths = np.zeros(len(texts), np.int64)
    out = [np.zeros(0, "<u4")]
    for rows, part in balanced(texts, SLICE_BYTES, cut_at_space):
        plain = _plain(part)
        edges = [0, *(np.flatnonzero(np.diff(plain)) + 1).tolist(), len(part)]
        if len(edges) > 20:  # odd texts are many: look at each word instead
            plain[:], edges = False, [0, len(part)]
        for lo, hi in zip(edges, edges[1:]):
            some = part.slice(lo, hi - lo)
            offsets, words = flat(
                pc.ascii_split_whitespace(pc.utf8_lower(some) if plain[lo] else some)
            )
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            known = encodings(path).of(coded.dictionary, bool(plain[lo]))
            size = np.fromiter(map(len, known), np.int32, len(known)) // 4
            ids = np.frombuffer(b"".join(known), "<u4")
            per_word = size[codes]
            ends = np.concatenate([[0], np.cumsum(per_word, dtype=np.int32)])
            first = (np.cumsum(size, dtype=np.int32) - size)[codes]
            at = np.repeat(first - ends[:-1], per_word)
            at += np.arange(len(at), dtype=np.int32)
            out.append(ids[at])
            np.add.at(lengths, rows[lo:hi], np.diff(ends[offsets]))
    return lengths, np.concatenate(out)


def token_counts(
    docs: DataFrame, path: str, limit: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``path`` is the file of a byte-level BPE tokenizer, at the same place on every executor. A null
    text counts as empty: no bytes, no tokens. Very long texts are cut at safe places, so that no
    piece of work is larger than ``SLICE_BYTES``. Repeated rows give repeated results.
    """
    rows = identified(docs).select(F.col("row")[key].alias(key), F.col("row")[text].alias("_text"))
    kind = rows.schema[key].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            tokens = count_batch(path, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(
        counted, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
