"""Encoding and decoding by merge-type SentencePiece vocabularies.

A text is a row of symbols, its characters with ``▁`` for a space. An agenda holds the adjacent
pairs of symbols whose concatenation is a piece, ordered by the piece's score and then by place;
the best pair is joined and its new neighbours enter the agenda, until no pair is left. A symbol
that is no piece is written as its bytes.

No piece of such a vocabulary holds a ``▁`` after another character, so nothing is ever joined
across the border before a run of ``▁`` and the text falls into units there, words with what
leads them. Units are encoded once each and kept in the worker's cache; all that are new in a slice
of an Arrow batch are held against the sentencepiece library before their ids are used.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.rows import balanced, flat

SPACE = "▁"
SLICE_BYTES = 4 << 20
CACHED_UNITS = 600_000
CACHED_LENGTH = 64  # characters of a unit that is kept
PLACE_BITS = 32  # of an agenda's entry
_PLACES = (1 << PLACE_BITS) - 1
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*")
# A space between two characters that are neither a space nor its sign: units end and begin there.
_CUT = re.compile(f"(?<=[^ {SPACE}]) (?=[^ {SPACE}])")


def merge(symbols: str, rank: dict[str, int]) -> list[str]:
    """Join adjacent symbols of a text, best pair first, ties from the left.

    ``rank`` has for each piece the place of its score, from 0 for the best, shifted by
    ``PLACE_BITS``; an entry of the agenda is that and the place of the left symbol.
    """
    part = list(symbols)
    end = len(part)
    if end >> PLACE_BITS:
        raise ValueError("a unit is too long")
    found = map(rank.get, map(str.__add__, part, part[1:]))
    agenda = [r + i for i, r in enumerate(found) if r is not None]
    heapify(agenda)
    left = list(range(-1, end - 1))
    right = list(range(1, end + 1))
    while agenda:
        entry = heappop(agenda)
        i = entry & _PLACES
        j = right[i]
        if j == end or not part[i] or rank.get(joined := part[i] + part[j]) != entry - i:
            continue  # one of the two has been joined to another since
        part[i] = joined
        part[j] = ""
        right[i] = j = right[j]
        if j < end:
            left[j] = i
            if (r := rank.get(joined + part[j])) is not None:
                heappush(agenda, r + i)
        if (j := left[i]) >= 0 and (r := rank.get(part[j] + joined)) is not None:
            heappush(agenda, r + j)
    return [p for p in part if p]


class PieceModel:
    """A vocabulary of merge type, as its file gives it, and the cache of encoded units."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kind, spec = model.trainer_spec, model.normalizer_spec
        kinds = model.SentencePiece
        types = {p.type for p in model.pieces}
        if kind.model_type != kind.BPE or not types <= {
            kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN
        }:
            raise ValueError("a vocabulary of merges without user-defined or unused pieces is needed")
        if (
            spec.precompiled_charsmap
            or not spec.add_dummy_prefix
            or not spec.escape_whitespaces
            or spec.remove_extra_whitespaces
            or kind.treat_whitespace_as_suffix
            or not kind.byte_fallback
        ):
            raise ValueError("the model changes texts in ways that are not handled here")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in normal):
            raise ValueError("pieces reach over the end of a word")
        self.library = SentencePieceProcessor(model_file=path)
        self.end_id = self.library.eos_id()
        self.ids = normal
        scores = sorted({model.pieces[i].score for i in normal.values()}, reverse=True)
        place = {score: n << PLACE_BITS for n, score in enumerate(scores)}
        self.rank = {p: place[model.pieces[i].score] for p, i in normal.items()}
        # Marks that follow a letter in no piece: nothing is joined across the border between.
        glued = {b for p in normal for a, b in zip(p, p[1:]) if a.isalpha()}
        marks = "".join(re.escape(c) for c in ".,;:!?\n\r\t\"'()" if c not in glued)
        self.borders = re.compile(f"(?<=[^\\W\\d_])(?=[{marks}])") if marks else None
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.normal = np.zeros(len(model.pieces), bool)
        self.normal[list(normal.values())] = True
        # What each id says: the bytes of its piece; nothing for control ids.
        self.said: list[bytes] = [b""] * len(model.pieces)
        for i, p in enumerate(model.pieces):
            if p.type == kinds.NORMAL:
                self.said[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == kinds.UNKNOWN:
                self.said[i] = kind.unk_surface.encode()
        self.is_byte = np.zeros(len(model.pieces), bool)
        for b, i in enumerate(self.byte_ids):
            self.said[i] = bytes([b])
            self.is_byte[i] = True
        self.silent = np.array([not x for x in self.said])
        self.units: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    def _stretch(self, text: str) -> bytes:
        out = array("i")
        for symbol in merge(text, self.rank):
            found = self.ids.get(symbol)
            if found is None:
                out.extend([self.byte_ids[b] for b in symbol.encode()])
            else:
                out.append(found)
        ids = out.tobytes()
        if len(text) <= CACHED_LENGTH:
            self.stretches[text] = ids
        return ids

    def encode_unit(self, unit: str) -> bytes:
        """Ids of a text that is given with its spaces as ``▁``, by the agenda."""
        known, new = self.stretches, self._stretch
        parts = self.borders.split(unit) if self.borders else [unit]
        if len(parts) == 1:
            return known.get(unit) or new(unit)
        return b"".join([known.get(part) or new(part) for part in parts])

    def of(self, units: list[str]) -> list[bytes]:
        """Ids of each unit as little-endian 32-bit integers; new ones are checked by the library."""
        if len(self.units) > CACHED_UNITS:
            self.units.clear()
        if len(self.stretches) > CACHED_UNITS:
            self.stretches.clear()
        known, encode = self.units, self.encode_unit
        new = [u for u in dict.fromkeys(units) if u not in known]
        long: dict[str, bytes] = {}
        if new:
            plain = [u[1:].replace(SPACE, " ") for u in new]
            for unit, want in zip(new, self.library.encode(plain, num_threads=1), strict=True):
                ids = encode(unit)
                if ids != array("i", want).tobytes() and unit != SPACE:  # an empty text has no prefix
                    raise ValueError(f"ids differ from those of the library: {unit[:80]!r}")
                (known if len(unit) <= CACHED_LENGTH else long)[unit] = ids
        if long:
            return [long[u] if u in long else known[u] for u in units]
        return list(map(known.__getitem__, units))


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    """The model of a file, read once in a worker."""
    return PieceModel(path)


def encode_texts(model: PieceModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(how many ids each text has, all ids in order), without begin or end; null counts as empty."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, f"^ |  | $|{SPACE}").to_numpy(zero_copy_only=False)
    full = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
    # Words of ordinary texts are units; those with runs of spaces, or a sign of one, are looked at.
    offsets, words = flat(pc.split_pattern(texts.filter(pa.array(full & ~odd)), pattern=" "))
    coded = words.dictionary_encode()
    units = pc.binary_join_element_wise(SPACE, coded.dictionary, "").to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.zeros(len(texts), np.int64)
    counts[full & ~odd] = np.diff(offsets)
    numbers = {u: i for i, u in enumerate(units)}
    own: list[int] = []
    for i in np.flatnonzero(odd).tolist():
        found = _UNITS.findall(SPACE + texts[i].as_py().replace(" ", SPACE))
        own += [numbers.setdefault(u, len(numbers)) for u in found]
        counts[i] = len(found)
    if own:
        of_odd = np.repeat(odd, counts)
        plain, codes = codes, np.empty(len(of_odd), np.int64)
        codes[of_odd], codes[~of_odd] = own, plain
    ids = model.of(list(numbers))
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    pool = np.frombuffer(b"".join(ids), "<i4")
    first = np.cumsum(size) - size
    per_unit = size[codes]
    ends = np.concatenate([[0], np.cumsum(per_unit)])
    place = np.repeat(first[codes] - ends[:-1], per_unit) + np.arange(ends[-1])
    upto = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(ends[upto]), pool[place]


def decode_ids(model: PieceModel, ids: np.ndarray, first: bool = True) -> bytes:
    """The text of some ids in UTF-8: one leading space, which encoding puts there, is left out.

    ``first``: whether they begin a text. Bytes that are no character give U+FFFD each.
    """
    said = b"".join([model.said[i] for i in ids.tolist()])
    if model.is_byte[ids].any():
        try:
            said.decode()
            broken = model.silent[ids[:-1]].any()  # between two bytes of a character, perhaps
        except UnicodeDecodeError:
            broken = True
        if broken:
            said = _replaced(model, ids)
    if first and said.startswith(b" "):
        speaks = next(i for i in ids.tolist() if model.said[i])
        return said[1:] if model.normal[speaks] else said
    return said


def _replaced(model: PieceModel, ids: np.ndarray) -> bytes:
    """``decode_ids`` where runs of byte pieces hold bytes that are no character."""
    out, run = [], b""

    def settle(run: bytes) -> str:
        text = ""
        while run:
            for n in range(min(4, len(run)), 0, -1):
                try:
                    text += run[:n].decode()
                    run = run[n:]
                    break
                except UnicodeDecodeError:
                    if n == 1:
                        text, run = text + "�", run[1:]
        return text

    for i in ids.tolist():
        if model.is_byte[i]:
            run += model.said[i]
            continue
        out.append(settle(run).encode())
        out.append(model.said[i])
        run = b""
    return b"".join([*out, settle(run).encode()])


def _cut(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters that begin with a unit; the space between is left out,
    as encoding puts one before each part."""
    at = 0
    while len(text) - at > size and (found := _CUT.search(text, at + size)):
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def encode_pieces(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", end: bool = True
) -> DataFrame:
    """(key, ids array<int>) for each row of ``docs``: the ids of its whole text, and the end id.

    ``path`` is the file of a model, at the same place on every executor. A null text counts as
    empty: the end id alone. Repeated rows give repeated results, an empty table an empty one.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for keys, parts in _slices(batch):
                counts, ids = [], []
                for n, found in _whole(model, parts):
                    counts.append(n + end)
                    ids += [found, np.full(int(end), model.end_id, "<i4")]
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([keys, lists], names=["key", "ids"])

    return rows.mapInArrow(encoded, f"key {kind}, ids array<int>")


def decode_pieces(encoded: DataFrame, path: str, ids: str = "ids", key: str = "key") -> DataFrame:
    """(key, text) for each row of ``encoded``; control ids say nothing, null ids give a null text.

    Ids are 0 or more and below the size of the vocabulary.
    """
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            texts = [
                None if x is None else decode_ids(model, np.array(x, np.int64)).decode()
                for x in (v.as_py() for v in batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["key", "text"]
            )

    return rows.mapInArrow(decoded, f"key {kind}, text string")


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
    """(keys, parts of their texts): slices of bounded bytes; a long text comes alone, in parts."""
    held: list[pa.Array] = []
    row = -1
    for rows, part in balanced(batch.column(1), SLICE_BYTES, _cut):
        if held and rows[0] != row:
            yield batch.column(0).slice(row, 1), held
            held = []
        if len(rows) == 1:
            row, held = int(rows[0]), [*held, part]
        else:
            yield batch.column(0).slice(int(rows[0]), len(rows)), [part]
    if held:
        yield batch.column(0).slice(row, 1), held


def _whole(model: PieceModel, parts: list[pa.Array]) -> Iterator[tuple[int, np.ndarray]]:
    """(number of ids, ids) of each text of a slice."""
    if len(parts) > 1:
        found = [encode_texts(model, part)[1] for part in parts]
        yield sum(map(len, found)), np.concatenate(found)
        return
    counts, ids = encode_texts(model, parts[0])
    ends = np.cumsum(counts)
    for n, upto in zip(counts.tolist(), ends.tolist()):
        yield n, ids[upto - n : upto]


def piece_digests(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) for each row of ``docs``.

    ``encode_pieces`` with the end id, then ``decode_ids``, digested where they are made, so that
    neither ids nor texts leave the worker: ids in decimal with a space between, and the decoded
    text in UTF-8. Nulls, empty texts, repeated rows and empty tables as in ``encode_pieces``.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        written = [str(i).encode() for i in range(len(model.said))]
        end = written[model.end_id]
        for batch in batches:
            for keys, parts in _slices(batch):
                tokens, of_ids, of_text = [], [], []
                for n, ids in _whole(model, parts):
                    tokens.append(n + 1)
                    line = b" ".join([*map(written.__getitem__, ids.tolist()), end])
                    of_ids.append(sha256(line).hexdigest())
                    of_text.append(sha256(decode_ids(model, ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(tokens, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                    names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return rows.mapInArrow(
        digested, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
