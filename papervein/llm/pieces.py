"""SentencePiece BPE models: exact encoding by backtracking, and decoding.

A text is encoded from left to right.  One Aho-Corasick pass gives the longest piece that
begins at each position.  The longest piece is taken if it can stand behind the piece before
it: the two, merged again from single characters, must give just these two.  Otherwise the
next shorter piece is tried, and when none is left the position is marked as failed in a
bitfield and the piece before it is given up.  A position fails at most once, so long runs
without spaces cost time linear in their length.

Merging is by the score of the merged piece, leftmost first among equals, so a sequence of
pieces is the library's encoding exactly if all neighbours pass that test.  Characters
without a piece become byte pieces.  Where no piece holds a space sign behind another
character, nothing is merged across the front of a run of space signs: the text is cut
there, and short stretches are remembered by the worker (bounded).

Normalisation (a space in front, character maps of the model) is the library's own.  The
model must be of type BPE with byte fallback, without user-defined or unused pieces; others
are refused.

Defined cases: a null text counts as empty and has no ids; repeated rows each get a row;
other columns of the input are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.llm.shared import CACHES

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
# Stretches and pairs remembered by one Python worker, about 130 MB, and the longest such stretch.
REMEMBERED = 600_000
LONGEST_REMEMBERED = 48
# A code in one word with another, or with a length.
CODE_BITS = 22
CODE_MASK = (1 << CODE_BITS) - 1
# Texts encoded before their ids are handed on.
OUT_IDS = 1 << 20


class Codec:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            raw = file.read()
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(raw)
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("needs a BPE model with byte fallback, without user-defined or unused pieces")
        if model.normalizer_spec.remove_extra_whitespaces or model.denormalizer_spec.precompiled_charsmap:
            raise ValueError("models that remove spaces or denormalise are not supported")
        self.normalise = sentencepiece.SentencePieceProcessor(model_proto=raw).normalize
        self.dummy = model.normalizer_spec.add_dummy_prefix
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        unknown = model.trainer_spec.unk_surface
        self.surface: list[str] = [
            {NORMAL: p.piece.replace(SPACE, " "), UNKNOWN: unknown}.get(p.type, "") for p in model.pieces
        ]
        # A byte below 0x80 is a character of its own, whatever is around it.
        for byte, i in self.bytes.items():
            if byte < 0x80:
                self.surface[i] = chr(byte)
        self.byte_of = {i: b for b, i in self.bytes.items() if b >= 0x80}
        self.silent = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.spaced = {i for piece, i in self.ids.items() if piece.startswith(SPACE)}
        # Codes of pieces: their ids, and behind all ids the characters that are no piece.
        self.first_char = len(model.pieces)
        self.text_of = [p.piece for p in model.pieces]
        self.length_of = [len(p.piece) for p in model.pieces]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, len(piece) << CODE_BITS | i)
        self.automaton.make_automaton()
        crossing = any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self.stretches = re.compile("(?s).+" if crossing else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        # The longest piece that begins another, at last its first character; 0 for none.
        self.shorter = [0] * self.first_char
        for piece, i in self.ids.items():
            if len(piece) > 1:
                begins = (self.ids.get(piece[:n]) for n in range(len(piece) - 1, 0, -1))
                self.shorter[i] = next((c for c in begins if c is not None), self.first_char + ord(piece[0]))
        self.fits: dict[int, bool] = {}
        # Stretches seen lately, and those of the time before: frequent ones move on.
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Plain merging from single characters: the best score first, then the leftmost."""
        symbols, score = list(text), self.score
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def piece(self, code: int) -> str:
        return self.text_of[code] if code < self.first_char else chr(code - self.first_char)

    def compatible(self, before: int, code: int) -> bool:
        """Whether two pieces stand side by side in an encoding; ``before`` is 0 at the front."""
        own = [self.piece(c) for c in (before, code) if c]
        if len(self.fits) > REMEMBERED:
            self.fits.clear()
        fit = self.fits[before << CODE_BITS | code] = self.merged("".join(own)) == own
        return fit

    def codes(self, text: str) -> list[int]:
        """The codes of the pieces of normalised text; a character without a piece has its own."""
        size, fits, shorter, length_of, first_char = len(text), self.fits, self.shorter, self.length_of, self.first_char
        matches = self.automaton.iter_long(text)
        # The next match, leftmost and longest, and where the search behind it goes on.
        start, found, following = -1, 0, 0
        failed, any_failed = bytearray(size // 8 + 1), False
        taken: list[int] = []
        at = last = 0
        while at < size:
            if start < at:
                if following != at:
                    matches = self.automaton.iter_long(text, at)
                stop, match = next(matches, (size, 0))
                start, found, following = stop + 1 - (match >> CODE_BITS), match & CODE_MASK, stop + 1
            code = found if start == at else first_char + ord(text[at])
            while True:
                fit = fits.get(last << CODE_BITS | code)
                if fit or fit is None and self.compatible(last, code):
                    end = at + (length_of[code] if code < first_char else 1)
                    if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                        taken.append(code)
                        at, last = end, code
                        break
                code = shorter[code] if code < first_char else 0
                while not code:
                    failed[at >> 3] |= 1 << (at & 7)
                    any_failed = True
                    start = following = -1
                    given_up = taken.pop()
                    last = taken[-1] if taken else 0
                    at -= length_of[given_up] if given_up < first_char else 1
                    code = shorter[given_up] if given_up < first_char else 0
        return taken

    def pieces(self, text: str) -> list[str]:
        return [self.piece(code) for code in self.codes(text)]

    def _ids(self, stretch: str) -> bytes:
        out: list[int] = []
        for code in self.codes(stretch):
            if code < self.first_char:
                out.append(code)
            else:
                out.extend(self.bytes[b] for b in self.piece(code).encode())
        return array("i", out).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, without begin or end ids."""
        known, out = self.known, []
        for stretch in self.stretches.findall(self.normalise(text)):
            ids = known.get(stretch)
            if ids is None:
                ids = self.known_before.get(stretch) or self._ids(stretch)
                if len(stretch) <= LONGEST_REMEMBERED:
                    known[stretch] = ids
            out.append(ids)
        if len(known) > REMEMBERED:
            self.known, self.known_before = {}, known
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: byte pieces in a row are read as UTF-8, a bad byte as U+FFFD.

        The space that normalisation puts in front is taken off the first piece again.
        """
        byte_of, surface = self.byte_of, self.surface
        if byte_of.keys().isdisjoint(ids):
            out = "".join([surface[i] for i in ids])
        else:
            parts: list[str] = []
            run = bytearray()
            for i in ids:
                if i in byte_of:
                    run.append(byte_of[i])
                    continue
                if run:
                    parts.append(_utf8(run))
                    run = bytearray()
                parts.append(surface[i])
            parts.append(_utf8(run))
            out = "".join(parts)
        if self.dummy and next((i for i in ids if i not in self.silent), None) in self.spaced:
            return out[1:]
        return out


def _utf8(run: bytearray) -> str:
    """UTF-8 characters of bytes; each byte that is part of none becomes U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


_CODECS: dict[str, Codec] = {}
CACHES.append(_CODECS)


def codec(path: str) -> Codec:
    """The worker's codec for a model file, loaded once."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _id_lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))


def encode(docs: DataFrame, model: str, with_text: bool = False) -> DataFrame:
    """``doc_id`` and ``ids ARRAY<INT>`` of every document's whole text.

    ``with_text`` adds ``decoded``, the text that the ids give again.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            start, ids, size = 0, [], 0
            for row in range(batch.num_rows):
                ids.append(own.encode(batch.column(1)[row].as_py()))
                size += len(ids[-1])
                if size > OUT_IDS or row + 1 == batch.num_rows:
                    columns = {"doc_id": batch.column(0).slice(start, len(ids)), "ids": _id_lists(ids)}
                    if with_text:
                        columns["decoded"] = pa.array([own.decode(i.tolist()) for i in ids], pa.string())
                    yield pa.RecordBatch.from_pydict(columns)
                    start, ids, size = row + 1, [], 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        encoded, f"doc_id {kind}, ids array<int>" + (", decoded string" if with_text else "")
    )


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids``; of other columns ``doc_id`` is kept."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = [own.decode(row.values.to_pylist()) for row in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "ids": batch.column(1), "decoded": pa.array(texts, pa.string())}
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, ids array<int>, decoded string")


def digest(decoded: DataFrame) -> DataFrame:
    """Number of ids and the digests of the ids, as decimals with commas, and of the text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
