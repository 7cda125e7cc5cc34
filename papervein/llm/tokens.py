"""Token ids of whole texts, as the tokenizer's own library gives them.

Files ending in ``.json`` are read by ``tokenizers``, ``.model`` by ``sentencepiece``.  No
begin, end or added special tokens, no truncation or padding; special strings inside a text
are handled as the library does by default.

A byte-level BPE file without normaliser splits a text into pre-tokens that are encoded
independently.  For texts of plain Latin letters, digits and punctuation the split is done
here, and each distinct pre-token is encoded by the library's model once per task and remembered.
Any other text goes to the library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array

import numpy as np

from papervein.llm.shared import CACHES

# Pre-tokens remembered by one Python worker, twice as many at most, about 160 MB.
REMEMBERED = 400_000

# Letters whose class no version of Unicode disputes, and the characters that may stand
# beside them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(f"[\\t-\\r -~×÷{_LETTERS}‐-‧‰-⁞€]*")
# The split of byte-level BPE, on plain characters.
_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s+(?!\\S)|\\s+"
)


def version_digest(path: str) -> str:
    """Names the tokenizer: the digest of its file and the version of its library."""
    import importlib.metadata

    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{content} {library} {importlib.metadata.version(library)}".encode()).hexdigest()




def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTES = str.maketrans(_byte_characters())


class _Memo(dict):
    """Ids of pre-tokens; one that is missing is taken from those of the time before or encoded."""

    def __init__(self, model, before: dict[str, bytes]):
        super().__init__()
        self.model, self.before = model, before

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            found = self.model.tokenize(piece.encode().decode("latin-1").translate(_BYTES))
            ids = array("I", [t.id for t in found]).tobytes()
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        self.plain_split = False
        self.special: list[str] = []
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            with open(path, encoding="utf-8") as file:
                spec = json.load(file)
            before = spec.get("pre_tokenizer") or {}
            self.special = [t["content"] for t in spec.get("added_tokens") or []]
            self.plain_split = (
                before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
                and before.get("use_regex", True) and not spec.get("normalizer")
                and spec["model"].get("type", "BPE") == "BPE" and not spec["model"].get("dropout")
            )
            # Pre-tokens seen lately, and those of the time before: frequent ones move on.
            self.remembered = _Memo(self.library.model, {})
        else:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def size(self) -> int:
        """How many ids there are, added tokens included."""
        return self.library.get_vocab_size() if hasattr(self.library, "get_vocab_size") else self.library.get_piece_size()

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        if hasattr(self.library, "encode_batch"):
            return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return self.library.encode(texts, num_threads=1)

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not self.plain_split or not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return np.array(self._library_ids([text])[0], "<u4").tobytes()
        if len(self.remembered) > REMEMBERED:
            self.remembered.before = {}  # let the oldest go first
            self.remembered = _Memo(self.library.model, self.remembered)
        return b"".join(map(self.remembered.__getitem__, _SPLIT.findall(text)))


_ENCODERS: dict[str, Encoder] = {}
CACHES.append(_ENCODERS)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
