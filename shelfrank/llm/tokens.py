"""Token ids of whole texts with a public tokenizer, fast enough for a corpus.

`Encoder.ids` gives what `Tokenizer.encode(text, add_special_tokens=False).ids`
gives. A tokenizer that drops white space treats each white-space-delimited
piece of a text by itself, so pieces are encoded once per task and kept; for
the plain Latin letters, digits and signs of most pieces the model of the
tokenizer is called directly. Any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import re

import numpy as np

from shelfrank.llm.common import ship

ship(__name__)

#: Pieces and words whose ids a task keeps.
KEPT = 600_000

# The normalizer and splitting pattern of the tokenizers whose
# pieces are independent.
_NORMALIZER = ["NFC", {"Regex": "\\s+"}, "Lowercase"]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBER = "0-9²³¹¼-¾"
_PLAIN = re.compile("[!-~¡-¬®-ÿ]+")
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible
    Latin-1 characters for themselves, the others from code point 256 on."""
    visible = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    out, more = {}, 256
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b] = chr(more)
            more += 1
    return out


class Encoder:
    """Encodes texts with the tokenizer file at `path`; holds KEPT pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        self.by_piece = self._independent(told)
        self.marks = [t["content"] for t in told["added_tokens"]]
        self.letters = _byte_letters()
        self.pieces: dict[bytes, bytes] = _Kept(self._piece)
        self.words: dict[str, bytes] = _Kept(self._word)

    @staticmethod
    def _independent(told: dict) -> bool:
        steps = (told.get("normalizer") or {}).get("normalizers", [])
        seen = [s.get("pattern") if s["type"] == "Replace" else s["type"] for s in steps]
        split = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (
            seen == _NORMALIZER
            and [s["type"] for s in split] == ["Split", "ByteLevel"]
            and split[0]["pattern"] == {"Regex": _PATTERN}
            and not split[1]["add_prefix_space"]
            and told.get("post_processor") is None
            and told["model"]["type"] == "BPE"
        )

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.tokenizer.model.tokenize(letters)], "<u4").tobytes()

    def _piece(self, piece: bytes) -> bytes:
        if piece.isalpha():  # ASCII letters: one word
            return self.words[piece.lower().decode()]
        if piece[:-1].isalpha() and piece[-1:] in (b".", b","):
            return self.words[piece[:-1].lower().decode()] + self.words[piece[-1:].decode()]
        text = piece.decode()
        if _PLAIN.fullmatch(text) and not any(m in text for m in self.marks):
            return b"".join(map(self.words.__getitem__, _WORD.findall(text.lower())))
        return self._whole(text)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, raw: bytes | None) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        if not raw:
            return b""
        if self.by_piece:
            return b"".join(map(self.pieces.__getitem__, raw.split()))
        return self._whole(raw.decode())


class _Kept(dict):
    """key -> make(key), kept for at most KEPT keys."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= KEPT:
            self.clear()
        value = self[key] = self.make(key)
        return value
