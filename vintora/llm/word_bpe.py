"""Ids of a lower-casing BPE with word ends, from a tokenizer file; loaded once per Python worker."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import public_tokenizers
import regex

from vintora.llm.bpe import _byte_letters

WORD_TOKENIZER = "word_bpe_49k.json"
CHUNKS_HELD = 300_000  #: chunks between white space whose ids a worker keeps, twice as many at most
LATIN = "ɐ"  #: chunks below it are split by the pattern here, others by the file's own encoder
# Fixed value: the tokenizer file's own pattern of pieces.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
CONTROLS = re.compile(r"[\x1c-\x1f]")  #: white space to Python, not to the tokenizer


class _Chunks(dict):
    """Little-endian unsigned 32-bit ids of each chunk; of older chunks only those still met are kept."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(self) >= CHUNKS_HELD:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class WordBpe:
    """Ids equal to the tokenizer file's own encoder without special tokens added.

    No piece crosses white space, so a text is looked up chunk by chunk. Words of letters merge in tiktoken: their last
    byte, which carries the word end, is written as a byte that no word of letters holds. A text that holds an added token, is not composed (NFC) or has a character whose lower case depends
    on its place takes the file's encoder as a whole.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        letters = _byte_letters()
        inside = bytes([*range(97, 123), *range(128, 256)])
        last = {b: b - 32 for b in range(97, 123)} | {b: b - 128 for b in range(128, 192)}
        ranks: dict[bytes, int] = {}
        for token, i in spec["model"]["vocab"].items():
            if token in self.added:
                continue
            body = bytes(letters[c] for c in token.removesuffix(WORD_END))
            if body.translate(None, inside) or (token.endswith(WORD_END) and body[-1] not in last):
                continue
            if token.endswith(WORD_END):
                body = body[:-1] + bytes([last[body[-1]]])
            ranks[body] = i
        spare = max(spec["model"]["vocab"].values()) + len(self.added) + 1
        for b in range(256):
            ranks.setdefault(bytes([b]), spare + b)
        self._merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._last = [bytes([last.get(b, 0)]) for b in range(256)]
        self._pieces: dict[str, list[int]] = {}
        self._chunks = _Chunks(self._chunk)

    def _word(self, word: str) -> list[int]:
        data = word.encode()
        return self._merge.encode_single_piece(data[:-1] + self._last[data[-1]])

    def _piece(self, piece: str) -> list[int]:
        if piece[0].isalpha():
            return self._word(piece)
        if piece not in self._pieces:
            if len(self._pieces) >= CHUNKS_HELD:
                self._pieces.clear()
            self._pieces[piece] = self.own.encode(piece, add_special_tokens=False).ids
        return self._pieces[piece]

    def _chunk(self, chunk: str) -> bytes:
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return self._chunks[chunk[:-1]] + self._chunks[chunk[-1]]
        if max(chunk) >= LATIN:
            ids = self.own.encode(chunk, add_special_tokens=False).ids
        elif chunk.isalpha():
            ids = self._word(chunk)
        else:
            ids = [i for piece in PIECES.findall(chunk) for i in self._piece(piece)]
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        plain = text.isascii() or ("Σ" not in text and unicodedata.is_normalized("NFC", text))
        if not plain or CONTROLS.search(text) or any(a in text for a in self.added):
            return array("I", self.own.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self._chunks.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def tokenizer_path(name: str = WORD_TOKENIZER) -> str:
    return public_tokenizers.path(name)
