"""Byte-level BPE ids from a tokenizer file; loaded once per Python worker."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers

DEFAULT_TOKENIZER = "byte_bpe_50k.json"


def _byte_letters() -> dict[str, int]:
    """Printable stand-ins of the byte-level alphabet, back to their bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Ids equal to the tokenizer file's own encoder without special tokens added.

    The merge loop runs in tiktoken on the file's vocabulary, which is several times faster; a text
    that holds the string of an added token, or that tiktoken refuses, takes the file's own encoder.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        self.path, self._slow = path, None
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in spec["model"]["vocab"].items()
            if token not in self.added
        }
        self._fast = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.sizes = np.zeros(max(ranks.values()) + 2 + len(self.added), dtype=np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        for t in spec.get("added_tokens", []):
            self.sizes[t["id"]] = len(t["content"].encode())

    def encode(self, text: str) -> list[int]:
        if not any(a in text for a in self.added):
            try:
                return self._fast.encode_ordinary(text)
            except BaseException as error:  # the regex engine panics on extreme runs of one class
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    return public_tokenizers.path(name)
