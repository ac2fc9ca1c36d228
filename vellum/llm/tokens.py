"""Byte-level BPE ids of the public tokenizer file, fast on plain texts.

The ids are those of `tokenizers` with the given JSON file. Where the file's merge order is its id order
(checked on loading), tiktoken computes the same ids several times faster; texts that may hold a special
token's string, and files of another kind, go through `tokenizers` itself.
"""

from __future__ import annotations

import json
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as characters from U+0100 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        vocab, to_byte = spec["model"]["vocab"], _byte_of_char()
        ranks = {bytes(to_byte[c] for c in piece): i for piece, i in vocab.items() if piece not in self.special}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        in_order = all(vocab[m] == 256 + i for i, m in enumerate(merges))
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) if in_order else None

    @cached_property
    def exact(self):
        """The tokenizer itself, loaded where a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)

    def count(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        return len(self.fast.encode_ordinary(text)) if self.fast else len(self(text))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
