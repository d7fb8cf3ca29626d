"""Token ids of whole texts, as the tokenizers library gives them.

The byte-level vocabulary is also there as ranks, and merging by ranks gives
the same ids several times faster.  It is used for texts of characters on
which both libraries split words alike; the rest go to the tokenizers library.
"""

from __future__ import annotations

import base64
import json
import re
from functools import cached_property, lru_cache

import numpy as np

# Printable ASCII, Latin letters, general punctuation.
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ɏ‐-‧€]*")
LONG_TEXT = 500_000


class TextEncoder:
    """Ids without added special tokens; special strings in a text are handled as the library does by default."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None, pattern: str | None):
        self.tokenizer_path = tokenizer_path
        with open(tokenizer_path, encoding="utf-8") as described:
            self.special = [token["content"] for token in json.load(described)["added_tokens"]]
        self.fast = self._merger(ranks_path, pattern) if ranks_path and pattern else None

    @cached_property
    def tokenizer(self):
        """The library's tokenizer, loaded for the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.tokenizer_path)

    @staticmethod
    def _merger(ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        plain = self.fast and len(text) <= LONG_TEXT and _PLAIN.fullmatch(text)
        if plain and not any(special in text for special in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def text_encoder(tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None) -> TextEncoder:
    return TextEncoder(tokenizer_path, ranks_path, pattern)


def cut_points(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document; a first piece takes what does not fill the others."""
    if tokens <= capacity:
        return [(0, tokens)]
    first = tokens % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, tokens, capacity))]
