"""Token counts by the whole-token shortcut.

A sentencepiece BPE model never merges across the place where a character
other than a space is followed by a space, if no string of its vocabulary has
a space after another character.  The text then falls into pre-tokens, each a
run of spaces with the run of other characters behind it, whose counts add up.

Offline, every vocabulary string that starts with a space is encoded alone;
those that come back as exactly themselves count as one token each.  Other
pre-tokens are merged by the library once and remembered in a bounded table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm.common import texts

REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
_SPACE = "▁"  # what the model writes for a space
_PRE_TOKEN = re.compile(" +[^ ]*")


class PreTokenCounts(dict):
    """Tokens per pre-token, keyed without the first space; at most ``REMEMBERED`` merged ones are kept."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.separable = self._separable(pieces)
        spaced = [(i, p[1:].replace(_SPACE, " ")) for i, p in enumerate(pieces) if p.startswith(_SPACE)]
        encoded = self.model.encode([text for _, text in spaced], num_threads=1)
        self.single = {text: 1 for (i, text), ids in zip(spaced, encoded) if ids == [i]}
        self.single[""] = 1  # one space at the end of a text
        super().__init__(self.single)

    def _separable(self, pieces: list[str]) -> bool:
        crossing = any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        kept = self.model.encode("a ", out_type=str) == [_SPACE + "a", _SPACE]  # spaces are kept and one goes in front
        return kept and not crossing and self.model.encode("a") != self.model.encode("ａ")

    def __missing__(self, pre_token: str) -> int:
        count = len(self.model.encode(pre_token))
        if len(pre_token) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED + len(self.single):
                self.clear()
                self.update(self.single)
            self[pre_token] = count
        return count

    def of_text(self, text: str) -> int:
        if not text:
            return 0
        if not self.separable:
            return len(self.model.encode(text))
        text = text.replace(_SPACE, " ")
        if "  " in text or text[0] == " ":
            return sum(map(self.__getitem__, [m[1:] for m in _PRE_TOKEN.findall(" " + text)]))
        return sum(map(self.__getitem__, text.split(" ")))


@lru_cache(maxsize=2)
def pre_token_counts(model_path: str) -> PreTokenCounts:
    return PreTokenCounts(model_path)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text)``.

    A null text is empty and has 0 tokens.  Repeated rows give repeated rows,
    other columns are ignored, and an empty table gives an empty one.
    ``model_path`` must name the model on every executor.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = pre_token_counts(model_path)
        for batch in batches:
            rows = texts(batch.column(1))
            tokens = [counts.of_text(text) for text in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text.encode()) for text in rows], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(count, schema)
