"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items are normalised to words and cut into windows; all windows go
into one automaton.  Each text is normalised and scanned once; a match ends at
a known place of the normalised text, which gives the numbers of its words,
and these give the place in the original, as normalisation keeps every word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.common import staged, texts, utf8

WINDOW = 13
# Letters of windows one automaton may hold: about 60 bytes of memory each.
AUTOMATON_LETTERS = 2_000_000

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_SCANNED = "doc_id {id}, n_words long, words array<long>, windows array<long>, spans array<struct<start:long,end:long>>"


def words_of(text: bytes) -> list[bytes]:
    """Words of letters A-Z in lower case, digits, and bytes above 127."""
    return text.translate(_WORD_BYTES).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """All runs of ``size`` words, or the only run of fewer; none without words."""
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, window`` of ``items(item_id, text)``, repeated windows of an item once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (str(item), window.decode("latin-1"))
                for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)))
                for window in set(windows_of(words_of(text.encode()), size))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["item_id", "window"]
            )

    cut_up = items.select("item_id", "text").where("item_id IS NOT NULL").mapInArrow(cut, "item_id string, window string")
    return cut_up.distinct()


def build_automaton(windows: list[str]) -> ahocorasick.Automaton:
    """An automaton whose values are window numbers and word counts; spaces bound the words."""
    automaton = ahocorasick.Automaton()
    for number, window in enumerate(windows):
        automaton.add_word(f" {window} ", (number, window.count(" ") + 1))
    if windows:
        automaton.make_automaton()
    return automaton


@lru_cache(maxsize=1)
def _automaton(windows: tuple[str, ...]) -> ahocorasick.Automaton:
    return build_automaton(list(windows))


def find_hits(words: list[bytes], automaton: ahocorasick.Automaton) -> tuple[np.ndarray, set[int]]:
    """The numbers of all words inside a match, and the numbers of the windows that match."""
    found: set[int] = set()
    if not words or not len(automaton):
        return np.zeros(0, np.int64), found
    haystack = (b" " + b" ".join(words) + b" ").decode("latin-1")
    matches = list(automaton.iter(haystack))
    if not matches:
        return np.zeros(0, np.int64), found
    spaces = np.flatnonzero(np.frombuffer(haystack.encode("latin-1"), np.uint8) == 32)
    edges = np.zeros(len(words) + 1, np.int64)
    for end, (number, size) in matches:
        last = int(np.searchsorted(spaces, end))  # the space behind word number last - 1
        edges[last - size] += 1
        edges[last] -= 1
        found.add(number)
    return np.flatnonzero(np.cumsum(edges[:-1]) > 0), found


def original_spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Code point ranges of the runs of hit words in the original text."""
    inside = np.frombuffer(text.translate(_WORD_BYTES), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    starts, ends = edge[0::2], edge[1::2]
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [{"start": int(points[starts[r[0]]]), "end": int(points[ends[r[-1]]])} for r in runs if len(r)]


def _scanned(docs: DataFrame, windows: list, first: bool, last: bool) -> DataFrame:
    """One pass over the texts; later passes add to what earlier ones found and need the texts again.

    ``docs`` has ``doc_id`` and ``text``, or ``doc_id`` and the whole ``row``, which the last pass gives back.
    """
    held = docs.sparkSession.sparkContext.broadcast((tuple(w["window"] for w in windows), [w["number"] for w in windows]))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    carried = [name for name in ("text", "row") if name in docs.columns and (name == "row" or not last)]
    schema = T.StructType([*T.StructType.fromDDL(_SCANNED.format(id=id_type)), *(docs.schema[name] for name in carried)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, numbers = held.value
        automaton = _automaton(strings)
        for batch in batches:
            text_column = batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column("row"), "text")
            data, offsets = utf8(text_column)
            earlier = None if first else (batch.column("words").to_pylist(), batch.column("windows").to_pylist())
            sizes, hits, numbered, spans = [], [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                words = words_of(text)
                hit, found = find_hits(words, automaton)
                known = {numbers[k] for k in found}
                if earlier:
                    hit = np.union1d(hit, np.array(earlier[0][i], np.int64))
                    known.update(earlier[1][i])
                sizes.append(len(words))
                hits.append(hit.tolist())
                numbered.append(sorted(known))
                spans.append(original_spans(text, hit) if len(hit) else [])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(hits, pa.list_(pa.int64())),
                pa.array(numbered, pa.list_(pa.int64())),
                pa.array(spans, span),
            ]
            names = ["doc_id", "n_words", "words", "windows", "spans"]
            columns += [batch.column(name) for name in carried]
            yield pa.RecordBatch.from_arrays(columns, [*names, *carried])

    return docs.mapInArrow(scan, schema)


def _all_scanned(docs: DataFrame, windows: DataFrame, passes: int) -> DataFrame:
    """What all passes over the texts find."""
    for k in range(passes):
        part = windows if passes == 1 else windows.where(F.col("pass") == k)
        docs = _scanned(docs, part.select("window", "number").collect(), k == 0, k + 1 == passes)
        if k + 1 < passes:
            docs = staged(docs, "scanned")
    return docs


_CONTAMINATED = "size(words) > 0 AND 20 * size(words) >= n_words"


def _dealt(cut_up: DataFrame, letters: int) -> tuple[DataFrame, int]:
    """The different windows with a number and the automaton they are dealt to, and how many automata there are."""
    windows = staged(cut_up.select("window").distinct().withColumn("number", F.monotonically_increasing_id()), "windows")
    total = windows.agg(F.sum(F.length("window") + F.lit(2))).first()[0] or 0
    passes = 1 if total <= letters else -(-2 * total // letters)
    return windows.withColumn("pass", F.pmod(F.xxhash64("window"), F.lit(passes))), passes


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, letters: int = AUTOMATON_LETTERS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept.

    A row is decided where it is, without a shuffle, and whatever its id:
    rows without one, or with the id of another row, count like all others.
    """
    windows, passes = _dealt(item_windows(items, size), letters)
    if passes > 1:
        whole = docs.select("doc_id", F.struct("*").alias("row"))
        return _all_scanned(whole, windows, passes).where(f"NOT ({_CONTAMINATED})").select("row.*")
    held = docs.sparkSession.sparkContext.broadcast(tuple(w["window"] for w in windows.select("window").collect()))
    column = docs.columns.index("text")

    def clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(held.value)
        for batch in batches:
            data, offsets = utf8(batch.column(column))
            keep = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                words = words_of(data[a:b].tobytes())
                hit, _ = find_hits(words, automaton)
                keep.append(not len(hit) or 20 * len(hit) < len(words))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean_rows, docs.schema)


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, letters: int = AUTOMATON_LETTERS) -> DataFrame:
    """Words of ``docs(doc_id, text)`` inside windows of ``items(item_id, text)``.

    Returns ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``
    and ``spans``, the hit passages as code point ranges of the original.
    A null text has no words; null item texts, items without words and null
    item ids have no windows; repeated item ids are one item.  Repeated rows
    of ``docs`` give repeated rows; other columns are ignored.

    Windows beyond ``letters`` are dealt to several automata, each of which
    gets a pass of its own over the texts, so that none grows with the items.
    The automata know windows by number only.  Item ids are looked up after the
    scan, once for each different set of windows, so that a window of very many
    items is neither broadcast with them nor looked up for every text it is in.
    """
    cut_up = staged(item_windows(items, size), "item-windows")
    windows, passes = _dealt(cut_up, letters)
    found = _all_scanned(docs.select("doc_id", "text"), windows, passes)
    found = staged(
        found.select("doc_id", "n_words", F.size("words").cast("long").alias("n_hit"), "windows",
                     F.expr(_CONTAMINATED).alias("contaminated"), "spans"), "scanned"
    )
    sets = found.where("size(windows) > 0").select("windows").distinct().withColumnRenamed("windows", "of")
    asked = cut_up.join(windows.select("window", "number"), "window").select("number", "item_id")
    per_set = sets.select("of", F.explode("of").alias("number")).join(asked, "number").groupBy("of")
    per_set = per_set.agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    per_set = per_set.select("of", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("ids"))
    per_set = per_set.withColumn("items_sha256", F.sha2(F.col("ids").cast("binary"), 256)).drop("ids")
    # Texts without a window, nearly all, take no part in the join.
    none = found.where("size(windows) = 0").select(
        "*", F.lit(0).cast("long").alias("n_items"), F.lit(items_digest([])).alias("items_sha256")
    )
    some = found.join(per_set, F.col("windows") == F.col("of")).drop("of")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
    return none.select(*columns).unionAll(some.select(*columns))


def items_digest(item_ids: list[str]) -> str:
    """What ``items_sha256`` holds for these items."""
    return hashlib.sha256(",".join(sorted(item_ids)).encode()).hexdigest()
