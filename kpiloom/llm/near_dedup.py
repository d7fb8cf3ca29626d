"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has a fixed number of coordinates.  In each round every shingle of a
text is hashed to a place and a value; a place keeps the smallest value of the
first round that reaches it.  The first rounds choose places at random, the
later ones visit one place each, so that every coordinate is filled, and the
coordinates' agreement is concentrated around the Jaccard similarity.  Most
texts need only a round or two, however long they are.

Texts with the same set of shingles form a class, and only its first text goes
on.  Coordinates are cut into bands; classes that share a band are compared on
their full sets of shingles: first each with the smallest class that it shares a
band with.  Those of a band that are in different components by then are
searched for the pairs that can still be similar enough by exact bounds on
their sizes and rare shingles.  A large group of copies is so linked by one
comparison each, and no candidate is given up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import mixed, rows_without, staged, utf8

SHINGLE = 5
# A pair of similarity 0.75 shares no band with a chance of (1 - 0.75 ** 4) ** 32, under one in 100,000.
BANDS, BAND_ROWS = 32, 4
SIMILAR, OF = 75, 100
# Ids of classes with candidates that may be broadcast; beyond it the texts are shuffled by id.
BROADCAST_ROWS = 500_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_ORDER = np.uint64(0xA24BAED4963EE407)


def word_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of a text, A-Z in lower case."""
    text = _LOWER[text]
    inside = ~_SPACE[text]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = np.arange(len(text)) - np.repeat(starts, np.diff(np.append(starts, len(text)))) if starts[0] == 0 else None
    if place is None:
        text, inside = text[starts[0] :], inside[starts[0] :]
        starts, ends = starts - starts[0], ends - starts[0]
        place = np.arange(len(text)) - np.repeat(starts, np.diff(np.append(starts, len(text))))
    terms = np.where(inside, _VALUES[text] * _powers(int(place.max()) + 1)[place], np.uint64(0))
    return mixed(np.add.reduceat(terms, starts) + lengths.astype(np.uint64))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS))
        _POWERS = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64))))
    return _POWERS


def shingle_set(text: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of the different shingles; fewer words than ``size`` are one shingle."""
    words = word_hashes(text)
    n = len(words) - size + 1
    if not len(words):
        return words
    run = len(words) if n < 1 else size
    value = np.zeros(max(1, n), np.uint64)
    for k in range(run):
        value = value * _ORDER + words[k : k + len(value)]
    return np.unique(mixed(value + np.uint64(run)))


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``size`` coordinates per set; no set may be empty."""
    sketch = np.full((len(sets), size), np.iinfo(np.uint64).max, np.uint64)
    flat = sketch.reshape(-1)
    open_sets = np.arange(len(sets))
    lengths = np.array([len(s) for s in sets], np.int64)
    members = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    for k in range(2 * size):
        hashed = mixed(members ^ mixed(np.array([2 * k + 1], np.uint64)))
        value = (hashed >> np.uint64(16)) | np.uint64(k << 48)
        if k < size:
            place = ((hashed & np.uint64(0xFFFF)) * np.uint64(size) >> np.uint64(16)).astype(np.int64)
        else:
            place = np.full(len(members), k - size)
        np.minimum.at(flat, owner * size + place, value)
        full = (sketch[open_sets] != np.iinfo(np.uint64).max).all(axis=1)
        if full.any():
            closed = np.zeros(len(sets), bool)
            closed[open_sets[full]] = True
            left = ~closed[owner]
            members, owner, open_sets = members[left], owner[left], open_sets[~full]
            if not len(open_sets):
                break
    return sketch


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), bands)).copy()
    for k in range(rows):
        key = mixed(key * _ORDER + parts[:, :, k])
    return key


def similar(left: np.ndarray, right: np.ndarray, share: int = SIMILAR, of: int = OF) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``share / of``."""
    both = len(np.intersect1d(left, right, assume_unique=True))
    return of * both >= share * (len(left) + len(right) - both) and both > 0


def sketched(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands``; the set's two hashes identify the set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            sets = [shingle_set(data[a:b], shingle) for a, b in zip(offsets[:-1], offsets[1:])]
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(sketches([sets[i] for i in some], bands * rows), bands, rows).view(np.int64)
            row_of = {i: k for k, i in enumerate(some)}
            sums = [(int(s.sum(dtype=np.uint64)), int(mixed(s ^ _BASE).sum(dtype=np.uint64))) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([a for a, _ in sums], np.uint64).view(np.int64)),
                    pa.array(np.array([b for _, b in sums], np.uint64).view(np.int64)),
                    pa.array([keys[row_of[i]] if i in row_of else [] for i in range(len(sets))], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_shingles long, set_a long, set_b long, bands array<long>"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, share: int, of: int, broadcast_rows: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets of shingles are similar enough.

    Only texts that are in a pair are moved.  A text in very many pairs is
    moved once per pair, and the join splits it over tasks.
    """
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "paired")
    known = F.broadcast(ids) if ids.count() <= broadcast_rows else ids
    texts = staged(docs.select("doc_id", "text").join(known, "doc_id", "left_semi"), "texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            data_a, at_a = utf8(batch.column(2))
            data_b, at_b = utf8(batch.column(3))
            ids = batch.column(0).to_pylist()
            keep = []
            for i, name in enumerate(ids):
                if last[0] != name:
                    last = (name, shingle_set(data_a[at_a[i] : at_a[i + 1]], shingle))
                keep.append(similar(last[1], shingle_set(data_b[at_b[i] : at_b[i + 1]], shingle), share, of))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(check, f"a {id_type}, b {id_type}")


def _signature(links: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(hashed, 32))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over ``edges(a, b)``, for all nodes of edges but those.

    Two steps alternate until nothing changes: the larger neighbours of a node
    are linked to the smallest of its neighbourhood, then its smaller ones to
    their smallest.  The rounds grow with the logarithm of the nodes.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    links = staged(links, "links")
    before = _signature(links)
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "large")
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        links = staged(small.where("u <> v").distinct(), "links")
        after = _signature(links)
        if after == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after


def _tokens(members: DataFrame, docs: DataFrame, shingle: int, broadcast_rows: int) -> DataFrame:
    """``rep, component, n, token``, one row per shingle of the texts of ``members(rep, component)``."""
    known = members.select(F.col("rep").alias("doc_id"), "component")
    known = F.broadcast(known) if known.count() <= broadcast_rows else known

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(2))
            sets = [shingle_set(data[a:b], shingle).view(np.int64) for a, b in zip(at[:-1], at[1:])]
            sizes = np.array([len(s) for s in sets], np.int64)
            row = pa.array(np.repeat(np.arange(len(sets)), sizes))
            columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(np.repeat(sizes, sizes))]
            token = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*columns, token], ["rep", "component", "n", "token"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "component", "text")
    return texts.mapInArrow(cut, f"rep {id_type}, component {id_type}, n long, token long").distinct()


def pairs_apart(
    members: DataFrame, docs: DataFrame, shingle: int, share: int, of: int, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Pairs ``(a, b)`` of different components that can be similar enough, among ``members(rep, component)``.

    The shingles of each text are put in one order for all texts: first those
    of one component only, which no such pair shares, then rare before
    frequent.  A pair of sizes ``n_a`` and ``n_b`` needs an overlap of
    ``share * (n_a + n_b) / (of + share)``, so that its first common shingle
    has at least as many behind it in both texts.  Pairs are only made at
    shingles for which this holds.  Texts that share a passage, or are copies
    of one original with many changes of their own, make none.
    """
    tokens = staged(_tokens(members, docs, shingle, broadcast_rows), "tokens")
    shared = tokens.groupBy("token").agg(
        F.count("*").alias("texts"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    common = tokens.join(shared.where("least <> most").select("token", "texts"), "token")
    of_text = Window.partitionBy("rep")
    behind = F.count("*").over(of_text) - F.row_number().over(of_text.orderBy("texts", "token")) + 1
    early = common.withColumn("behind", behind).where(of * F.col("behind") >= share * F.col("n"))
    early = staged(early.select("token", "rep", "component", "n", "behind"), "early")
    sizes = early.groupBy("token", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("parts"))
    largest = largest.where("parts > 1").select("token", F.col("top.component").alias("largest"))
    mixed_up = staged(early.join(largest, "token"), "mixed")
    names = ("rep", "component", "n", "behind")
    a = mixed_up.where("component <> largest").select("token", *(F.col(c).alias(f"a_{c}") for c in names))
    b = mixed_up.select("token", "largest", *(F.col(c).alias(f"b_{c}") for c in names))
    needed = share * (F.col("a_n") + F.col("b_n"))
    pairs = a.join(
        b,
        (a.token == b.token)
        & (F.col("a_component") != F.col("b_component"))
        & ((F.col("b_component") == F.col("largest")) | (F.col("a_rep") < F.col("b_rep")))
        & ((of + share) * F.col("a_behind") >= needed)
        & ((of + share) * F.col("b_behind") >= needed)
        & (of * F.least("a_n", "b_n") >= share * F.greatest("a_n", "b_n")),
    )
    return pairs.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b")).distinct()


def near_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    share: int = SIMILAR,
    of: int = OF,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``.

    Texts are linked when the Jaccard similarity of their sets of shingles is
    at least ``share / of``.  ``component_id`` is the smallest id reachable
    over links, the own one included.  Null texts and texts without words have
    no shingles and are linked with nothing.  ``doc_id`` identifies a row; rows
    repeated with one id share its result.  A row without an id links nothing;
    it gets the component of the texts with its set of shingles, if any, and a
    null ``kept``.  Other columns are ignored; an empty table gives an empty one.
    """
    rows_of = staged(sketched(docs, shingle, bands, rows), "sketches")
    some = rows_of.where("n_shingles > 0")
    same_set = ["set_a", "set_b", "n_shingles"]
    classes = staged(some.groupBy(*same_set).agg(F.min("doc_id").alias("rep")), "classes")
    firsts = some.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    banded = firsts.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(
        F.min("rep").alias("leader"), F.max("rep").alias("most"), F.min_by("n", "rep").alias("leader_n")
    )
    bucketed = staged(banded.join(shared.where("leader <> most").drop("most"), "key"), "bands")
    may = (of * F.least("n", "leader_n")) >= (share * F.greatest("n", "leader_n"))
    first = bucketed.where((F.col("rep") != F.col("leader")) & may).groupBy("rep").agg(F.min("leader").alias("a"))
    pairs = staged(first.select("a", F.col("rep").alias("b")), "pairs")
    links = staged(verified(pairs, docs, shingle, share, of, broadcast_rows), "links")

    found = components(links)
    placed = bucketed.join(found, bucketed.rep == found.node, "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    placed = staged(placed, "placed")
    apart = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    apart = placed.join(apart.where("least <> most").select("key"), "key").select("rep", "component").distinct()
    more = pairs_apart(staged(apart, "apart"), docs, shingle, share, of, broadcast_rows)
    more = staged(more.join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        links = links.unionAll(staged(verified(more, docs, shingle, share, of, broadcast_rows), "links"))
        found = components(links)

    of_class = classes.join(found, classes.rep == found.node, "left").select(
        *same_set, F.coalesce("component", "rep").alias("component_id")
    )
    placed_rows = some.select("doc_id", *same_set).join(of_class, same_set).select("doc_id", "n_shingles", "component_id")
    empty = rows_of.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed_rows.unionAll(empty).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def first_of_similar(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of the smallest id of each component of similar texts, all columns kept.

    Rows of one id are one document and stay or go together; a row without an
    id, and one without words, is linked with nothing and stays.  An empty
    table stays empty, and no column of ``docs`` clashes.  Texts are shuffled
    only when more than ``broadcast_rows`` ids go.
    """
    dropped = near_groups(docs, broadcast_rows=broadcast_rows).where("NOT kept").select("doc_id")
    return rows_without(docs, dropped, {"doc_id": docs["doc_id"]}, broadcast_rows)
