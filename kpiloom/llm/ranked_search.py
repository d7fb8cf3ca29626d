"""Ranked lexical search by pipelined term partitioning.

Terms belong to owners, the rarest to the first one.  A bundle carries a group
of items with a sparse accumulator per document through the owners one after
the other: each owner cogroups the bundles that reach it with its postings, adds
its integer contributions and passes the bundles on.  What leaves the last owner
holds full scores, from which the best documents are selected.

Documents are dealt to blocks of bounded size where their texts are read, and a
bundle belongs to one block, so that neither a very common term nor an item that
matches everything makes a group larger than a block.  An accumulator is dropped
only when the documents ahead of it in its block stay ahead whatever the owners
still to come may add, so the selection is exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import staged, utf8

BEST = 10
# Documents of a block, and the postings it is closed at.
BLOCK_DOCUMENTS, BLOCK_POSTINGS = 2048, 2_000_000
# Items of a bundle, on average.
BUNDLE_ITEMS = 256
# Owners hold terms by the share of documents that have them; the last one holds the rest.
OWNER_SHARES = (0.001, 0.01, 0.1)
# Terms of items up to this many bytes are sent to the tasks that read texts, so that those keep no others.
VOCABULARY_BYTES = 32 * 2**20
# Bytes of a text that are split into terms at a time.
SLICE = 2**20

_NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a slice at a time; only A-Z are lower-cased."""
    start = 0
    while start < len(text):
        end = start + SLICE
        if end < len(text):
            cut = _BREAK.search(text, end)
            end = cut.start() if cut else len(text)
        yield _TERM.findall(text[start:end].lower())
        start = end


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, n``: how often a term occurs in an item; equal rows of an item count once, different ones together."""
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    split = items.select("item_id", "text").distinct().select("item_id", F.explode(F.split(lower, _NOT_TERM + "+")).alias("term"))
    return split.where("term <> ''").groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n"))


def blocks_of(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Blocks of documents and their postings, stored.

    A block has one row without a term, with its documents, their numbers of
    terms, and how many terms and documents with any it has; and one row per
    term with the places of the documents that hold it, the occurrences, and
    the largest number of occurrences and smallest number of terms among them.
    """
    spark = docs.sparkSession
    size = vocabulary.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    wanted = frozenset(row["term"].encode() for row in vocabulary.collect()) if size <= VOCABULARY_BYTES else None
    held = spark.sparkContext.broadcast(wanted)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, number = held.value, TaskContext.get().partitionId(), 0
        ids: list = []
        sizes: list[int] = []
        found: dict[bytes, tuple[list[int], list[int]]] = {}
        postings, id_arrow = 0, pa.int64()

        def closed() -> pa.RecordBatch:
            length = np.array(sizes, np.int64)
            names = [None, *found]
            places = [list(range(len(ids))), *[place for place, _ in found.values()]]
            counts = [sizes, *[count for _, count in found.values()]]
            columns = {
                "block": pa.array(np.full(len(names), part * 2**32 + number)),
                "term": pa.array([None, *[name.decode() for name in found]], pa.string()),
                "places": pa.array(places, pa.list_(pa.int32())),
                "counts": pa.array(counts, pa.list_(pa.int64())),
                "most": pa.array([None, *[max(count) for _, count in found.values()]], pa.int64()),
                "shortest": pa.array([None, *[int(length[place].min()) for place, _ in found.values()]], pa.int64()),
                "n": pa.array([int((length > 0).sum()), *[len(place) for place, _ in found.values()]], pa.int64()),
                "total": pa.array([int(length.sum()), *[None] * len(found)], pa.int64()),
                "ids": pa.array([ids, *[None] * len(found)], pa.list_(id_arrow)),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            id_arrow = batch.column(0).type
            data, offsets = utf8(batch.column(1))
            for doc_id, start, end in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                count: Counter = Counter()
                n = 0
                for words in terms_of(data[start:end].tobytes()):
                    n += len(words)
                    count.update(words if known is None else filter(known.__contains__, words))
                place = len(ids)
                ids.append(doc_id)
                sizes.append(n)
                for term, times in count.items():
                    at = found.get(term)
                    if at is None:
                        at = found[term] = ([], [])
                    at[0].append(place)
                    at[1].append(times)
                postings += len(count)
                if len(ids) >= BLOCK_DOCUMENTS or postings >= BLOCK_POSTINGS:
                    yield closed()
                    ids, sizes, found, postings, number = [], [], {}, 0, number + 1
        if ids:
            yield closed()

    schema = (
        "block long, term string, places array<int>, counts array<long>, most long, shortest long, n long, total long, "
        f"ids array<{id_type}>"
    )
    return staged(docs.select("doc_id", "text").mapInArrow(work, schema), "search-blocks")


def impact(times: np.ndarray, measure: np.ndarray) -> np.ndarray:
    """What a term adds to the scores of documents per unit of weight."""
    return (1_000_000_000 * times) // (1000 * times + 8 * measure)


def _lists(table: pa.Table, name: str) -> list[np.ndarray]:
    """A list column as one array per row."""
    column = table.column(name).combine_chunks()
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[start:end] for start, end in zip(ends[:-1], ends[1:])]


def _weighted(asked: DataFrame, postings: DataFrame, documents: int, terms: int) -> DataFrame:
    """``bundle, item, item_id, term, owner, weight, gain``: terms of items with what they weigh and can add at most."""
    own = asked.select("term").distinct()
    least = F.expr(f"25L + (75L * shortest * {documents}L) div {terms}L")
    gain = F.expr("(1000000000L * most) div (1000L * most + 8L * least)")
    of_terms = postings.join(own, "term", "left_semi").withColumn("least", least).groupBy("term")
    of_terms = of_terms.agg(F.sum("n").alias("df"), F.max(gain).alias("gain"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    owner = sum(((F.col("df") > share * documents).cast("int") for share in OWNER_SHARES), F.lit(0))
    of_terms = of_terms.select("term", weight.alias("weight"), owner.alias("owner"), "gain").where("weight > 0")
    bundles = max(1, -(-asked.select("item_id").distinct().count() // BUNDLE_ITEMS))
    bundle = F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(bundles)).cast("int")
    found = asked.join(of_terms, "term").withColumn("bundle", bundle).withColumn("weight", F.col("weight") * F.col("n"))
    item = F.dense_rank().over(Window.partitionBy("bundle").orderBy("item_id")) - 1
    return staged(
        found.select("bundle", item.alias("item"), "item_id", "term", "owner", "weight", (F.col("weight") * F.col("gain")).alias("gain")),
        "search-weights",
    )


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item of ``items(item_id, text)``.

    Every row of ``docs(doc_id, text)`` is a document, so a repeated row is
    ranked twice; equal scores go by ascending ``doc_id``, rows without one
    last.  Rows of one item are one item: equal ones count once, the terms of
    different ones together; rows without an id are one item too.  Null and
    empty texts have no terms: such a document is never found, such an item
    finds nothing.  Other columns are ignored; an empty table gives no rows.  A
    very long text is split a slice at a time; its memory is that of its
    different terms.  Collected are the items' terms below `VOCABULARY_BYTES`
    and two totals.
    """
    spark = docs.sparkSession
    item_type, id_type = (df.schema[name].dataType.simpleString() for df, name in ((items, "item_id"), (docs, "doc_id")))
    asked = staged(item_terms(items), "search-items")
    blocks = blocks_of(docs, asked.select("term").distinct())
    heads, postings = blocks.where("term IS NULL"), blocks.where("term IS NOT NULL")
    documents, terms = heads.agg(F.sum("n"), F.sum("total")).first()
    if not documents:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    weighted = _weighted(asked, postings, documents, terms)

    # What an owner holds: its postings, with the items of each bundle that ask for them.
    asking = weighted.groupBy("bundle", "owner", "term").agg(F.sort_array(F.collect_list(F.struct("item", "weight"))).alias("asked"))
    owned = asking.join(postings.select("block", "term", "places", "counts"), "term").select(
        "bundle", "block", "owner", "places", "counts", F.col("asked.item").alias("items"), F.col("asked.weight").alias("weights")
    )
    owned = staged(owned, "search-postings")

    # A bundle per block in which any of its items has a term, without accumulators yet.
    gains = [F.sum(F.when(F.col("owner") == k, F.col("gain")).otherwise(0)) for k in range(len(OWNER_SHARES) + 1)]
    of_items = weighted.groupBy("bundle", "item", "item_id").agg(F.array(*gains).alias("gain"))
    of_items = of_items.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("item", "item_id", "gain"))).alias("all"))
    of_items = of_items.select("bundle", F.col("all.item_id").alias("item_ids"), F.flatten("all.gain").alias("gains"))
    none, places = F.array().cast("array<long>"), F.array().cast("array<int>")
    bundles = (
        owned.select("bundle", "block").distinct()
        .join(of_items, "bundle")
        .join(heads.select("block", "ids", F.col("counts").alias("sizes")), "block")
        .select("bundle", "block", "item_ids", "gains", "ids", "sizes",
                places.alias("at_item"), places.alias("at_place"), none.alias("scores"))
    )
    for owner in range(len(OWNER_SHARES) + 1):
        step = _owner_step(owner, documents, terms, best)
        here = owned.where(F.col("owner") == owner).withColumnsRenamed({"bundle": "of_bundle", "block": "of_block"}).drop("owner")
        reached = bundles.groupBy("bundle", "block").cogroup(here.groupBy("of_bundle", "of_block"))
        bundles = reached.applyInArrow(step, bundles.schema)

    select = _selection(best)
    found = bundles.select("item_ids", "ids", "at_item", "at_place", "scores").mapInArrow(
        select, f"item_id {item_type}, doc_id {id_type}, score long"
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score").where(F.col("rank") <= best)


def _owner_step(owner: int, documents: int, terms: int, best: int):
    """An owner's work on a bundle: its contributions added, and what cannot be among the best dropped."""

    def step(bundle: pa.Table, held: pa.Table) -> pa.Table:
        if not bundle.num_rows or not held.num_rows:
            return bundle
        (sizes,), (gains,) = _lists(bundle, "sizes"), _lists(bundle, "gains")
        gains = gains.reshape(-1, len(OWNER_SHARES) + 1)
        scores = np.zeros((len(gains), len(sizes)), np.int64)
        (at_item,), (at_place,), (carried,) = (_lists(bundle, name) for name in ("at_item", "at_place", "scores"))
        scores[at_item, at_place] = carried
        measure = 25 + (75 * sizes * documents) // terms
        for places, counts, items, weights in zip(*(_lists(held, name) for name in ("places", "counts", "items", "weights"))):
            scores[items[:, None], places] += weights[:, None] * impact(counts, measure[places])
        kept = scores > 0
        if len(sizes) > best:
            # What the best of the block have already, less what an accumulator may still gain.
            reached = np.partition(scores, len(sizes) - best, axis=1)[:, len(sizes) - best]
            kept &= scores >= (reached - gains[:, owner + 1 :].sum(axis=1))[:, None]
        at_item, at_place = np.nonzero(kept)
        changed = {
            "at_item": pa.array([at_item.astype(np.int32)], pa.list_(pa.int32())),
            "at_place": pa.array([at_place.astype(np.int32)], pa.list_(pa.int32())),
            "scores": pa.array([scores[at_item, at_place]], pa.list_(pa.int64())),
        }
        for name, column in changed.items():
            bundle = bundle.set_column(bundle.schema.get_field_index(name), name, column)
        return bundle

    return step


def _selection(best: int):
    """The best documents of each item of a bundle, equal scores by id."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = row["ids"]
                order = np.empty(len(ids), np.int64)
                order[sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k]))] = np.arange(len(ids))
                at_item, at_place, scores = (np.array(row[name], np.int64) for name in ("at_item", "at_place", "scores"))
                sorted_rows = np.lexsort((order[at_place], -scores, at_item))
                at_item, at_place, scores = at_item[sorted_rows], at_place[sorted_rows], scores[sorted_rows]
                first = np.searchsorted(at_item, at_item)
                top = np.arange(len(at_item)) - first < best
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["item_ids"][k] for k in at_item[top]], batch.schema.field("item_ids").type.value_type),
                        pa.array([ids[k] for k in at_place[top]], batch.schema.field("ids").type.value_type),
                        pa.array(scores[top]),
                    ],
                    ["item_id", "doc_id", "score"],
                )

    return select
