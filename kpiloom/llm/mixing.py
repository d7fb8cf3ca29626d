"""Mixing sources to target weights.

The words of a source, document after document, are cut into blocks of fixed
length.  An output consists of shards; how many blocks of each source a shard
holds is drawn by a multinomial, given how many blocks of the source the whole
output holds.  The draws of a source are numbered through all shards, and a
draw's number is mapped by a pseudorandom permutation of the source's blocks to
the block it stands for, so that every block is used once before any is used
again.  Draws and blocks meet in a join by source and block.

Nothing depends on how the tables are stored or on the order of tasks: the order
of documents, the draws and the permutations come from hashes and seeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import mixed, staged
from kpiloom.operators.running import before

SHARE, MOST = 1.5, 2
WEIGHTS = (5, 2, 1)
# Words of a block, and blocks of an output shard on average.
BLOCK_WORDS, SHARD_BLOCKS = 512, 1024
# Shards, or groups of shards, that one multinomial deals to at most.
FAN = 1024
# Documents of one running sum of sizes, on average.
BUCKET_DOCUMENTS = 1000
SEED = 20_240_229
ROUNDS = 4
# Draws or copies that one step expands.
EXPANDED = 100_000

_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place by code point, null last, as ``place`` from 0.

    Places come from a range sort and the counts of its parts, so a long list
    of sources passes through no single task.
    """
    ordered = sources.orderBy(F.asc_nulls_last("source")).withColumn("_id", F.monotonically_increasing_id())
    ordered = staged(ordered, "mix-sources")
    part, within = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    counts = sorted((row["part"], row["n"]) for row in ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    ahead, total = [], 0
    for number, n in counts:
        ahead.append((number, total))
        total += n
    starts = sources.sparkSession.createDataFrame(ahead, "_part long, _before long")
    placed = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.withColumn("place", F.col("_before") + within).drop("_part", "_before", "_id")


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, place, target`` of ``sources(source, source_size)``.

    The sources share ``share`` times all sizes by weight; a target stops at
    ``most`` times its source's size, and what is left over is shared again by
    weight until none is above.  Each round is one aggregation over the
    sources; there are as many as sources stop one after the other, mostly few.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = staged(
        _ranked(sources).withColumn("weight", weight).withColumn("most", F.lit(float(most)) * F.col("source_size")), "mix-ranked"
    )
    budget = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        above = F.col("most") <= F.lit(level) * F.col("weight")
        full, n_full, free = ranked.agg(
            F.sum(F.when(above, F.col("most"))), F.count_if(above), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n_full == stopped or not free:
            break
        stopped, level = n_full, (budget - (full or 0.0)) / free
    target = F.least(F.col("most"), F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", "place", target.alias("target"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, *, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0 … ``size`` - 1 applied to ``index``, or undone.

    A balanced Feistel network on the fewest pairs of bits that hold ``size``;
    values beyond it are mapped again until they fall inside.
    """
    index, size, key = (a.astype(np.uint64) for a in np.broadcast_arrays(index, size, key))
    half = np.ones(size.shape, np.uint64)
    while (short := size > np.uint64(1) << (half * np.uint64(2))).any():
        half += short.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [mixed(key * np.uint64(ROUNDS) + np.uint64(SEED + k)) for k in range(ROUNDS)]
    outside = np.arange(len(index))
    while len(outside):
        bits, low = half[outside], mask[outside]
        left, right = index[outside] >> bits, index[outside] & low
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (mixed(left ^ k[outside]) & low), left
            else:
                left, right = right, left ^ (mixed(right ^ k[outside]) & low)
        index[outside] = left << bits | right
        outside = outside[index[outside] >= size[outside]]
    return index.astype(np.int64)


def draws_needed(total: int, target: int, key: int, block: int = BLOCK_WORDS) -> tuple[int, int]:
    """Draws that a source of ``total`` words needs for ``target`` words, and the words of the last draw that are not used.

    Only the last block of a source is shorter; where its draw comes in a pass
    is known from the permutation undone.
    """
    blocks = -(-total // block)
    if not target or not blocks:
        return 0, 0
    passes, rest = divmod(target, total)
    if not rest:
        return passes * blocks, 0
    missing = blocks * block - total
    short_at = int(permuted(np.array([blocks - 1]), np.array([blocks]), np.array([key]), back=True)[0])
    draws = -(-rest // block)
    if draws > short_at:
        draws = max(short_at + 1, -(-(rest + missing) // block))
    words = draws * block - (missing if draws > short_at else 0)
    return passes * blocks + draws, words - rest


def _with_draws(sources: DataFrame) -> DataFrame:
    """Sources with their blocks, the draws that fill their targets, and the words of the last draw that are not used."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, size, target = (batch.column(k).to_pylist() for k in range(3))
            needed = [draws_needed(n, int(t), k) for k, n, t in zip(place, size, target)]
            columns = [place, size, [-(-n // BLOCK_WORDS) for n in size], [n for n, _ in needed], [u for _, u in needed]]
            names = ["place", "source_size", "blocks", "draws", "unused"]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)

    schema = "place long, source_size long, blocks long, draws long, unused long"
    return sources.select("place", "source_size", "target").mapInArrow(work, schema)


def _dealt(sources: DataFrame, shards: int, fan: int) -> DataFrame:
    """How many draws of a source each shard holds, and the number of the first of them.

    Draws are dealt to groups of shards, of these to smaller groups, and so on,
    by one multinomial each, so that no task deals a large source to all shards.
    """
    kept = ["place", "source_size", "blocks", "draws", "unused"]

    def deal(width: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    starts = row["shard"] + np.arange(0, row["span"], width)
                    spans = np.minimum(width, row["shard"] + row["span"] - starts)
                    rng = np.random.default_rng([SEED, row["place"], row["shard"], width])
                    counts = rng.multinomial(row["n"], spans / spans.sum())
                    first = row["first"] + np.cumsum(counts) - counts
                    some = np.flatnonzero(counts)
                    same = {name: np.full(len(some), row[name], np.int64) for name in kept}
                    dealt = {"shard": starts[some], "span": spans[some], "first": first[some], "n": counts[some]}
                    yield pa.RecordBatch.from_pydict({name: pa.array(column) for name, column in {**same, **dealt}.items()})

        return work

    schema = ", ".join(f"{name} long" for name in [*kept, "shard", "span", "first", "n"])
    whole = {"shard": F.lit(0), "span": F.lit(shards), "first": F.lit(0), "n": F.col("draws")}
    dealt = sources.select(*kept, *[value.cast("long").alias(name) for name, value in whole.items()])
    widths = [1]
    while widths[-1] * fan < shards:
        widths.append(widths[-1] * fan)
    for k, width in enumerate(reversed(widths)):
        dealt = (dealt.repartition("place", "shard") if k else dealt).mapInArrow(deal(width), schema)
    return dealt


def _drawn(dealt: DataFrame) -> DataFrame:
    """``place, block, shard, draw, keep``: the block each draw stands for, and how many of its words are used."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for start in range(0, row["n"], EXPANDED):
                    draw = row["first"] + np.arange(start, min(row["n"], start + EXPANDED))
                    block = permuted(draw % row["blocks"], np.int64(row["blocks"]), np.int64(row["place"]))
                    keep = np.minimum(BLOCK_WORDS, row["source_size"] - block * BLOCK_WORDS)
                    keep -= np.where(draw == row["draws"] - 1, row["unused"], 0)
                    same = {name: np.full(len(draw), row[name], np.int64) for name in ("place", "shard")}
                    columns = {**same, "block": block, "draw": draw, "keep": keep}
                    yield pa.RecordBatch.from_pydict({name: pa.array(column) for name, column in columns.items()})

    return dealt.mapInArrow(work, "place long, shard long, block long, draw long, keep long")


def _placed(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, source, size, copies, start``: where the words of each different row begin in its source.

    Rows of a source are ordered by hash and id.
    """
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", "source", digest.alias("digest"), n_words(F.col("text")).alias("size"))
    rows = staged(rows.groupBy("doc_id", "source", "digest", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-sizes")
    buckets = max(1, -(-rows.count() // BUCKET_DOCUMENTS))
    bucket = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "digest"), F.lit(buckets))
    rows = rows.withColumn("bucket", bucket).withColumn("words", F.col("size") * F.col("copies"))
    found = before(rows, ["source"], "bucket", ["doc_id", "digest", "size"], "words", buckets, "start")
    return found.select("doc_id", "digest", "source", "size", "copies", "start")


@dataclass(frozen=True)
class Mix:
    """A mix of ``documents`` (doc_id, digest, source, size, source_size, place, target, start), one row each, by ``draws``."""

    documents: DataFrame
    draws: DataFrame

    def pieces(self) -> DataFrame:
        """``place, start, block, doc_id, digest, first, at, words``: the part of a document in each block it reaches into."""
        last = F.expr(f"(start + size - 1) div {BLOCK_WORDS}")
        block = F.explode(F.sequence(F.expr(f"start div {BLOCK_WORDS}"), last)).alias("block")
        cut = self.documents.where("size > 0").select("place", "start", "size", "doc_id", "digest", block)
        first = F.greatest(F.lit(0).cast("long"), F.col("block") * BLOCK_WORDS - F.col("start"))
        end = F.least(F.col("size"), (F.col("block") + 1) * BLOCK_WORDS - F.col("start"))
        at = F.greatest(F.lit(0).cast("long"), F.col("start") - F.col("block") * BLOCK_WORDS)
        return cut.select("place", "start", "block", "doc_id", "digest", first.alias("first"), at.alias("at"), (end - first).alias("words"))

    def mixed(self) -> DataFrame:
        """``shard, place, draw, at, start, doc_id, digest, first, words``: the used part of each document in each draw's block."""
        words = F.least(F.col("words"), F.col("keep") - F.col("at"))
        joined = self.pieces().join(self.draws, ["place", "block"]).withColumn("words", words).where("words > 0")
        return joined.select("shard", "place", "draw", "at", "start", "doc_id", "digest", "first", "words")

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken`` of every row: how many of its words the mix holds, repeats counted."""
        sums = self.mixed().groupBy(F.col("place").alias("of"), F.col("start").alias("from")).agg(F.sum("words").alias("taken"))
        # A document without words begins where the next one does.
        own = (F.col("place") == F.col("of")) & (F.col("start") == F.col("from")) & (F.col("size") > 0)
        joined = self.documents.join(sums, own, "left")
        return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def shards(self, docs: DataFrame) -> DataFrame:
        """``shard, slot, source, draw, text``: the blocks of every output shard in their order, with their words.

        Only here texts are shuffled, each word once per draw of its block.
        """
        texts = docs.select(F.col("doc_id").alias("of"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("with"), "text").distinct()
        words = F.regexp_extract_all("text", F.lit(f"({_WORD})"))
        same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("with"))
        cut = self.pieces().join(texts, same).withColumn("held", F.slice(words, (F.col("first") + 1).cast("int"), F.col("words").cast("int")))
        blocks = cut.join(self.draws, ["place", "block"])
        used = F.least(F.col("words"), F.col("keep") - F.col("at")).cast("int")
        parts = F.sort_array(F.collect_list(F.struct("at", F.array_join(F.slice("held", 1, used), " ").alias("text"))))
        whole = blocks.where(used > 0).groupBy("shard", "place", "draw").agg(F.array_join(parts["text"], " ").alias("text"))
        names = self.documents.select("place", "source").distinct()
        order = Window.partitionBy("shard").orderBy(F.xxhash64("place", "draw", F.lit(SEED)), "place", "draw")
        return whole.join(names, "place").select("shard", (F.row_number().over(order) - 1).alias("slot"), "source", "draw", "text")


def mix(docs: DataFrame, *, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS,
        shard_blocks: int = SHARD_BLOCKS, fan: int = FAN) -> Mix:
    """A mix of ``docs(doc_id, text, source)`` in which each source has its target of words.

    Rows without a source are a source of their own, weighed last; null and
    empty texts have no words and are never drawn.  A repeated row is a
    document of its own, as are rows of one id, or without one.  The mix
    depends on the rows only, not on their order or storage.  Other columns are
    ignored; an empty table gives an empty mix.  A document of any length is
    cut into its blocks as rows; reading its words takes its text once.
    """
    placed = staged(_placed(docs), "mix-places")
    sizes = placed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    wanted = staged(targets(sizes, share, most, weights), "mix-targets")
    sources = staged(_with_draws(wanted), "mix-draws")
    draws = sources.agg(F.sum("draws")).first()[0] or 0
    dealt = _dealt(sources, max(1, round(draws / shard_blocks)), fan)
    # Stored, as Spark would take them for as few as the sources and broadcast them.
    drawn = staged(_drawn(dealt.repartition("place", "shard")), "mix-drawn")
    known = wanted.withColumnRenamed("source", "of")
    rows = placed.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # One row per copy, its words behind those of the copy before; long lists of copies are made in steps.
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(EXPANDED).cast("long"))).alias("step")
    rows = rows.select("*", step)
    copy = F.explode(F.sequence("step", F.least(F.col("step") + EXPANDED, F.col("copies")) - 1)).alias("copy")
    rows = rows.select("*", copy).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    return Mix(rows.select("doc_id", "digest", "source", "size", "source_size", "place", "target", "start"), drawn)
