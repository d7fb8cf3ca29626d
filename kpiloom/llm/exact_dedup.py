"""Exact duplicates by composable polynomial fingerprints.

A text is normalised and cut into chunks.  The fingerprint of a chunk is a
polynomial of its bytes at a fixed point; that of a text follows from those of
its chunks, ``H(AB) = H(A) * base ** len(B) + H(B)``, so the chunks of a huge
text are rows of their own, hashed by many tasks and combined in a grouping.  Texts with equal fingerprints and lengths are
then compared with the first text of their group, chunk by chunk; a text that
differs falls into a group of its own texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import free_name, rows_without, staged, utf8

CHUNK = 1 << 16
# Longer normalised texts are hashed chunk by chunk, by many tasks.
LONG = 16 * CHUNK
# Chunks in one Arrow batch.
BATCH_CHUNKS = 64
PRIME = (1 << 31) - 1
BASES = (1_390_208_809, 918_273_645)
# Ids of copies that may be broadcast, 16 bytes each; beyond it the texts are shuffled by id.
BROADCAST_ROWS = 500_000

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def one_spaced(text: np.ndarray) -> np.ndarray:
    """The bytes of a text with each run of white space replaced by one space."""
    space = _IS_SPACE[text]
    if not space.any():
        return text
    keep = np.ones(len(text), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return np.where(space, np.uint8(32), text)[keep]


@lru_cache(maxsize=8)
def _powers(base: int, prime: int) -> np.ndarray:
    powers = np.ones(CHUNK, np.uint64)
    for i in range(1, CHUNK):
        powers[i] = int(powers[i - 1]) * base % prime
    return powers[::-1].copy()


def chunk_hash(chunk: np.ndarray, base: int, prime: int = PRIME) -> int:
    """The polynomial of one chunk; sums stay below 2 ** 56."""
    values = chunk.astype(np.uint64) + np.uint64(1)
    return int(np.dot(values, _powers(base, prime)[CHUNK - len(chunk) :])) % prime


def combined(parts: Iterable[tuple[int, int]], base: int, prime: int = PRIME) -> int:
    """The hash of a text from the hashes and lengths of its chunks, in order."""
    total = 0
    for value, length in parts:
        total = (total * pow(base, length, prime) + value) % prime
    return total


def fingerprint(text: np.ndarray, prime: int = PRIME) -> int:
    """Both polynomials of a normalised text in one number."""
    chunks = [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]
    first, second = (combined([(chunk_hash(c, base, prime), len(c)) for c in chunks], base, prime) for base in BASES)
    return first << 31 | second


def _hashed_or_cut(docs: DataFrame, prime: int, long_bytes: int) -> DataFrame:
    """One row with its fingerprint of every text of at most ``long_bytes``; of longer ones a row of each chunk.

    ``row`` numbers the rows of ``docs``.  Chunks have no fingerprint, and
    those of a text all carry what else is known of it.
    """
    names = ["row", "doc_id", "print", "n_bytes", "text_sha256", "chunk_no", "chunk"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            texts = [one_spaced(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            n_bytes = np.array([len(text) for text in texts], np.int64)
            common = pa.RecordBatch.from_arrays(
                [
                    pa.array(range(number, number + len(texts)), pa.int64()),
                    batch.column(0),
                    pa.array([fingerprint(t, prime) if len(t) <= long_bytes else None for t in texts], pa.int64()),
                    pa.array(n_bytes),
                    pa.array([hashlib.sha256(text).hexdigest() for text in texts], pa.string()),
                ],
                names[:5],
            )
            number += len(texts)
            short = common.filter(pa.array(n_bytes <= long_bytes))
            rest = [pa.nulls(len(short), pa.int64()), pa.nulls(len(short), pa.binary())]
            yield pa.RecordBatch.from_arrays([*short.columns, *rest], names)
            for k in np.flatnonzero(n_bytes > long_bytes).tolist():
                starts = range(0, len(texts[k]), CHUNK)
                for at in range(0, len(starts), BATCH_CHUNKS):
                    some = starts[at : at + BATCH_CHUNKS]
                    head = common.take(pa.array([k] * len(some), pa.int64()))
                    chunks = [texts[k][start : start + CHUNK].tobytes() for start in some]
                    numbers = pa.array(range(at, at + len(some)), pa.int64())
                    yield pa.RecordBatch.from_arrays([*head.columns, numbers, pa.array(chunks, pa.binary())], names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {id_type}, print long, n_bytes long, text_sha256 string, chunk_no long, chunk binary"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def _chunk_hashes(chunks: DataFrame, prime: int) -> DataFrame:
    """``row, chunk_no`` and, for each base, hash and shift ``base ** length`` of every chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(chunk, np.uint8) for chunk in batch.column(2).to_pylist()]
            values = [
                pa.array(value, pa.int64())
                for base in BASES
                for value in ([chunk_hash(part, base, prime) for part in parts], [pow(base, len(part), prime) for part in parts])
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *values], ["row", "chunk_no", "first", "by1", "second", "by2"])

    schema = "row long, chunk_no long, first long, by1 long, second long, by2 long"
    return chunks.select("row", "chunk_no", "chunk").mapInArrow(work, schema)


def fingerprints(docs: DataFrame, prime: int = PRIME, long_bytes: int = LONG) -> DataFrame:
    """``doc_id, print, n_bytes, text_sha256`` of the normalised text of every row.

    Texts up to ``long_bytes`` are hashed where they are.  The chunks of longer
    ones are dealt over all tasks, and their hashes, some bytes each, are
    combined by text.  What is returned is stored, so it may be read again.
    """
    columns = ["doc_id", "print", "n_bytes", "text_sha256"]
    stored = staged(_hashed_or_cut(docs, prime, long_bytes), "chunks")
    cut = stored.where("chunk_no IS NOT NULL")
    hashes = _chunk_hashes(cut.select("row", "chunk_no", "chunk").repartition("row", "chunk_no"), prime)
    parts = F.sort_array(F.collect_list(F.struct("chunk_no", "first", "by1", "second", "by2")))
    zero = F.struct(F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("second"))
    total = F.aggregate(
        parts,
        zero,
        lambda done, part: F.struct(
            ((done["first"] * part["by1"] + part["first"]) % prime).alias("first"),
            ((done["second"] * part["by2"] + part["second"]) % prime).alias("second"),
        ),
    )
    both = F.shiftleft(F.col("total.first"), 31).bitwiseOR(F.col("total.second"))
    long = hashes.groupBy("row").agg(total.alias("total")).select("row", both.alias("print"))
    heads = cut.where("chunk_no = 0").drop("print").join(long, "row").select(columns)
    return stored.where("chunk_no IS NULL").select(columns).unionAll(staged(heads, "fingerprints"))


def _chunks(docs: DataFrame, prime: int) -> DataFrame:
    """``keep, doc_id, print, chunk_no, chunk`` of the normalised texts of ``docs(keep, doc_id, print, text)`` that have that fingerprint."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(3))
            for i, own in enumerate(batch.column(2).to_pylist()):
                row = one_spaced(data[offsets[i] : offsets[i + 1]])
                if fingerprint(row, prime) != own:
                    continue
                parts = [row[k : k + CHUNK].tobytes() for k in range(0, len(row), CHUNK)]
                names = ["keep", "doc_id", "print"]
                same = pa.RecordBatch.from_arrays(batch.columns[:3], names).take(pa.array([i] * len(parts), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*same.columns, pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())],
                    [*names, "chunk_no", "chunk"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"keep {id_type}, doc_id {id_type}, print long, chunk_no long, chunk binary")


def different_copies(docs: DataFrame, prints: DataFrame, broadcast_rows: int = BROADCAST_ROWS, prime: int = PRIME) -> DataFrame:
    """``doc_id, print`` of texts that differ from the first text of their fingerprint.

    Only texts of groups of two and more are compared, each chunk with the
    same chunk of the first text.  A hot group is split by the join.
    """
    groups = prints.groupBy("print", "n_bytes").agg(F.min("doc_id").alias("keep"), F.count("*").alias("n"))
    ids = prints.join(groups.where("n > 1"), ["print", "n_bytes"]).select("doc_id", "keep", "print").distinct()
    ids = staged(ids, "copies")
    if ids.count() <= broadcast_rows:
        ids = F.broadcast(ids)
    copies = docs.select("doc_id", "text").join(ids, "doc_id").select("keep", "doc_id", "print", "text")
    first = _chunks(copies.where("doc_id = keep"), prime).select("keep", "print", "chunk_no", F.col("chunk").alias("first_chunk"))
    rest = _chunks(copies.where("doc_id <> keep"), prime)
    return rest.join(first, ["keep", "print", "chunk_no"]).where("chunk <> first_chunk").select("doc_id", "print").distinct()


def exact_groups(
    docs: DataFrame, prime: int = PRIME, broadcast_rows: int = BROADCAST_ROWS, long_bytes: int = LONG
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs(doc_id, text)``.

    Texts are equal when identical after each run of white space is replaced
    by one space; null counts as empty, and all empty texts are one group.
    The row with the smallest id stays.  Rows repeated with the same id and
    text count in ``group_size`` and share ``kept``; rows of one id with
    different texts belong to the groups of their texts.  A row without an id counts in ``group_size`` and has a null
    ``kept``.  Other columns are ignored; an empty table gives an empty one.
    A text longer than ``long_bytes`` is stored once more, in chunks that many
    tasks hash; only its white space and SHA-256 are one task's work.
    """
    prints = fingerprints(docs, prime, long_bytes)
    different = different_copies(docs, prints, broadcast_rows, prime).withColumn("differs", F.lit(True))
    marked = prints.join(different, ["doc_id", "print"], "left").withColumn(
        "own", F.when(F.col("differs"), F.col("text_sha256")).otherwise("")
    )
    marked = staged(marked.drop("differs"), "compared")
    key = ["print", "n_bytes", "own"]
    groups = marked.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return marked.join(groups, key).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256"
    )


def first_of_equal(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row of each group of equal texts, all columns kept: the one with the smallest id.

    Rows are decided by id and text, so that of rows repeated with one id and
    text one stays, and rows of one id with different texts are decided apart.
    A row without an id stays only if no row with an id has its text, and then
    one of them.  Null and empty texts are one group.  An empty table stays
    empty, and no column of ``docs`` clashes.  A text costs its hash where it
    is; only texts of repeated rows are shuffled, and all texts when more
    than ``broadcast_rows`` rows go.
    """
    groups = exact_groups(docs, broadcast_rows=broadcast_rows)
    decided = groups.select(
        "doc_id", F.xxhash64("text_sha256").alias("print"), F.coalesce("kept", F.col("keep_id").isNull()).alias("kept")
    )
    decided = decided.groupBy("doc_id", "print").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    decided = staged(decided.where("NOT kept OR n > 1"), "decided")
    plain = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    name = free_name(docs, "print")
    printed = docs.withColumn(name, F.xxhash64(F.sha2(plain.cast("binary"), 256)))
    keys = {"doc_id": printed["doc_id"], "print": F.col(name)}
    repeated = decided.where("kept")
    once = rows_without(printed, decided, keys, broadcast_rows)
    if not repeated.isEmpty():
        theirs = {key: free_name(printed, f"repeated_{key}") for key in keys}
        pairs = repeated.select(*[F.col(key).alias(new) for key, new in theirs.items()])
        same = keys["doc_id"].eqNullSafe(F.col(theirs["doc_id"])) & (keys["print"] == F.col(theirs["print"]))
        once = once.unionAll(printed.join(pairs, same, "left_semi").dropDuplicates(["doc_id", name]))
    return once.select(*[once[column] for column in docs.columns])
