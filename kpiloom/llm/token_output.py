"""Packed token-id matrices: best-fit decreasing with a segment tree over capacities.

Each task packs its own documents, a bounded group at a time, so nothing is
shuffled.  Sequences with room left stay open for the groups that follow.
Overlong documents are cut into pieces without losing a token.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark import TaskContext
from pyspark.sql import DataFrame

from kpiloom.llm.common import texts
from kpiloom.llm.encoding import cut_points, text_encoder

CAPACITY = 2048
# Tokens packed together, 4 bytes each.
GROUP_TOKENS = 2_000_000
# Sequences a task keeps open from group to group, 8 KB each at most; beyond it the fullest are closed.
OPEN_SEQUENCES = 4096
PAD_ID = 0


class CapacityTree:
    """Open sequences by free room; finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.counts[node] += change
            node >>= 1

    def put(self, room: int, number: int) -> None:
        self.open[room].append(number)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Room and number of the fullest sequence with room for ``size``."""
        node = self.leaves + size
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.counts[node]
        room = node - self.leaves
        self._add(room, -1)
        return room, self.open[room].pop()


class Packer:
    """Best-fit decreasing over groups of pieces; open sequences are carried from group to group."""

    def __init__(self, capacity: int, open_limit: int = OPEN_SEQUENCES):
        self.capacity, self.open_limit = capacity, open_limit
        self.tree = CapacityTree(capacity)
        self.members: dict[int, list] = {}
        self.started = 0

    def add(self, pieces: list, lengths: list[int]) -> list[list]:
        """Places pieces, longest first, each where it leaves least room; returns the sequences that are closed."""
        closed = []
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            room, number = self.tree.take(lengths[k]) or (self.capacity, self.started)
            if number == self.started:
                self.members[number] = []
                self.started += 1
            self.members[number].append(pieces[k])
            if room > lengths[k]:
                self.tree.put(room - lengths[k], number)
            else:
                closed.append(self.members.pop(number))
        return closed + self.close(self.open_limit)

    def close(self, left: int = 0) -> list[list]:
        """Closes the fullest sequences until at most ``left`` are open."""
        closed = []
        while len(self.members) > left:
            closed.append(self.members.pop(self.tree.take(1)[1]))
        return closed


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each sequence, longest pieces placed first, each where it leaves least room."""
    packer = Packer(capacity)
    return packer.add(list(range(len(lengths))), lengths) + packer.close()


class Piece(NamedTuple):
    """A document's piece: its number, the document's ids before it, and its ids."""

    doc_id: object
    number: int
    start: int
    ids: np.ndarray


def position_type(capacity: int) -> str:
    """Little-endian unsigned numbers for positions below ``capacity``: 16 bits where they are enough."""
    return "<u2" if capacity <= 1 << 16 else "<u4"


def packed_matrices(
    docs: DataFrame,
    tokenizer: tuple,
    capacity: int = CAPACITY,
    end_id: int = 0,
    group_tokens: int = GROUP_TOKENS,
    open_sequences: int = OPEN_SEQUENCES,
) -> DataFrame:
    """All rows of ``docs(doc_id, text)`` as packed rows of token ids, one row per sequence.

    * ``sequence_id``: task number and running number,
    * ``ids``: ``capacity`` little-endian unsigned 32-bit ids, padded,
    * ``cu_seqlens``: cumulative segment lengths, starting with 0,
    * ``position_ids``: ``capacity`` little-endian positions of `position_type`,
      which restart from 0 at each segment and are 0 in the padding,
    * ``doc_ids``, ``pieces``, ``starts``: each segment's document, number of
      the piece, and ids of the document before it.

    A document is its ids and then ``end_id``; a null text is empty.  Joining
    the segments of a document in order of ``pieces`` gives its ids back.
    Repeated rows are packed once each, other columns are ignored, and an
    empty table gives an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(*tokenizer)
        packer = Packer(capacity, open_sequences)
        number = TaskContext.get().partitionId() << 40
        held: list[Piece] = []
        tokens = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                ids = np.append(encoder.ids(text), np.uint32(end_id))
                cuts = cut_points(len(ids), capacity)
                held += [Piece(doc_id, k, start, ids[start : start + n]) for k, (start, n) in enumerate(cuts)]
                tokens += len(ids)
                if tokens >= group_tokens:
                    closed = packer.add(held, [len(piece.ids) for piece in held])
                    held, tokens = [], 0
                    yield from _rows(closed, capacity, number, batch.schema.field(0).type)
                    number += len(closed)
            id_type = batch.schema.field(0).type
        closed = packer.add(held, [len(piece.ids) for piece in held]) + packer.close()
        if closed:
            yield from _rows(closed, capacity, number, id_type)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = "sequence_id long, ids binary, cu_seqlens array<int>, position_ids binary"
    return docs.select("doc_id", "text").mapInArrow(
        work, f"{schema}, doc_ids array<{id_type}>, pieces array<int>, starts array<long>"
    )


def _rows(sequences: list[list[Piece]], capacity: int, first: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(sequences), 500):
        part = sequences[at : at + 500]
        matrix = np.full((len(part), capacity), PAD_ID, "<u4")
        positions = np.zeros((len(part), capacity), position_type(capacity))
        counted = np.arange(capacity, dtype=positions.dtype)
        ends = []
        for row, places, members in zip(matrix, positions, part):
            end = [0]
            for piece in members:
                a, b = end[-1], end[-1] + len(piece.ids)
                row[a:b], places[a:b] = piece.ids, counted[: b - a]
                end.append(b)
            ends.append(end)
        columns = [
            pa.array(range(first + at, first + at + len(part)), pa.int64()),
            pa.array([row.tobytes() for row in matrix], pa.binary()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([row.tobytes() for row in positions], pa.binary()),
            pa.array([[piece.doc_id for piece in members] for members in part], pa.list_(id_type)),
            pa.array([[piece.number for piece in members] for members in part], pa.list_(pa.int32())),
            pa.array([[piece.start for piece in members] for members in part], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(
            columns, ["sequence_id", "ids", "cu_seqlens", "position_ids", "doc_ids", "pieces", "starts"]
        )


def write_matrices(packed: DataFrame, path: str) -> None:
    """Writes packed rows as Parquet; `matrices` reads them without Spark."""
    packed.write.parquet(path)


class Matrices(NamedTuple):
    """A block of sequences: ids and positions, one row each, and the segments of all rows on end.

    ``cu_seqlens`` counts through the block: row ``r`` starts at ``r * capacity``,
    and its padding is a segment of its own.
    """

    ids: np.ndarray
    position_ids: np.ndarray
    cu_seqlens: np.ndarray


def matrices(path: str, rows: int = 64, capacity: int = CAPACITY) -> Iterator[Matrices]:
    """The written rows in blocks of at most ``rows``, as numpy matrices for a training loop."""
    scanned = ds.dataset(path, format="parquet").to_batches(columns=["ids", "position_ids", "cu_seqlens"], batch_size=rows)
    for batch in scanned:
        if not batch.num_rows:
            continue
        ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").reshape(-1, capacity)
        positions = np.frombuffer(b"".join(batch.column(1).to_pylist()), position_type(capacity)).reshape(-1, capacity)
        ends = [
            np.array(end if end[-1] == capacity else [*end, capacity])[:-1] + r * capacity
            for r, end in enumerate(batch.column(2).to_pylist())
        ]
        yield Matrices(ids, positions, np.concatenate([*ends, [len(ids) * capacity]]))
