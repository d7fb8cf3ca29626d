"""Packing into as few sequences as possible, by a linear program over configurations.

Documents only matter by length, so the problem is a histogram of at most
``capacity`` entries.  A configuration is a multiset of lengths that fits one
sequence.  The covering program over all configurations is solved by
multiplicative weights: lengths weigh less the more they are covered, and a
knapsack by dynamic programming finds the configurations worth most at these
weights.  The solution is rounded down to the sequences that it fills, what
remains is solved once more, and the rest is packed best-fit decreasing.

The plan is a short table of configurations and how often each is used.
Pieces are numbered within their length by counts per task, so no task sees
all pieces of a length, and each finds its sequence and place from the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import staged, texts
from kpiloom.llm.encoding import cut_points, text_encoder

CAPACITY = 2048
END_ID = 0
ROUNDS = 400
CONFIGS_PER_ROUND = 32
STEP = 0.34
STEEPNESS = 3.0
# Times the program is solved and rounded to full sequences; the rest is packed best-fit decreasing.
SOLVES = 2
# Shares of the solution that are rounded down; the first without anything held back is solved again.
SHARES = (1, 0.95, 0.8, 0.5)
_RANK_BITS = 44


def knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The best total price for every capacity, and the length chosen last (0: one unit stays empty)."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for size in range(1, capacity + 1):
        best[size] = best[size - 1]
        if usable[size]:
            fit = lengths[: usable[size]]
            total = best[size - fit] + price[: len(fit)]
            k = int(total.argmax())
            if total[k] > best[size]:
                best[size], last[size] = total[k], fit[k]
    return best, last


def _configuration(first: int, last: np.ndarray, left: Counter, capacity: int) -> tuple[tuple[int, int], ...]:
    """The best configuration with ``first`` in it, no length more often than ``left`` has it."""
    chosen = Counter({first: 1})
    room = capacity - first
    while room > 0:
        length = int(last[room])
        if not length:
            room -= 1
        elif chosen[length] < left[length]:
            chosen[length] += 1
            room -= length
        else:
            room -= 1
    return tuple(sorted(chosen.items(), reverse=True))


def solve(histogram: Counter, capacity: int) -> dict[tuple, float]:
    """Configurations and their fractional use, every length covered once."""
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[n] for n in lengths], float)
    at = {int(n): k for k, n in enumerate(lengths)}
    cover = np.zeros(len(lengths))
    use: dict[tuple, float] = {}
    for _ in range(ROUNDS):
        _, last = knapsack(lengths * np.exp(-STEEPNESS * cover), lengths, capacity)
        for k in np.argsort(cover - 1e-6 * lengths, kind="stable")[:CONFIGS_PER_ROUND]:
            if cover[k] >= 1:
                break
            config = _configuration(int(lengths[k]), last, histogram, capacity)
            step = min(demand[at[n]] / c for n, c in config)
            step = min(step, max(1.0, STEP * step))
            use[config] = use.get(config, 0.0) + step
            for n, c in config:
                cover[at[n]] += c * step / demand[at[n]]
        if cover.min() >= 1:
            break
    return use


def best_fit_decreasing(histogram: Counter, capacity: int) -> Counter:
    """Configurations of best-fit decreasing, all sequences with the same content at once.

    The fullest sequence with room for an item stays the fullest until it has
    no more room for another one, so a group of equal sequences is filled up
    one after the other.  The work depends on the lengths, not on the items.
    """
    groups: dict[tuple, int] = {}  # (room, content): sequences
    rooms: list[tuple] = []
    closed: Counter = Counter()

    def put(room: int, content: tuple, times: int) -> None:
        if not room:
            closed[content] += times
        elif times:
            if (room, content) not in groups:
                insort(rooms, (room, content))
            groups[room, content] = groups.get((room, content), 0) + times

    for length in sorted(histogram, reverse=True):
        items = histogram[length]
        while items:
            k = bisect_left(rooms, (length, ()))
            if k < len(rooms):
                room, content = rooms.pop(k)
                times = groups.pop((room, content))
            else:
                room, content, times = capacity, (), items
            each = room // length
            full = min(times, items // each)
            rest = items - full * each if full < times else 0
            put(room - each * length, (*content, (length, each)), full)
            if 0 < rest < each:
                put(room - rest * length, (*content, (length, rest)), 1)
                full, items = full + 1, items - rest
            if content:
                put(room, content, times - full)
            items -= (full - (1 if 0 < rest < each else 0)) * each
    for (_, content), times in groups.items():
        closed[content] += times
    return closed


def _rounded(use: dict[tuple, float], left: Counter, least: int, share: float) -> tuple[Counter, Counter]:
    """Whole uses of configurations of at least ``least`` tokens, at most ``share`` of each fraction, and the lengths that remain."""
    plan, left = Counter(), Counter(left)
    for config, fraction in sorted(use.items(), key=lambda item: -item[1]):
        if sum(n * c for n, c in config) >= least:
            times = min(int(share * fraction), *(left[n] // c for n, c in config))
            if times > 0:
                plan[config] += times
                for n, c in config:
                    left[n] -= times * c
    return plan, Counter({n: c for n, c in left.items() if c > 0})


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Configurations, each with how often it is used; together they hold exactly the histogram.

    The solution is rounded several ways: what is held back of it makes a
    larger rest, which packs with less waste.  The way with the fewest sequences
    counts.  There are at most as many configurations as the program's rounds
    find, `SOLVES` x `ROUNDS` x `CONFIGS_PER_ROUND`, and those of the rest.
    """
    left = Counter({n: c for n, c in histogram.items() if c > 0})
    whole: Counter = Counter()
    if capacity in left:
        whole[((capacity, 1),)] = left.pop(capacity)
    if not left:
        return sorted(whole.items())
    use = solve(left, capacity)
    plans = []
    # Configurations without waste only, or all that the solution uses.
    for share, least in [(share, least) for least in (capacity, 0) for share in SHARES]:
        plan, rest = _rounded(use, left, least, share)
        for _ in range(SOLVES - 1):
            if rest and share == 1:
                more, rest = _rounded(solve(rest, capacity), rest, least, 1)
                plan.update(more)
        plan.update(best_fit_decreasing(rest, capacity))
        plans.append(plan)
    best = min(plans, key=lambda plan: sum(plan.values()))
    best.update(whole)
    return sorted(best.items())


class Places:
    """Where the piece with a given rank among those of its length goes."""

    def __init__(self, plan: list[tuple[tuple, int]]):
        rows, taken, base = [], Counter(), 0
        for config, times in plan:
            offset = 0
            for length, count in config:
                rows.append((length, taken[length], base, count, offset))
                taken[length] += times * count
                offset += length * count
            base += times
        self.rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.keys = (self.rows[:, 0] << _RANK_BITS) | self.rows[:, 1]
        self.sequences = base

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank."""
        row = self.rows[np.searchsorted(self.keys, (length << _RANK_BITS) | rank, side="right") - 1]
        local = rank - row[:, 1]
        return row[:, 2] + local // row[:, 3], row[:, 4] + local % row[:, 3] * length


def pieces(docs: DataFrame, tokenizer: tuple, capacity: int = CAPACITY, end_id: int | None = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` with task number and rank among the task's pieces of that length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(*tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for i, text in enumerate(texts(batch.column(1))):
                ids = encoder.ids(text)
                if end_id is not None:
                    ids = np.append(ids, np.uint32(end_id))
                for number, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                    rows.append((i, number, start, length, crc, task, int(seen[length])))
                    seen[length] += 1
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, pa.int64()) for c in columns[1:])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"],
            )

    schema = "piece long, start long, length long, ids_crc32 long, task long, task_rank long"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {id_type}, {schema}")


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for a stored frame of `pieces`."""
    counts = staged(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = cut.sparkSession.sparkContext.broadcast(Places(plan_packing(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    ranked = cut.join(first, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_rank") + F.col("task_rank")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(3).to_numpy()
            sequence, offset = places.value.of(length, batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, f"doc_id {cut.schema['doc_id'].dataType.simpleString()}, {schema}")


def packed(docs: DataFrame, tokenizer: tuple, capacity: int = CAPACITY, end_id: int | None = END_ID) -> DataFrame:
    """All rows of ``docs(doc_id, text)`` packed into sequences of at most ``capacity`` tokens.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``,
    one row per piece.  A document is its ids and then ``end_id``; only longer
    ones are cut, into full pieces after a first one that may be shorter.  A
    null text is empty and so has one token.  Repeated rows are packed once
    each; other columns are ignored; an empty table gives an empty one.
    ``tokenizer`` holds the arguments of `encoding.text_encoder`, whose files
    must be there on every executor.
    """
    return placed(staged(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
