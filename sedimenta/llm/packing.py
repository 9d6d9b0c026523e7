"""Packing of tokenised documents into fixed windows, planned by non-negative least squares.

A document is cut into full windows and one rest. Pieces are counted by length; only this histogram, at most
a row per possible length whatever the input, reaches the driver. There lengths are rounded up to BINS bins, all combinations
of up to DEPTH bins that fill a window exactly are enumerated, non-negative least squares finds how often to use each, and
the repeats are rounded down to what the histogram has, longest pieces of a bin first. What is left is packed greedily by
exact lengths, so that a sequence holds as many short pieces as fit. The plan is again a small table: piece number r
of a length goes to the sequence that the plan names for r. Pieces are numbered per length from counts per task,
so no length, however many pieces have it, is ever sorted or held in one task.

Defined results: a null or empty text is its end id alone. Null ids pass through; rows that repeat are
documents of their own; ties are broken by the order of rows in files. An empty table gives no pieces.
Other columns are ignored. Texts of any length are tokenised whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.batches import Made, Texts, map_texts
from sedimenta.llm.tokens import encoder
from sedimenta.session import materialize

WINDOW = 2048
BINS = 256
DEPTH = 3
END_ID = 1

#: bins of one sequence, and how many sequences to make of them
Plan = list[tuple[tuple[int, ...], int]]


def fillings(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All combinations of two to ``depth`` bins, in falling order, that sum to ``bins``."""
    found = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(chosen)
        elif len(chosen) < depth:
            most = min(left, chosen[-1] if chosen else bins - 1)
            for b in range(most, (left - 1) // (depth - len(chosen)), -1):
                extend((*chosen, b), left - b)

    extend((), bins)
    return found


def nonnegative_least_squares(matrix: np.ndarray, target: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 that minimises |matrix x - target|, by growing and shrinking a set of free columns."""
    aim = matrix.T @ target
    x = np.zeros(matrix.shape[1])
    free = np.zeros(matrix.shape[1], dtype=bool)
    slack = 1e-9 * max(1.0, float(np.abs(target).max(initial=0.0)))
    ridge = 1e-9  # for combinations that depend on each other
    for _ in range(rounds):
        gain = np.where(free, -np.inf, aim - matrix.T @ (matrix @ x))
        best = int(gain.argmax())
        if gain[best] <= slack:
            break
        free[best] = True
        while True:
            columns = np.flatnonzero(free)
            part = matrix[:, columns]
            solved = np.linalg.solve(part.T @ part + ridge * np.eye(len(columns)), aim[columns])
            if (solved > 0).all():
                x[:] = 0
                x[columns] = solved
                break
            bad = solved <= 0
            now = x[columns]
            step = float(np.min(now[bad] / np.maximum(now[bad] - solved[bad], 1e-300)))
            x[columns] = np.maximum(now + step * (solved - now), 0)
            free[columns[bad & (x[columns] <= slack)]] = False
            x[~free] = 0
    return x


def _use(plan: Plan, left: Counter, combination: tuple[int, ...], repeats: int) -> None:
    if repeats:
        plan.append((combination, repeats))
        for b in combination:
            left[b] -= repeats


def _possible(left: Counter, combination: tuple[int, ...]) -> int:
    return min(left[b] // n for b, n in Counter(combination).items())


def exact_fillings(histogram: dict[int, int], bins: int = BINS, depth: int = DEPTH) -> Plan:
    """Combinations of bins 1..``bins`` that fill a window, and how often least squares takes each."""
    left = Counter({b: n for b, n in histogram.items() if n})
    plan: Plan = []
    _use(plan, left, (bins,), left[bins])
    choices = [c for c in fillings(bins, depth) if _possible(left, c)]
    if choices:
        matrix = np.zeros((bins, len(choices)))
        for i, choice in enumerate(choices):
            for b in choice:
                matrix[b, i] += 1
        wanted = np.array([left[b] for b in range(bins)], dtype=float)
        repeats = nonnegative_least_squares(matrix, wanted)
        for i in np.argsort(-repeats, kind="stable"):
            _use(plan, left, choices[i], min(int(repeats[i]), _possible(left, choices[i])))
    return plan


def greedy_fillings(histogram: dict[int, int], window: int) -> Plan:
    """All pieces of ``histogram``, the longest that fits next, each combination as often as the pieces allow."""
    left = Counter({b: n for b, n in histogram.items() if n})
    plan: Plan = []
    while rest := sorted((b for b, n in left.items() if n), reverse=True):
        combination: list[int] = []
        space = window
        for b in rest:
            times = min(left[b], space // b)
            combination += [b] * times
            space -= b * times
        _use(plan, left, tuple(combination), _possible(left, tuple(combination)))
    return plan


def slots(plan: Plan) -> list[tuple[int, int, int, int, int]]:
    """(bin, first, past, sequence, times): pieces first..past-1 of a bin go ``times`` each to sequences from ``sequence`` on."""
    out, used, sequence = [], Counter(), 0
    for combination, repeats in plan:
        for b, times in Counter(combination).items():
            out.append((b, used[b], used[b] + times * repeats, sequence, times))
            used[b] += times * repeats
        sequence += repeats
    return out


def placements(
    histogram: dict[int, int], window: int = WINDOW, bins: int = BINS, depth: int = DEPTH
) -> list[tuple[int, int, int, int, int, int]]:
    """(length, low, high, shift, sequence, times): pieces low..high-1 of a length go to sequences from ``sequence`` on,
    piece r to number (r + shift) // times of them; every piece of ``histogram`` goes to one."""
    width = -(-window // bins)
    by_bin: dict[int, list[int]] = {}
    for length in sorted((n for n, count in histogram.items() if count), reverse=True):
        by_bin.setdefault(-(-length // width), []).append(length)
    # a window that is no whole number of bins is filled with fewer of them
    plan = exact_fillings({b: sum(histogram[n] for n in own) for b, own in by_bin.items()}, window // width, depth)
    out, taken = [], Counter()
    for b, first, past, sequence, times in slots(plan):
        start = 0
        for length in by_bin[b]:
            low, high = max(first - start, 0), min(past - start, histogram[length])
            if low < high:
                out.append((length, low, high, start - first, sequence, times))
                taken[length] = max(taken[length], high)
            start += histogram[length]
    sequences = sum(repeats for _, repeats in plan)
    rest = greedy_fillings({n: count - taken[n] for n, count in histogram.items()}, window)
    for length, first, past, sequence, times in slots(rest):
        out.append((length, first + taken[length], past + taken[length], -first - taken[length], sequence + sequences, times))
    return out


def cut(docs: DataFrame, tokenizer: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: its document, place, length and checksum; full windows and one rest each."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def prepare() -> Callable[[Texts], Made]:
        packed = encoder(tokenizer).packed

        def pieces(texts: Texts) -> Made:
            rows: list[tuple[int, ...]] = []
            for at, content in enumerate(texts):
                ids = packed(content) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rows.append((at, start, len(part) // 4, zlib.crc32(part), total))
            owners, *numbers = np.array(rows, dtype="int64").reshape(-1, 5).T
            return owners, [pa.array(column) for column in numbers]

        return pieces

    return map_texts(docs, "start long, length long, ids_crc32 long, doc_tokens long", prepare, key, text)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    bins: int = BINS,
    depth: int = DEPTH,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: every id in exactly one piece, no sequence over ``window``."""
    spark = docs.sparkSession
    pieces = materialize(
        cut(docs, tokenizer, window, key, text).select(
            "*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("piece")
        ),
        "pieces",
    )
    counts = materialize(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.createDataFrame(
        placements(histogram, window, bins, depth),
        "length long, low long, high long, shift long, sequence long, times long",
    )
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("length", "task").orderBy("piece")
    ranked = (
        pieces.withColumn("nth", F.row_number().over(within) - 1)
        .join(offsets, ["length", "task"])
        .withColumn("rank", F.col("earlier") + F.col("nth"))
    )
    rank = F.col("rank")
    placed = (
        ranked.join(F.broadcast(table), "length")  # a few rows per length, whatever the input
        .filter((rank >= F.col("low")) & (rank < F.col("high")))
        .withColumn("sequence_id", F.col("sequence") + F.floor((rank + F.col("shift")) / F.col("times")))
    )
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "piece").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"),
    )
