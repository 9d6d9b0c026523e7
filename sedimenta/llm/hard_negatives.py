"""Hard negatives by Four-Russians scoring.

Components become whole numbers, ``floor(256 * x)``, and a score is an exact inner product of whole numbers. Written in
two's complement, a candidate is a stack of bit planes, and each plane has one byte for every eight dimensions. For such
a group of eight dimensions an anchor has a table of the sums of all 256 subsets of its components, so a byte of a plane
is looked up instead of multiplied: the lookups of a plane are added, shifted to the plane's weight and summed, the
sign plane with a minus.

Every anchor meets every candidate, in blocks: candidates are dealt into slices by a hash of their id, anchors into
groups, and each pair of a group and a slice is one Spark group of bounded size, whatever labels or vectors are frequent.
A slice keeps the best rows of each anchor, which Spark then ranks over the slices. The first pass scores rows of the
anchor's own label for its positives, the second one rows of other labels for the negatives, so no pair is scored twice.

Defined results: rows with a null label, a null vector, or any null or non-finite component take no part, nor do rows
without an id and rows so long that scores might not fit a long (a component beyond ``reach(dimensions)``). Vectors of
different length are compared as if filled up with zeros; an empty vector scores zero with all. Rows that share an id
count as one, that of the least label and vector. Equal scores are ordered by id. An anchor without other rows of its
label has no positive, a positive without a row in its range has no negatives; neither gives rows. Empty tables give
empty results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import materialize, materialize_counting, ship

#: What a component is multiplied with before it is rounded down.
SCALE = 256
#: Most candidates in a slice and most anchors in a group, which bound a task's memory.
SLICE = 1 << 18
GROUP = 1 << 13
#: Least candidates in a slice while there are cores to spare.
SMALL = 1 << 12
_ANCHORS_AT_ONCE = 64
_ROWS_AT_ONCE = 1 << 12
_SCORED = "anchor_id long, positive_id long, positive_score long, id long, score long"


@dataclass(frozen=True)
class Mining:
    """Which rows are anchors, how many positives and negatives each has, and the range of a negative's score.

    A negative is in range if ``low * positive <= 100 * negative <= high * positive``.
    """

    anchor: str
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def reach(dimensions: int) -> int:
    """The largest scaled component with which no score leaves a long."""
    return min(isqrt((1 << 62) // max(dimensions, 1)), (1 << 31) - 1)


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids, labels and scaled components as bytes of the rows that take part."""
    for batch in batches:
        whole = batch.column(2).cast(pa.list_(pa.float64()))
        wanted = [], []
        for row, vector in enumerate(whole):
            if not vector.is_valid:
                continue
            values = vector.values
            if values.null_count:
                continue
            scaled = np.floor(np.asarray(values.to_numpy(zero_copy_only=False)) * SCALE)
            if np.isfinite(scaled).all() and (not len(scaled) or np.abs(scaled).max() <= reach(len(scaled))):
                wanted[0].append(row)
                wanted[1].append(scaled.astype("<i4").tobytes())
        rows = pa.array(wanted[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(wanted[1], pa.binary())],
            ["id", "label", "parts"],
        )


def _matrix(parts: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Scaled components as rows, filled up with zeros to a common multiple of eight dimensions."""
    rows = [np.frombuffer(p, "<i4") for p in parts.to_pylist()]
    width = max([len(r) for r in rows] + [width])
    out = np.zeros((len(rows), -(-max(width, 1) // 8) * 8), np.int32)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def bit_planes(matrix: np.ndarray) -> np.ndarray:
    """Planes x groups x rows: for each bit of two's complement the packed bits of eight dimensions."""
    magnitude = np.where(matrix < 0, ~matrix, matrix)
    count = int(magnitude.max(initial=0)).bit_length() + 1
    planes = [np.packbits((matrix >> b) & 1 != 0, axis=1, bitorder="little").T for b in range(count)]
    return np.ascontiguousarray(np.stack(planes))


def subset_tables(anchors: np.ndarray) -> np.ndarray:
    """Groups x 256 x anchors: the sum of each subset of an anchor's eight components of a group."""
    groups = anchors.astype(np.int64).reshape(len(anchors), -1, 8)
    tables = np.zeros((groups.shape[1], 256, len(anchors)), np.int64)
    for bit in range(8):
        size = 1 << bit
        tables[:, size : 2 * size] = tables[:, :size] + groups[:, :, bit].T[:, None, :]
    return tables


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Rows x anchors: exact inner products, from one lookup per plane and group."""
    count, groups, rows = planes.shape
    bound = int(np.abs(tables).max(initial=0)) * groups
    narrow = np.int16 if bound < 1 << 15 else np.int32 if bound < 1 << 31 else np.int64
    wide = np.int32 if bound << count < 1 << 31 else np.int64
    tables = tables.astype(narrow)
    out = np.zeros((rows, tables.shape[2]), wide)
    looked, summed = (np.empty((rows, tables.shape[2]), narrow) for _ in range(2))
    for plane in range(count):
        np.take(tables[0], planes[plane, 0], axis=0, out=summed, mode="clip")
        for group in range(1, groups):
            np.take(tables[group], planes[plane, group], axis=0, out=looked, mode="clip")
            summed += looked
        shifted = summed.astype(wide) << plane
        out = out - shifted if plane == count - 1 else out + shifted
    return out


def _all_scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """``scores`` a few thousand rows at a time, so that the summed lookups stay in the processor's cache."""
    rows = planes.shape[2]
    parts = [scores(planes[:, :, at : at + _ROWS_AT_ONCE], tables) for at in range(0, rows, _ROWS_AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros((0, tables.shape[2]), np.int64)


def _best(found: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Of ``places`` (ascending, so in the order of ids) the ``n`` of the highest scores, ties by place."""
    if len(places) > n:
        values = found[places]
        least = np.partition(values, len(values) - n)[len(values) - n]
        above = places[values > least]
        places = np.concatenate([above, places[values == least][: n - len(above)]])
    return places


class _Slice:
    """The candidates of a slice in the order of ids, with their labels and bit planes."""

    def __init__(self, table: pa.Table, width: int) -> None:
        table = table.sort_by("id")
        self.ids = table["id"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.planes = bit_planes(_matrix(table["parts"], width))


def _met(anchors: pa.Table, candidates: pa.Table) -> Iterator[tuple[np.ndarray, pa.Table, _Slice, np.ndarray]]:
    """Anchors of one label at a time: their subset tables with the slice they meet."""
    width = max((len(p) // 4 for column in (anchors["parts"], candidates["parts"]) for p in column.to_pylist()), default=0)
    slice_ = _Slice(candidates, width)
    width = slice_.planes.shape[1] * 8
    for label in np.unique(anchors["label"].to_numpy()):
        own = anchors.filter(pc.equal(anchors["label"], pa.scalar(label, anchors["label"].type)))
        for at in range(0, own.num_rows, _ANCHORS_AT_ONCE):
            part = own.slice(at, _ANCHORS_AT_ONCE)
            yield slice_.labels == label, part, slice_, subset_tables(_matrix(part["parts"], width))


def _rows(found: list[tuple]) -> pa.Table:
    columns = list(zip(*found)) or [()] * 5
    names = [c.split()[0] for c in _SCORED.split(", ")]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def _nearest(n: int):
    """The best rows of each anchor's own label in a slice."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        for same, part, slice_, tables in _met(anchors, candidates):
            places = np.flatnonzero(same)
            block = _all_scores(slice_.planes[:, :, places], tables)
            ids = slice_.ids[places]
            for column, anchor in enumerate(part["id"].to_pylist()):
                for at in _best(block[:, column], np.flatnonzero(ids != anchor), n):
                    found.append((anchor, None, None, int(ids[at]), int(block[at, column])))
        return _rows(found)

    return run


def _in_range(n: int, low: int, high: int):
    """The best rows of other labels in a slice within the range that each positive of an anchor sets."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        for same, part, slice_, tables in _met(anchors, candidates):
            places = np.flatnonzero(~same)
            block = _all_scores(slice_.planes[:, :, places], tables)
            ids = slice_.ids[places]
            for column, (anchor, positives) in enumerate(zip(part["id"].to_pylist(), part["positives"].to_pylist())):
                of_anchor = np.ascontiguousarray(block[:, column])
                for positive in positives:
                    least, most = -(-low * positive["score"] // 100), high * positive["score"] // 100
                    fitting = np.flatnonzero((of_anchor >= least) & (of_anchor <= most))
                    for at in _best(of_anchor, fitting, n):
                        found.append((anchor, positive["id"], positive["score"], int(ids[at]), int(of_anchor[at])))
        return _rows(found)

    return run


def _dealt(df: DataFrame, slices: int, groups: int, anchors: bool) -> DataFrame:
    """Rows under every pair of an anchor group and a slice that they belong to."""
    own = F.pmod(F.xxhash64("id"), F.lit(groups if anchors else slices)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit((slices if anchors else groups) - 1)))
    first, second = ("_group", "_slice") if anchors else ("_slice", "_group")
    return df.withColumn(first, own).withColumn(second, every)


def _scored(anchors: DataFrame, candidates: DataFrame, slices: int, groups: int, work) -> DataFrame:
    keys = ["_group", "_slice"]
    left = _dealt(anchors, slices, groups, True).groupBy(*keys)
    return left.cogroup(_dealt(candidates, slices, groups, False).groupBy(*keys)).applyInArrow(work, _SCORED)


def mine(
    vectors: DataFrame,
    mining: Mining,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    slice_rows: int = SLICE,
    group_rows: int = GROUP,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, see above.

    ``mining.anchor`` is SQL text, a condition on ``id``. ``slice_rows`` and ``group_rows`` bound a task, not the result.
    """
    spark = vectors.sparkSession
    ship(spark)
    plain = vectors.select(
        vectors[key].cast("long").alias("id"), vectors[label].cast("long").alias("label"), vectors[vector].alias("parts")
    ).where("id is not null and label is not null")
    scaled = plain.mapInArrow(_scaled, "id long, label long, parts binary")
    one_each = scaled.groupBy("id").agg(F.min(F.struct("label", "parts")).alias("row")).select("id", "row.*")
    rows, n = materialize_counting(one_each, F.count(F.lit(1)), "vectors")
    chosen, n_anchors = materialize_counting(rows.where(mining.anchor), F.count(F.lit(1)), "anchors")
    cores = spark.sparkContext.defaultParallelism
    slices = max(1, -(-n // slice_rows), min(cores, n // SMALL))
    groups = max(1, -(-n_anchors // group_rows))

    near = _scored(chosen, rows, slices, groups, _nearest(mining.positives))
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    positives = (
        near.withColumn("_place", F.row_number().over(by_score))
        .where(F.col("_place") <= mining.positives)
        .groupBy(F.col("anchor_id").alias("id"))
        .agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    )
    anchors = materialize(chosen.join(positives, "id"), "positives")
    hard = _scored(anchors, rows, slices, groups, _in_range(mining.negatives, mining.low, mining.high))
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return (
        hard.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= mining.negatives)
        .select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
