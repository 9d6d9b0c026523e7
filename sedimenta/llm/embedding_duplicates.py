"""Near-duplicate vectors by iterative quantisation.

Unit vectors are centred and turned by a learned rotation that brings their coordinates close to the corners of a cube;
the signs are a binary code. Codes are cut into segments, one Hamming table each. A vector is filed under its own value
of every segment and under those values of a small Hamming ball that it may well have under a small change: the ball's
members flip coordinates whose squares sum to no more than a share of what a pair at the threshold can differ in, per
segment. Whole codes of vectors that meet are compared, and what is left is ranked by the original vectors, in double
precision.

The signs of two vectors differ only where their difference exceeds both coordinates together, and the squares of the
differences sum to ``2 - 2 cos`` at most, since the rotation's rows are orthonormal. So some segment holds a flip of at most
``(2 - 2 cos) / (2 * segments)`` from one of the two: with ``share=1``, balls without a limit and whole codes left alone the
tables would miss no pair. The default share keeps a tenth of the table rows; the tests measure its recall against brute force.

Crowds. Equal vectors are one node with a weight. Nodes with near codes gather around a leader within the threshold, so all
of them link with it. Around a leader they are dealt into shells by their angle to it. Two shells whose angles cannot sum
to more than the threshold are linked throughout; two that the angle of their leaders keeps further apart are not linked.
Only members of other shells are compared one by one, in blocks that yield counts of links and not pairs. The
tables hold a leader once under each value that any of its members is filed under. So a crowd of near copies costs table rows in
proportion to its members, and pairs of leaders only.

Defined results: a vector that is null, empty, zero, or has null or non-finite components links with nothing, nor does one
without a label; it still has its row. Vectors of different length are never linked. Each input row gives one row, and rows that
share an id or a vector are rows like others, so equal rows link with each other. A null id is never the smallest id; a
component of null ids only has a null id, and ``kept`` compares ids null-safely. Empty tables give empty results. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sedimenta.llm.components import components
from sedimenta.session import materialize, ship

COSINE = 0.98
#: Vectors the rotation is learned from: those with the least digests, so the choice does not depend on their order.
SAMPLE = 4096
ROUNDS = 30
BITS = 64
SEGMENTS = 4
#: Bits flipped at most in one segment of a lookup, and the share of the sufficient squares that a lookup spends.
FLIPS = 3
SHARE = 0.2
#: Bits in which whole codes of a pair may differ.
DISTANCE = 18
#: Pairs of segments by which codes look for a leader, one round each, and bits in which they may differ from it.
GATHERED_BY = ((0, 1), (2, 3), (0, 2), (1, 3))
GATHERED = 12
#: Ends of the shells around a leader, as shares of the threshold's angle.
SHELLS = (0.125, 0.25, 0.5, 0.75, 0.875)
#: Members compared at a time.
BLOCK = 512
#: Degrees by which angles from an arc cosine may be off.
_OFF = 1e-5


def _units(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; large and tiny components are first brought to a common size, so that squares neither overflow nor vanish."""
    sized = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return sized / np.sqrt((sized * sized).sum(axis=1, keepdims=True))


def _usable(vector: pa.Scalar) -> np.ndarray | None:
    if not vector.is_valid or not len(vector.values) or vector.values.null_count:
        return None
    values = vector.values.to_numpy(zero_copy_only=False)
    return values if np.isfinite(values).all() and values.any() else None


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids, labels, digests and unit vectors as bytes; digest and bytes are null where a vector links with nothing."""
    for batch in batches:
        digests, units = [], []
        for label, vector in zip(batch.column(1), batch.column(2).cast(pa.list_(pa.float64())), strict=True):
            values = _usable(vector) if label.is_valid else None
            digests.append(None if values is None else hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            units.append(None if values is None else _units(values[None, :])[0].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
            ["id", "label", "digest", "unit"],
        )


def learn_rotation(units: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """A center, and ``bits`` orthonormal directions as columns: the principal ones, turned towards corners."""
    center = units.mean(axis=0)
    moved = units - center
    axes = np.linalg.eigh(moved.T @ moved)[1][:, ::-1][:, :bits]
    placed = moved @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((axes.shape[1],) * 2))
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(placed @ turn >= 0, 1.0, -1.0).T @ placed)
        turn = (left @ right).T
    return center, axes @ turn


def _rotations(nodes: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """One rotation for each length of vectors, from at most ``sample`` vectors altogether."""
    rows = nodes.select("digest", "unit").orderBy("digest").limit(sample).collect()
    by_length: dict[int, list[np.ndarray]] = {}
    for row in rows:
        by_length.setdefault(len(row["unit"]) // 8, []).append(np.frombuffer(row["unit"]))
    return {n: learn_rotation(np.array(units)) for n, units in by_length.items()}


def _plain_rotation(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Without a sample of this length the coordinates are taken as they are."""
    return np.zeros(length), np.eye(length)[:, :BITS]


def _by_length(units: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors of equal length."""
    raw = units.to_pylist()
    lengths = np.array([len(u) for u in raw])
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        yield places, np.frombuffer(b"".join(raw[i] for i in places)).reshape(-1, n // 8)


def _coordinates(units: np.ndarray, rotations: dict) -> np.ndarray:
    n = units.shape[1]
    center, axes = rotations[n] if n in rotations else _plain_rotation(n)
    return (units - center) @ axes


def _codes(coordinates: np.ndarray) -> np.ndarray:
    signs = np.zeros((len(coordinates), BITS), bool)
    signs[:, : coordinates.shape[1]] = coordinates >= 0
    return np.packbits(signs, axis=1, bitorder="little").view("<i8")[:, 0]


def _coded(rotations: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros(batch.num_rows, np.int64)
            for places, units in _by_length(batch.column("unit")):
                codes[places] = _codes(_coordinates(units, rotations))
            yield batch.append_column("code", pa.array(codes))

    return run


def _segments(bits: int, segments: int) -> list[tuple[int, int]]:
    ends = [bits * s // segments for s in range(segments + 1)]
    return [(a, b) for a, b in zip(ends, ends[1:]) if a < b]


def lookups(coordinates: np.ndarray, energy: float, segments: int = SEGMENTS, flips: int = FLIPS):
    """For each segment: rows and bit masks of the flips whose squared coordinates sum to at most ``energy``."""
    squares = coordinates * coordinates
    for start, end in _segments(coordinates.shape[1], segments):
        size = end - start
        for count in range(1, min(flips, size) + 1):
            chosen = np.array(list(combinations(range(start, end), count)))
            spent = squares[:, chosen].sum(axis=2)
            rows, picks = np.nonzero(spent <= energy)
            masks = np.bitwise_or.reduce(np.left_shift(np.uint64(1), chosen.astype(np.uint64)), axis=1)
            yield start, end, rows, masks[picks]


def _filed(rotations: dict, energy: float):
    """The entries of each vector: its own segment values, and those of its lookups."""

    def entries(batch: pa.RecordBatch, places: np.ndarray, units: np.ndarray) -> pa.RecordBatch:
        coordinates = _coordinates(units, rotations)
        codes = _codes(coordinates).view(np.uint64)
        rows, tables, values, homes = [], [], [], []

        def add(start: int, end: int, row: np.ndarray, code: np.ndarray, home: bool) -> None:
            window = np.uint64((1 << end) - (1 << start))
            rows.append(row)
            tables.append(np.full(len(row), start * (BITS + 1) + end, np.int32))
            values.append((code & window) >> np.uint64(start))
            homes.append(np.full(len(row), home))

        for start, end in _segments(coordinates.shape[1], SEGMENTS):
            add(start, end, np.arange(len(codes)), codes, True)
        for start, end, row, mask in lookups(coordinates, energy):
            add(start, end, row, codes[row] ^ mask, False)
        taken = pa.array(places[np.concatenate(rows)])
        made = [
            pa.array(np.full(len(taken), units.shape[1], np.int32)), pa.array(np.concatenate(tables)),
            pa.array(np.concatenate(values).astype(np.int64)), pa.array(np.concatenate(homes)),
        ]
        kept = ["label", "leader", "lead_code", "apart"]
        return pa.RecordBatch.from_arrays(
            [batch.column(c).take(taken) for c in kept] + made, kept + ["length", "segment", "value", "home"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                for places, units in _by_length(batch.column("unit")):
                    yield entries(batch, places, units)

    return run


@F.pandas_udf(DoubleType())
def _cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """Inner product of unit vectors of equal length."""
    return pd.Series([float(np.frombuffer(x) @ np.frombuffer(y)) for x, y in zip(a, b)], dtype="float64")


def _degrees(cosine: Column) -> Column:
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))


def _apart(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def _nodes(rows: DataFrame) -> DataFrame:
    """One row per label and distinct vector: its weight and smallest id."""
    usable = rows.where("digest is not null")
    return usable.groupBy("label", "digest").agg(
        F.count(F.lit(1)).alias("weight"), F.min("id").alias("first_id"), F.first("unit").alias("unit")
    )


def _gathered(codes: DataFrame) -> DataFrame:
    """``label, length, code, lead``: codes gathered around leading ones, without looking at vectors.

    A round groups codes by the values of two segments. A code without a leader joins the first one of its
    group, a leading one if there is any, if it differs in few bits from it.
    """
    gathered = codes.withColumn("lead", F.lit(None).cast("long"))
    width = BITS // SEGMENTS
    leading = F.col("lead") == F.col("code")
    for segments in GATHERED_BY:
        mask = sum(((1 << width) - 1) << (s * width) for s in segments)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keyed = gathered.withColumn("half", F.col("code").bitwiseAND(F.lit(signed).cast("long")))
        at = ["label", "length", "half"]
        free = F.col("lead").isNull()
        firsts = (
            keyed.where(free | leading)
            .groupBy(*at)
            .agg(F.count_if(free).alias("n"), F.count(F.lit(1)).alias("all"), F.min_by("code", F.struct(free, "code")).alias("first"))
            .where("n > 0 and all > 1")
            .drop("n", "all")
        )
        joins = free & F.col("first").isNotNull() & (_apart("code", "first") <= GATHERED)
        gathered = materialize(
            keyed.join(firsts, at, "left").select(
                "label", "length", "code", F.when(joins, F.col("first")).otherwise(F.col("lead")).alias("lead")
            ),
            "gathered",
        )
    return gathered.withColumn("lead", F.coalesce("lead", "code"))


def _members(nodes: DataFrame, limit: float) -> DataFrame:
    """Nodes with their leader, the angle to it, and the shell around it that they are in."""
    at = ["label", "length", "code"]
    sized = nodes.withColumn("length", F.length("unit"))
    led = _gathered(materialize(sized.select(*at).distinct(), "codes"))
    order = F.struct(F.col("first_id").isNull(), "first_id", "digest")
    firsts = (
        sized.groupBy(*at)
        .agg(F.min_by(F.struct("digest", "unit"), order).alias("first"))
        .withColumnRenamed("code", "lead")
        .join(led.select("label", "length", "lead").distinct(), ["label", "length", "lead"], "left_semi")
    )
    placed = sized.join(led, at).join(firsts, ["label", "length", "lead"])
    # the angle of a leader to itself must be exactly zero
    angle = F.when(F.col("digest") == F.col("first.digest"), 0.0).otherwise(_degrees(_cosine(F.col("unit"), F.col("first.unit"))))
    placed = placed.withColumn("angle", angle)
    near = F.col("angle") <= limit - _OFF
    shell = sum((F.col("angle") > end * limit - _OFF).cast("int") for end in SHELLS)
    return placed.select(
        "label", "digest", "weight", "first_id", "unit", "code",
        F.when(near, F.col("first.digest")).otherwise(F.col("digest")).alias("leader"),
        F.when(near, F.col("lead")).otherwise(F.col("code")).alias("lead_code"),
        F.when(near, F.col("angle")).otherwise(0.0).alias("away"),
        F.when(near, shell).otherwise(0).alias("shell"),
    ).withColumn("apart", _apart("code", "lead_code"))


def _met(entries: DataFrame, distance: int) -> DataFrame:
    """Pairs of leaders of one label some of whose members meet in a table with whole codes that may be near, once each."""
    keys = ["label", "length", "segment", "value"]
    filed = entries.groupBy(*keys, "leader", "lead_code").agg(F.max("home").alias("home"), F.max("apart").alias("apart"))
    homes, others = (
        filed.select(*keys, "home", *[F.col(c).alias(f"{c}_{x}") for c in ("leader", "lead_code", "apart")]) for x in "ab"
    )
    homes = homes.where("home").drop("home")
    near = _apart("lead_code_a", "lead_code_b") - F.col("apart_a") - F.col("apart_b") <= distance
    once = ~F.col("home") | (F.col("leader_a") < F.col("leader_b"))
    return (
        homes.join(others, keys)
        .where(near & (F.col("leader_a") != F.col("leader_b")) & once)
        .select("label", F.least("leader_a", "leader_b").alias("a"), F.greatest("leader_a", "leader_b").alias("b"))
        .distinct()
    )


def _shell_pairs(met: DataFrame, leaders: DataFrame, shells: DataFrame) -> DataFrame:
    """Pairs of shells, of one leader or of two that met, with the cosine and angle of their leaders.

    A pair of shells of one leader comes once, and a shell with itself.
    """
    units = [leaders.select("label", F.col("leader").alias(x), F.col("unit").alias(f"unit_{x}")) for x in "ab"]
    apart = met.join(units[0], ["label", "a"]).join(units[1], ["label", "b"])
    measured = apart.select("label", "a", "b", _cosine("unit_a", "unit_b").alias("cosine"))
    own = leaders.where("size > 1").select("label", F.col("leader").alias("a"), F.col("leader").alias("b"), F.lit(1.0).alias("cosine"))
    angle = F.when(F.col("a") == F.col("b"), 0.0).otherwise(_degrees(F.col("cosine")))
    sides = [
        shells.select(
            "label", F.col("leader").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("shell", "size", "weight", "spread")]
        )
        for x in "ab"
    ]
    pairs = measured.unionByName(own).withColumn("angle", angle)
    return (
        pairs.join(sides[0], ["label", "a"])
        .join(sides[1], ["label", "b"])
        .where((F.col("a") != F.col("b")) | (F.col("shell_a") <= F.col("shell_b")))
    )


def _blocks(members: DataFrame, shells: DataFrame, block: int) -> DataFrame:
    """Members of shells in numbered blocks of about ``block``."""
    sized = members.join(shells.select("label", "leader", "shell", "size"), ["label", "leader", "shell"])
    number = F.pmod(F.xxhash64("digest"), F.ceil(F.col("size") / block)).cast("int")
    return sized.groupBy("label", "leader", "shell", number.alias("block")).agg(
        F.collect_list(F.struct("digest", "weight", "unit")).alias("members")
    )


def _counted(cosine: float):
    """Links of the members of each of two blocks to the weights of the other one."""
    names = ["label", "a", "b", "digest", "links"]

    def counts(row: dict) -> Iterator[tuple]:
        sides = [row["members_a"], row["members_b"]]
        units = [np.array([np.frombuffer(m["unit"]) for m in side]) for side in sides]
        linked = units[0] @ units[1].T >= cosine
        same = row["same"]
        if same:
            np.fill_diagonal(linked, False)
        weights = [np.array([m["weight"] for m in side]) for side in sides]
        for side, links in ((sides[0], linked @ weights[1]), (sides[1], linked.T @ weights[0]))[: 1 if same else 2]:
            for member, n in zip(side, links, strict=True):
                if n:
                    yield row["label"], row["a"], row["b"], member["digest"], int(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [batch.schema.field("label").type, pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            for at in range(batch.num_rows):
                found = list(zip(*counts(batch.slice(at, 1).to_pylist()[0]))) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types, strict=True)], names)

    return run


def _open_links(unsure: DataFrame, members: DataFrame, shells: DataFrame, cosine: float, block: int) -> DataFrame:
    """Links between members of shells that are not known to be linked or not as a whole: ``label, a, b, digest, links``."""
    label = members.schema["label"].dataType.simpleString()
    at = ["label", "leader", "shell"]
    touched = unsure.select(
        "label", F.inline(F.array(*[F.struct(F.col(x).alias("leader"), F.col(f"shell_{x}").alias("shell")) for x in "ab"]))
    ).distinct()
    blocks = materialize(_blocks(members.join(touched, at, "left_semi"), shells, block), "blocks")
    sides = [
        blocks.select("label", *[F.col(c).alias(n) for c, n in (("leader", x), ("shell", f"shell_{x}"), ("block", f"block_{x}"), ("members", f"members_{x}"))])
        for x in "ab"
    ]
    own = (F.col("a") == F.col("b")) & (F.col("shell_a") == F.col("shell_b"))
    met = (
        unsure.select("label", "a", "b", "shell_a", "shell_b")
        .join(sides[0], ["label", "a", "shell_a"])
        .join(sides[1], ["label", "b", "shell_b"])
        .where(~own | (F.col("block_a") <= F.col("block_b")))
        .select("label", "a", "b", "members_a", "members_b", (own & (F.col("block_a") == F.col("block_b"))).alias("same"))
    )
    return met.mapInArrow(_counted(cosine), f"label {label}, a binary, b binary, digest binary, links long")


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    cosine: float = COSINE,
    share: float = SHARE,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept``, see above.

    ``share`` trades table rows for recall; ``block`` bounds what is compared at a time and not the result.
    """
    spark = vectors.sparkSession
    ship(spark)
    plain = vectors.select(vectors[key].alias("id"), vectors[label].alias("label"), vectors[vector].alias("vector"))
    types = {f.name: f.dataType.simpleString() for f in plain.schema}
    digested = plain.mapInArrow(_digested, f"id {types['id']}, label {types['label']}, digest binary, unit binary")
    rows = materialize(digested, "vectors")
    nodes = materialize(_nodes(rows), "nodes")
    rotations = _rotations(nodes, sample)
    coded = nodes.mapInArrow(
        _coded(rotations),
        f"label {types['label']}, digest binary, weight long, first_id {types['id']}, unit binary, code long",
    )
    limit = float(np.degrees(np.arccos(cosine)))
    members = materialize(_members(materialize(coded, "coded"), limit), "members")
    shells = materialize(
        members.groupBy("label", "leader", "shell").agg(
            F.count(F.lit(1)).alias("size"), F.sum("weight").alias("weight"), F.max("away").alias("spread")
        ),
        "shells",
    )
    led = members.where(F.col("digest") == F.col("leader")).select("label", "leader", "unit")
    leaders = materialize(led.join(shells.groupBy("label", "leader").agg(F.sum("size").alias("size")), ["label", "leader"]), "leaders")

    energy = share * (2 - 2 * cosine) / (2 * SEGMENTS)
    entries = members.select("label", "leader", "lead_code", "apart", "unit").mapInArrow(
        _filed(rotations, energy),
        f"label {types['label']}, leader binary, lead_code long, apart int, length int, segment int, value long, home boolean",
    )
    pairs = materialize(_shell_pairs(_met(entries, DISTANCE), leaders, shells), "pairs")

    # linked for every member, for none, or to be counted; a pair of single nodes is decided by its cosine
    single = (F.col("a") != F.col("b")) & (F.col("size_a") == 1) & (F.col("size_b") == 1) & (F.col("spread_a") + F.col("spread_b") == 0)
    spread = F.col("spread_a") + F.col("spread_b") + _OFF
    every = F.when(single, F.col("cosine") >= cosine).otherwise(F.col("angle") + spread <= limit)
    none = F.when(single, F.col("cosine") < cosine).otherwise(F.col("angle") - spread > limit)
    whole = pairs.where(every)
    counts = materialize(_open_links(pairs.where(~every & ~none), members, shells, cosine, block), "open")
    return _labelled(rows, members, whole, counts).select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _labelled(rows: DataFrame, members: DataFrame, whole: DataFrame, counts: DataFrame) -> DataFrame:
    """Each input row with its number of links and the least id of its component."""
    own = (F.col("a") == F.col("b")) & (F.col("shell_a") == F.col("shell_b"))
    at = ["label", "leader", "shell"]
    by_shell = (
        whole.select("label", F.col("a").alias("leader"), F.col("shell_a").alias("shell"), F.col("weight_b").alias("n"), own.alias("own"))
        .unionByName(
            whole.where(~own).select("label", F.col("b").alias("leader"), F.col("shell_b").alias("shell"), F.col("weight_a").alias("n"), F.lit(False).alias("own"))
        )
        .groupBy(*at)
        .agg(F.sum("n").alias("shell_links"), F.max("own").alias("own"))
    )
    by_member = counts.groupBy("label", "digest").agg(F.sum("links").alias("open_links"))

    # all members link with their leader, so components of leaders are enough; a vector may occur under several labels
    def node(leader: str) -> Column:
        return F.concat(F.col("label").cast("string").cast("binary"), F.lit(b":"), F.col(leader))

    edges = whole.select("label", "a", "b").unionByName(counts.select("label", "a", "b")).where("a != b").distinct()
    roots = components(edges.select(node("a").alias("a"), node("b").alias("b")))
    firsts = members.groupBy("label", "leader").agg(F.min("first_id").alias("first_id"))
    rooted = firsts.withColumn("node", node("leader")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    components_of = rooted.join(least, "root").select("label", "leader", "component_id")

    # a shell linked with itself counts the member's own copies among its weight
    copies = F.when(F.coalesce("own", F.lit(False)), -1).otherwise(F.col("weight") - 1)
    links = copies + F.coalesce("shell_links", F.lit(0)) + F.coalesce("open_links", F.lit(0))
    per_node = (
        members.select(*at, "digest", "weight")
        .join(components_of, ["label", "leader"])
        .join(by_shell, at, "left")
        .join(by_member, ["label", "digest"], "left")
        .select("label", "digest", "component_id", links.alias("n_links"))
    )
    alone = F.col("digest").isNull()
    return (
        rows.select("id", "label", "digest")
        .join(materialize(per_node, "links"), ["label", "digest"], "left")
        .select(
            "id",
            F.when(alone, F.lit(0).cast("long")).otherwise(F.col("n_links")).alias("n_links"),
            F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )
