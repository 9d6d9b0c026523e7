"""Column mapping: which spellings of a column name mean the same column.

A mapping is a DataFrame ``standard string, variants array<string>, ordinal int``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.functions.names import norm_name, norm_text
from sedimenta.operators.components import component_roots
from sedimenta.operators.ranking import with_ordinal
from sedimenta.session import materialize, materialize_counting

# Similarity cutoff, candidates kept per name, prefix of generated names,
# column titles and separator of the CSV export.
CUTOFF = 0.8
TOP_N = 3
PREFIX = "coluna_"
CSV_TITLES = ("nome_padrao", "colunas_equivalentes")
CSV_SEPARATOR = ", "
#: Edges of a component that one task walks through.
WALKED = 100_000


def _matches(cutoff: float):
    """Directed rows ``head, candidate, ratio`` of candidate pairs whose ratio reaches ``cutoff``."""

    def ratios(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for head, candidate in zip(
                pd.concat([batch["a"], batch["b"]]), pd.concat([batch["b"], batch["a"]]), strict=True
            ):
                matcher = SequenceMatcher(None, candidate, head)
                if matcher.quick_ratio() >= cutoff and (ratio := matcher.ratio()) >= cutoff:
                    found.append((head, candidate, ratio))
            yield pd.DataFrame(found, columns=["head", "candidate", "ratio"])

    return ratios


def candidate_pairs(names: DataFrame, cutoff: float) -> DataFrame:
    """Pairs ``a, b`` of names that may reach ``cutoff``; no pair that does is missing.

    A ratio of at least ``cutoff`` leaves at most ``d`` characters of the two names unmatched, where
    ``d`` follows from the two lengths. Cut the shorter name into ``d + 1`` segments: one of them,
    the i-th, survives whole with exactly ``i`` unmatched characters before it, so it occurs in the
    longer name shifted by at most ``i`` places. That is an equi-join on (lengths, i, segment).
    Letters that occur, or occur twice, in only one name are unmatched too, which is tested inside the
    join.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("cutoff must lie in (0, 1]")
    none = F.lit(0).cast("long")

    def add(seen: Column, c: Column) -> Column:
        bit = F.when(c == "", none).otherwise(
            F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)
        )
        return F.struct(
            seen["once"].bitwiseOR(bit).alias("once"),
            seen["twice"].bitwiseOR(seen["once"].bitwiseAND(bit)).alias("twice"),
        )

    letters = F.aggregate(F.split("name", ""), F.struct(none.alias("once"), none.alias("twice")), add)
    named = names.select(F.col("name"), F.length("name").alias("n"), letters.alias("bits")).where("n > 0")
    reach = (2 - cutoff) / cutoff

    def with_limits(df: DataFrame) -> DataFrame:
        least = F.ceil(F.lit(cutoff) * (F.col("short") + F.col("long")) / 2 - 1e-9)
        spare = (F.col("short") + F.col("long") - 2 * least).cast("int")
        part = F.explode(F.sequence(F.lit(0), F.col("d")))
        return (
            df.withColumn("d", spare)
            .where(least <= F.col("short"))
            .withColumn("i", part)
            .withColumn("at", F.expr("cast(i * short div (d + 1) as int)"))
            .withColumn("len", F.expr("cast((i + 1) * short div (d + 1) as int) - at"))
        )

    # sequence() counts down when its end is smaller, so the ends are clamped
    index = with_limits(
        named.withColumnRenamed("n", "short").withColumn(
            "long",
            F.explode(F.expr(f"sequence(short, greatest(short, cast(floor(short * {reach}D + 1e-9) as int)))")),
        )
    ).select(
        "short", "long", "i", "d",
        F.col("name").substr(F.col("at") + 1, F.col("len")).alias("segment"),
        F.col("name").alias("short_name"), F.col("bits").alias("short_bits"),
    )
    probe = (
        with_limits(
            named.withColumnRenamed("n", "long").withColumn(
                "short",
                F.explode(F.expr(f"sequence(least(long, cast(ceil(long / {reach}D - 1e-9) as int)), long)")),
            )
        )
        .withColumn("lo", F.expr("greatest(-i, long - short - (d - i), -at)"))
        .withColumn("hi", F.expr("least(i, long - short + (d - i), long - at - len)"))
        .withColumn("lo", F.expr("lo + pmod(lo - i, 2)"))
        .where("lo <= hi")
        .withColumn("shift", F.explode(F.expr("sequence(lo, hi, 2)")))
        .select(
            "short", "long", "i",
            F.col("name").substr(F.col("at") + F.col("shift") + 1, F.col("len")).alias("segment"),
            F.col("name").alias("long_name"), F.col("bits").alias("long_bits"),
        )
    )
    # Spark sizes the sides from before the explodes, far too small for a broadcast; a merge join
    # also lets adaptive execution split a segment that many names share
    return (
        index.join(probe.hint("merge"), ["short", "long", "i", "segment"])
        .where("short < long or short_name < long_name")
        .where(
            "bit_count(short_bits.once ^ long_bits.once) + bit_count(short_bits.twice ^ long_bits.twice) <= d"
        )
        .select(F.least("short_name", "long_name").alias("a"), F.greatest("short_name", "long_name").alias("b"))
        .distinct()
    )


def similar_pairs(df: DataFrame, key: str, cutoff: float = CUTOFF) -> DataFrame:
    """``head, candidate, ratio`` of all different names in ``key`` that are alike.

    The ratio is Ratcliff/Obershelp with the candidate as first and the head as second sequence;
    since it can depend on that order, each pair is tested both ways.
    """
    names = df.select(F.col(key).alias("name")).where(F.col(key).isNotNull()).distinct()
    return _pairs_of(materialize(names, "names"), cutoff)


def _pairs_of(names: DataFrame, cutoff: float) -> DataFrame:
    return candidate_pairs(names, cutoff).mapInPandas(_matches(cutoff), "head string, candidate string, ratio double")


def top_similar(pairs: DataFrame, n: int = TOP_N) -> DataFrame:
    """The best candidates per head; the head itself takes one of the ``n`` places."""
    best = Window.partitionBy("head").orderBy(F.desc("ratio"), F.desc("candidate"))
    return pairs.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n - 1)


def _drop_cooccurring(edges: DataFrame, seen: DataFrame) -> DataFrame:
    """Edges whose two names never occur in one source.

    Each edge is expanded through the rarer of its names only.
    """
    count = seen.groupBy("norm").agg(F.count("*").alias("n"))
    sized = edges.join(count.select(F.col("norm").alias("head"), F.col("n").alias("n_head")), "head").join(
        count.select(F.col("norm").alias("candidate"), F.col("n").alias("n_candidate")), "candidate"
    )
    rare_first = F.col("n_head") <= F.col("n_candidate")
    clash = (
        sized.select(
            "head", "candidate",
            F.when(rare_first, F.col("head")).otherwise(F.col("candidate")).alias("norm"),
            F.when(rare_first, F.col("candidate")).otherwise(F.col("head")).alias("other"),
        )
        .join(seen, "norm")
        .join(seen.select("source", F.col("norm").alias("other")), ["source", "other"], "left_semi")
        .select("head", "candidate")
        .distinct()
    )
    return edges.join(clash, ["head", "candidate"], "left_anti")


def _covered_by_rounds(edges: DataFrame) -> DataFrame:
    """Names that join an earlier head, in components too large for one task.

    Visiting names in sorted order and letting each free name take its free neighbours is the
    lexicographically first maximal independent set: per round every name without a smaller open
    neighbour becomes a head and its neighbours are covered. Isolated names are heads by default,
    so only edges are carried from round to round.
    """
    taken = []
    open_edges = edges.select("head", "candidate")
    left = 1 if edges.head(1) else 0
    while left:
        late = open_edges.select(F.col("candidate").alias("head")).distinct().withColumn("late", F.lit(True))
        marked = open_edges.join(late, "head", "left").withColumn("late", F.coalesce("late", F.lit(False)))
        covered = marked.where(~F.col("late")).select("candidate").distinct()
        step = (
            marked.join(covered.select("candidate", F.lit(True).alias("gone")), "candidate", "left")
            .join(covered.select(F.col("candidate").alias("head"), F.lit(True).alias("head_gone")), "head", "left")
            .withColumn("open", F.col("late") & F.col("gone").isNull() & F.col("head_gone").isNull())
            .select("head", "candidate", "late", "open")
        )
        step, left = materialize_counting(step, F.count_if("open"), "round")
        taken.append(step.where(~F.col("late")).select(F.col("candidate").alias("norm")))
        open_edges = step.where("open").select("head", "candidate")
    if not taken:
        return edges.select(F.col("candidate").alias("norm")).limit(0)
    return reduce(DataFrame.unionByName, taken).distinct()


def _taken_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Names that join an earlier head, from the edges of whole components in the order of heads."""
    component, covered = None, set()
    for batch in batches:
        found = []
        for root, head, candidate in zip(batch["root"], batch["head"], batch["candidate"], strict=True):
            if root != component:
                component, covered = root, set()
            # all edges of a lesser head come earlier, so it is known by now whether this one is taken
            if head not in covered and candidate not in covered:
                covered.add(candidate)
                found.append(candidate)
        yield pd.DataFrame({"norm": found}, dtype="object")


def _covered(edges: DataFrame, n: int) -> DataFrame:
    """Names that join an earlier head, where free names in sorted order take their free neighbours.

    Components do not touch each other, so each small one is decided by a single walk over its edges, sorted by
    head; a long chain of names costs no rounds. Few edges altogether are walked as one component.
    """
    walked = "norm string"
    if n <= WALKED:
        ordered = edges.select(F.lit("").alias("root"), "head", "candidate").coalesce(1).sortWithinPartitions("head", "candidate")
        return ordered.mapInPandas(_taken_in_order, walked)
    roots = component_roots(edges, "head", "candidate")
    # a root is no node of the table but the head of an edge; the candidate of an edge is never a root
    rooted = edges.join(roots.select(F.col("node").alias("candidate"), "root"), "candidate").select("root", "head", "candidate")
    sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    sized = materialize(rooted.join(sizes, "root"), "components")
    small = sized.where(F.col("n") <= WALKED).select("root", "head", "candidate")
    walks = small.repartition("root").sortWithinPartitions("root", "head", "candidate").mapInPandas(_taken_in_order, walked)
    giant = sized.where(F.col("n") > WALKED).select("head", "candidate")
    return walks.unionByName(_covered_by_rounds(giant))


def _split_clashes(members: DataFrame, cooccur: DataFrame) -> DataFrame:
    """Give every member that is not the first of its group in some source a group of its own."""
    rank = F.struct((~F.col("is_head")).alias("late"), (-F.col("ratio")).alias("far"), F.col("raw").alias("raw"))
    placed = cooccur.select("source", F.col("name").alias("raw")).join(members, "raw")
    first = (
        placed.groupBy("head", "source")
        .agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("head", "source", F.col("first.raw").alias("first"))
    )
    solo = (
        placed.join(first, ["head", "source"])
        .where(F.col("raw") != F.col("first"))
        .select("raw")
        .distinct()
        .withColumn("solo", F.col("raw"))
    )
    return members.join(solo, "raw", "left")


def group_columns(
    names: DataFrame | None = None,
    pairs: DataFrame | None = None,
    cooccur: DataFrame | None = None,
    veto: bool = True,
    exclusive: Sequence[str] = (),
    cutoff: float = CUTOFF,
    top_n: int | None = None,
) -> DataFrame:
    """Group raw names (column ``name``) around heads: ``ordinal, head, raw, ratio``.

    Names are taken in sorted order of their normalised form; each free one becomes a head and takes
    all free names like it. ``exclusive`` names form groups of their own. With ``veto`` two names
    that occur in one source (``cooccur``: ``source, name``) never share a group. Without ``names``,
    those in ``cooccur`` are grouped, which reads that input only once. ``top_n`` keeps a likeness
    only if it is among the best ``top_n`` of either name.
    """
    if veto and cooccur is None:
        raise ValueError("the veto needs the names' occurrences")
    if names is None and cooccur is None:
        raise ValueError("no names to group")
    seen = None
    if veto or names is None:
        seen = materialize(cooccur.select("source", "name").distinct(), "occurrences")
    vocabulary = materialize(
        (seen if names is None else names).select(F.col("name").alias("raw"), norm_name("name").alias("norm"))
        .where(F.col("raw").isNotNull())
        .distinct(),
        "vocabulary",
    )
    apart = F.col("norm").isin(sorted({norm_text(e) for e in exclusive}))
    free = vocabulary.where(~apart).select("norm").distinct()
    if pairs is None:
        pairs = _pairs_of(free.withColumnRenamed("norm", "name"), cutoff)
    if top_n is not None:
        kept = top_similar(pairs, top_n).select("head", "candidate")
        either = kept.unionByName(kept.select(F.col("candidate").alias("head"), F.col("head").alias("candidate")))
        pairs = pairs.join(either.distinct(), ["head", "candidate"], "left_semi")
    edges = pairs.where("head < candidate").select("head", "candidate", "ratio")
    if veto:
        edges = _drop_cooccurring(
            edges, seen.select("source", norm_name("name").alias("norm")).distinct()
        )
    edges, n = materialize_counting(edges, F.count(F.lit(1)), "edges")
    covered = materialize(_covered(edges, n), "covered")
    joined = (
        edges.join(covered.select(F.col("norm").alias("head")), "head", "left_anti")
        .join(covered.select(F.col("norm").alias("candidate")), "candidate", "left_semi")
        .groupBy(F.col("candidate").alias("norm"))
        .agg(F.min(F.struct("head", "ratio")).alias("taken"))
        .select("norm", "taken.head", "taken.ratio")
    )
    members = vocabulary.join(joined, "norm", "left").select(
        "raw",
        F.coalesce("head", "norm").alias("head"),
        F.coalesce("ratio", F.lit(1.0)).alias("ratio"),
        F.col("head").isNull().alias("is_head"),
    )
    if veto:
        members = _split_clashes(members, seen)
    else:
        members = members.withColumn("solo", F.lit(None).cast("string"))
    members = materialize(members, "members")
    groups = with_ordinal(members.select("head", "solo").distinct(), ["head", "solo"])
    return (
        members.withColumn("_solo", F.coalesce("solo", F.lit("")))
        .join(groups.select("head", F.coalesce("solo", F.lit("")).alias("_solo"), "ordinal"), ["head", "_solo"])
        .select("ordinal", F.when(F.col("solo").isNull(), F.col("head")).otherwise(norm_name("solo")).alias("head"), "raw", "ratio")
    )


def name_groups(groups: DataFrame, manual: Mapping[str, str] | None = None, prefix: str = PREFIX) -> DataFrame:
    """Turn groups into a mapping.

    A group of one keeps its spelling. Others take the name in ``manual`` of any member, compared
    in normalised form, or else ``prefix`` and their number. Names that would repeat, also in other
    letter case, go to the first group; later ones get a generated name.
    """
    sets = groups.groupBy("ordinal").agg(F.array_sort(F.collect_list("raw")).alias("variants"))
    generated = F.concat(F.lit(prefix), F.col("ordinal"))
    chosen = generated
    if manual:
        table = F.create_map(*[F.lit(x) for k, v in {norm_text(k): v for k, v in manual.items()}.items() for x in (k, v)])
        hits = F.filter(F.transform("variants", lambda v: F.try_element_at(table, norm_name(v))), lambda v: v.isNotNull())
        chosen = F.coalesce(F.try_element_at(hits, F.lit(1)), generated)
    named = sets.withColumn(
        "standard", F.when(F.size("variants") == 1, F.col("variants")[0]).otherwise(chosen)
    )
    same = Window.partitionBy(F.lower("standard")).orderBy("ordinal")
    return named.select(
        F.when(F.row_number().over(same) == 1, F.col("standard")).otherwise(generated).alias("standard"),
        "variants",
        "ordinal",
    )


def split_exclusive(mapping: DataFrame, exclusive: Sequence[str]) -> DataFrame:
    """Move exclusive columns into standards of their own, named by their normalised form.

    The other members keep the group's name.
    """
    normed = sorted({norm_text(e) for e in exclusive})
    members = mapping.select("standard", "ordinal", F.posexplode("variants").alias("rank", "variant"))
    own = norm_name("variant")
    return (
        members.withColumn("standard", F.when(own.isin(normed), own).otherwise(F.col("standard")))
        .groupBy("standard")
        .agg(
            F.array_sort(F.collect_list(F.struct("ordinal", "rank", "variant"))).alias("m"),
            F.min("ordinal").alias("ordinal"),
        )
        .select("standard", F.transform("m", lambda m: m["variant"]).alias("variants"), "ordinal")
    )


def require_columns(mapping: DataFrame, names: Sequence[str]) -> DataFrame:
    """Make sure that each of ``names`` is a standard.

    A standard with the same normalised name, or one that holds the name as a variant, is renamed,
    so that no column is mapped twice; otherwise the name is added as its own variant.
    """
    spark = mapping.sparkSession
    wanted = spark.createDataFrame(
        [(i, n, norm_text(n)) for i, n in enumerate(names)], "place int, required string, norm string"
    )
    missing = wanted.join(mapping.select(F.col("standard").alias("required")), "required", "left_anti")
    by_form = missing.join(
        mapping.select("standard", "ordinal", norm_name("standard").alias("norm")), "norm"
    ).select("standard", "required", "place", "ordinal", F.lit(False).alias("inside"))
    by_variant = missing.join(
        mapping.select("standard", "ordinal", F.explode("variants").alias("required")), "required"
    ).select("standard", "required", "place", "ordinal", F.lit(True).alias("inside"))
    holders = by_form.unionByName(by_variant).withColumn("order", F.struct("inside", "ordinal", "standard"))
    # one required name per standard and one standard per required name
    per_standard = Window.partitionBy("standard").orderBy("place")
    per_name = Window.partitionBy("required").orderBy("order")
    renames = (
        holders.withColumn("r", F.row_number().over(per_standard))
        .where("r = 1")
        .withColumn("r", F.row_number().over(per_name))
        .where("r = 1")
        .select("standard", "required")
    )
    kept = mapping.join(renames, "standard", "left").select(
        F.coalesce("required", "standard").alias("standard"), "variants", "ordinal"
    )
    added = missing.join(renames.select("required"), "required", "left_anti").select(
        F.col("required").alias("standard"),
        F.array("required").alias("variants"),
        F.lit(None).cast("int").alias("ordinal"),
    )
    return kept.unionByName(added)


def standard_of(df: DataFrame, column: str, mapping: DataFrame, out: str = "standard") -> DataFrame:
    """Add the standard name of the spelling in ``column``, in any letter case, else null."""
    long = (
        mapping.select("standard", "ordinal", F.explode("variants").alias("variant"))
        .groupBy(F.lower("variant").alias("_variant"))
        .agg(F.min_by("standard", F.struct(F.col("ordinal").isNull(), "ordinal", "standard")).alias(out))
    )
    return df.withColumn("_variant", F.lower(column)).join(long, "_variant", "left").drop("_variant")


def mapping_lines(mapping: DataFrame) -> DataFrame:
    """The two text columns of the CSV export."""
    name, variants = CSV_TITLES
    return mapping.select(
        F.col("standard").alias(name), F.array_join("variants", CSV_SEPARATOR).alias(variants)
    )


def write_mapping(mapping: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Export as JSON lines or as CSV with a title row."""
    if fmt == "json":
        mapping.write.mode(mode).json(path)
    elif fmt == "csv":
        mapping_lines(mapping).write.mode(mode).option("header", True).csv(path)
    else:
        raise ValueError(f"unknown mapping format {fmt!r}")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Read back a JSON export."""
    return spark.read.schema("standard string, variants array<string>, ordinal int").json(path)


def mapping_dict(mapping: DataFrame) -> dict[str, tuple[str, ...]]:
    """The mapping in order, for building projections; one entry per output column.

    A spelling under two standards is an error: one of them would silently stay empty.
    """
    rows = mapping.orderBy(F.col("ordinal").asc_nulls_last(), "standard").collect()
    owner: dict[str, str] = {}
    for row in rows:
        for variant in row.variants:
            if owner.setdefault(variant, row.standard) != row.standard:
                raise ValueError(f"{variant!r} is mapped to {owner[variant]!r} and {row.standard!r}")
    return {row.standard: tuple(row.variants) for row in rows}
