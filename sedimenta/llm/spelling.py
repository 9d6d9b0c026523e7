"""Spelling variants through a trie that is a table of edges.

The edges of two tries, of the words and of the words read backwards, are one distributed table: a node is the string
that leads to it, an edge its next character. Tables of states (word, position, node, edits) are joined with the edges
of their level, level by level. A state without an edit stands on the word's own path, which is in the trie, so it needs
no join to be there; at an edge it spends its one edit on another character or on one more. A state with its edit
follows the edge of its next character. At the end of a word with one edit and nothing left, the node is a neighbour.

Each neighbour is found from the shorter word of the two, or from the lesser character where they are of one
length, and then holds both ways. An edit in the second half of a word is found in the trie, one in the first half
in the backward trie, so a state's node is deep when it branches, and few words are below it.
An edge knows a sketch of what is below it: two 64-bit sets of hashes of the endings. A state whose rest is not in
both is dropped before the next level; nothing with a neighbour is.

Beyond ``DEPTH`` characters the rest of a word is a single edge, so the number of levels, each one Spark job whose result
is a table in the shared folder, has a bound.

Defined results: null and empty texts have no words. Runs longer than Spark's strings do not exist; long ones are words like
others. Ids of any type are taken as text, a null id as an empty one. Repeated rows count their words again. Equal
counts are ordered by code points. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.text import lower_ascii
from sedimenta.session import materialize, materialize_counting, scratch_path

#: What words are made of, and what a word and a form have to be.
NO_LETTER = r"[^a-z\x{C0}-\x{FF}]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_TIMES = 5
#: A run loses a character where its hash is a multiple of this.
DELETED_EACH = 199
#: Characters after which the rest of a word is one edge.
DEPTH = 24


def deleted(run: Column, key: Column) -> Column:
    """The run without the character that its hash names, if its hash says so."""
    digest = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (digest % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(digest % DELETED_EACH == 0, shorter).otherwise(run)


def vocabulary(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    change: Callable[[Column, Column], Column] | None = deleted,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word, n``: the frequent words of all whole texts, after ``change(run, id)`` where one is given."""
    runs = F.split(lower_ascii(F.coalesce(docs[text], F.lit(""))), NO_LETTER)
    long_enough = F.filter(runs, lambda r: F.length(r) >= least_length)
    plain = docs.select(docs[key].alias("id"), F.explode(long_enough).alias("run"))
    word = F.col("run") if change is None else change(F.col("run"), F.col("id"))
    counted = plain.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _sketch(rest: Column, seed: int) -> Column:
    """One bit of 64 for an ending; the two seeds give independent bits."""
    bit = F.pmod(F.shiftrightunsigned(F.xxhash64(rest), seed), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _symbol(rest: Column, level: Column) -> Column:
    """The next edge of a word: one character, or all that is left where the trie ends."""
    return F.when(level >= DEPTH, rest).otherwise(F.substring(rest, 1, 1))


def _after(text: Column, n: Column) -> Column:
    return F.substring(text, n + 1, F.length(text))


def _sides(words: DataFrame) -> DataFrame:
    """Each word as read in both tries: ``back, path, word, n``."""
    paths = F.array(
        F.struct(F.lit(False).alias("back"), F.col("word").alias("path")),
        F.struct(F.lit(True).alias("back"), F.reverse("word").alias("path")),
    )
    return words.select("word", "n", F.inline(paths))


def trie_edges(words: DataFrame) -> DataFrame:
    """``back, level, node, symbol, ends, first, second``: an edge, the count of the word that ends there, the sketch."""
    length = F.length("path")
    levels = F.explode(F.sequence(F.lit(0), F.least(length - 1, F.lit(DEPTH))))
    level = F.col("level")
    rest = _after(F.col("path"), level)
    symbol = _symbol(rest, level)
    steps = (
        _sides(words)
        .withColumn("level", levels)
        .select(
            "back", "level", "n", F.substring(F.col("path"), F.lit(1), level).alias("node"), symbol.alias("symbol"),
            _after(rest, F.length(symbol)).alias("below"),
        )
    )
    return steps.groupBy("back", "level", "node", "symbol").agg(
        F.max(F.when(F.col("below") == "", F.col("n"))).alias("ends"),
        F.bit_or(_sketch(F.col("below"), 0)).alias("first"),
        F.bit_or(_sketch(F.col("below"), 32)).alias("second"),
    )


def _own_states(words: DataFrame) -> DataFrame:
    """The states without an edit where one may be spent: on the word's own path, from its middle on."""
    length = F.length("path")
    middle = F.floor(length / 2)
    begin = F.least(F.when(F.col("back"), length - middle).otherwise(middle), F.lit(DEPTH))
    return (
        _sides(words)
        .withColumn("level", F.explode(F.sequence(begin.cast("int"), F.least(length, F.lit(DEPTH)))))
        .select(
            "back", "level", F.substring(F.col("path"), F.lit(1), F.col("level")).alias("node"),
            _after(F.col("path"), F.col("level")).alias("rest"), F.lit(0).alias("edits"), "word", "n",
        )
    )


def _step(states: DataFrame, edges: DataFrame, level: int) -> DataFrame:
    """The states of the next level; where an edit is spent, the one longer or greater word is looked for."""
    rest, symbol = F.col("rest"), F.col("symbol")
    follow = _symbol(rest, F.lit(level))
    spent = F.col("edits") == 1
    if level < DEPTH:
        after, same = _after(rest, F.lit(1)), symbol == follow
        nexts = F.when(spent, F.array(F.when(same, after))).otherwise(
            # one other character, or one more; a character added to a run of its own is added at the end
            F.array(F.when((rest != "") & (symbol > follow), after), F.when((rest == "") | ~same, rest))
        )
    else:
        one = F.levenshtein(symbol, rest, 1) == 1
        longer = (F.length(symbol) > F.length(rest)) | ((F.length(symbol) == F.length(rest)) & (symbol > rest))
        nexts = F.array(F.when(F.when(spent, symbol == rest).otherwise(one & longer), F.lit("")))
    possible = (F.col("first").bitwiseAND(_sketch(F.col("left"), 0)) != 0) & (
        F.col("second").bitwiseAND(_sketch(F.col("left"), 32)) != 0
    )
    return (
        states.join(edges, ["back", "node"])
        .withColumn("left", F.explode(nexts))
        .where(F.col("left").isNotNull() & possible)
        .select(
            "back", F.concat("node", "symbol").alias("node"), F.col("left").alias("rest"), F.lit(1).alias("edits"),
            "word", "n", F.when(F.col("left") == "", F.col("ends")).alias("ends"),
        )
    )


def _by_level(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder with a folder for each level, so that a level reads its own rows only."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy("level").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: all pairs of words that differ by one inserted, deleted or replaced character, both ways."""
    edges = _by_level(trie_edges(words), "edges")
    own = _by_level(_own_states(words), "paths")
    ends = own.agg(F.min("level"), F.max("level")).first()
    found = []
    carried, alive = None, 0
    for level in range(ends[0], ends[1] + 1) if ends[0] is not None else ():
        states = own.where(F.col("level") == level).drop("level")
        if alive:
            states = states.unionByName(carried)
        step = _step(states, edges.where(F.col("level") == level).drop("level"), level)
        table, alive = materialize_counting(step, F.count_if(F.col("rest") != ""), "states")
        found.append(table.where(F.col("ends").isNotNull()))
        carried = table.where(F.col("rest") != "").drop("ends")
    if not found:
        return words.sparkSession.createDataFrame([], "word string, n long, near string, near_n long")
    near = F.when(F.col("back"), F.reverse("node")).otherwise(F.col("node"))
    pairs = reduce(DataFrame.unionByName, found).select("word", "n", near.alias("near"), F.col("ends").alias("near_n")).distinct()
    return pairs.unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )


def _rooted(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of each word's forms. A form is several times as frequent, so that no forms go round,
    and looking up the form's form doubles what is known each time."""
    known = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    moved = known.limit(1).count()
    while moved:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = known.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        table, moved = materialize_counting(step, F.count_if("moved"), "roots")
        known = table.drop("moved")
    return known


def spelling_groups(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word in ``words`` (``word, n``, distinct).

    The form is the most frequent neighbour if it is at least ``times`` as frequent; the root is the last form of forms.
    """
    words = materialize(words, "words")
    near = neighbours(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    grouped = near.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = -F.col("best.less") >= times * F.col("n")
    judged = materialize(
        grouped.select(
            "word", "n_near", F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")
        ),
        "neighbours",
    )
    roots = _rooted(judged.where("form is not null"))
    return (
        words.join(judged, "word", "left")
        .join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )
