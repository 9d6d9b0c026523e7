"""Quality rules: a threshold table compiled into one projection.

Every document is measured and judged in one pass by built-in expressions; there is no shuffle and no
user function, so the plan is a scan followed by projections at any size.

Defined results: a null text has no words, so it fails the base rules (``base_failed``) and is not
kept. Null ids, repeated rows and ties do not matter, as each row is judged alone and gives one row.
An empty table gives an empty result. Other columns of the input are ignored by ``score_documents``
and kept by ``keep_documents``. Texts of any length are read whole: work grows as n log n in their words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.text import BLANK, blank_words, let

#: Words in a window that counts as repeated when it occurs twice in a text.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a", "al", "als", "an", "and", "are", "as", "at", "au", "auf", "aus", "aux", "avec", "be", "bei", "by", "ce",
    "como", "con", "dans", "das", "de", "del", "dem", "den", "der", "des", "die", "du", "durch", "e", "ein", "eine",
    "einem", "einen", "einer", "el", "elle", "en", "er", "es", "est", "et", "for", "from", "für", "had", "has",
    "have", "he", "ich", "il", "im", "in", "is", "ist", "it", "la", "las", "le", "les", "lo", "los", "mais", "mit",
    "más", "ne", "nicht", "no", "not", "o", "of", "on", "or", "ou", "par", "para", "pas", "pero", "por", "pour",
    "que", "qui", "se", "sich", "sie", "son", "su", "sur", "that", "the", "they", "this", "to", "un", "una", "und",
    "une", "von", "was", "were", "which", "with", "y", "zu", "zum", "zur",
)


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low <= top / bottom <= high``; an open side is None."""

    name: str
    top: str
    bottom: str
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        ratio = F.col(self.top) / F.greatest(F.col(self.bottom), F.lit(1))
        broken = F.lit(False)
        if self.low is not None:
            broken = broken | (ratio < self.low)
        if self.high is not None:
            broken = broken | (ratio > self.high)
        return broken


#: The verdict's threshold table over the measures below.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("letters", "n_letters", "word_chars", low=0.5),
    Rule("shouting", "n_capitals", "n_letters", high=0.6),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.3),
)
BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _joined(keys: Column, step: int) -> Column:
    """Keys of runs twice as long: the key at i with the key at ``i + step``."""
    left = F.slice(keys, F.lit(1), F.greatest(F.size(keys) - step, F.lit(0)))
    right = F.slice(keys, F.lit(1 + step), F.size(keys))
    return F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))


def _with_window_keys(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add a 64-bit key for each run of WINDOW words, a power of two, by doubling runs of one."""
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)))
    step = 1
    while step < WINDOW:
        df = df.withColumn(out, _joined(F.col(out), step))
        step *= 2
    return df


def _repeated_starts(words: Column, keys: Column) -> Column:
    """Where windows start that the text has more than once; equal keys are compared word by word."""
    placed = F.sort_array(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(
            (a["key"] == b["key"])
            & (F.slice(words, a["at"] + 1, WINDOW) == F.slice(words, b["at"] + 1, WINDOW)),
            F.lit(False),
        )

    def repeated(order: Column) -> Column:
        marked = F.transform(
            order,
            lambda x, k: F.when(same(F.get(order, k - 1), x) | same(x, F.get(order, k + 1)), x["at"]),
        )
        return F.sort_array(F.filter(marked, lambda at: at.isNotNull()))

    return let(placed, repeated)


def _covered(starts: Column) -> Column:
    """Words in the union of windows that start at ``starts``."""
    steps = F.transform(
        starts, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW)))
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _repeated_words(words: Column, keys: Column) -> Column:
    """Number of words in windows found twice or more, first occurrences included."""
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(
        let(_repeated_starts(words, keys), _covered)
    )


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add all measures the table uses. The names must not be taken yet."""
    body = F.coalesce(F.col(text), F.lit(""))

    def length_without(pattern: str) -> Column:
        return F.length(F.regexp_replace("_solid", pattern, ""))

    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumns({"_words": blank_words(F.col(text)), "_lines": lines})
    split = _with_window_keys(split.withColumn("_solid", F.array_join("_words", "")), "_words", "_keys")
    words, rows, solid = F.col("_words"), F.col("_lines"), F.col("_solid")
    longs = {
        "n_words": F.size(words),
        "word_chars": F.length(solid),
        "n_symbols": length_without("[^#*$%&|<>]+"),
        "n_dup_lines": F.size(rows) - F.size(F.array_distinct(rows)),
        "n_repeat_words": _repeated_words(words, F.col("_keys")),
        "n_letters": length_without(r"\P{L}+"),
        "n_capitals": length_without(r"\P{Lu}+"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size(rows),
        "n_bullet_lines": F.size(F.filter(rows, lambda r: r.rlike("^" + BLANK + r"*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter(rows, lambda r: r.rlike(r"(\.\.\.|…)" + BLANK + "*$"))),
    }
    return split.withColumns({name: value.cast("long") for name, value in longs.items()}).drop("_words", "_lines", "_solid", "_keys")


def _judged(measured: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    n_words, repeats = F.col("n_words"), F.col("n_repeat_words")
    base = (n_words < MIN_WORDS) | (repeats * 100 > n_words * MAX_REPEATED_PERCENT)
    failed = F.concat_ws(",", *[F.when(rule.fails(), F.lit(rule.name)) for rule in rules])
    return (
        measured.withColumns({"base_failed": base, "failed": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed") == ""))
    )


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per document: the measures, ``base_failed``, the names of failed rules, and ``kept``."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))
    return _judged(with_measures(plain, "_text"), rules).drop("_text")


def keep_documents(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with all their columns."""
    packed = docs.select(F.struct("*").alias("_row"), docs[text].alias("_text"))
    # counted where judged; the metrics also keep the filter from being computed anew below the projections
    judged = _judged(with_measures(packed, "_text"), rules).observe(
        "quality_rules", F.count(F.lit(1)).alias("documents"), F.count_if("kept").alias("kept")
    )
    return judged.filter("kept").select("_row.*")
