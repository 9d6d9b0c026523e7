"""Benchmark decontamination with a distributed positional inverted index.

1. Test items become windows of N words (a shorter item is one window). Equal windows are one.
2. Term counts over all documents rank the words of each window; its ANCHORS rarest positions are its
   anchors. Windows with a word that no document has are out.
3. The index: one posting (term, document, position) per occurrence of an anchor term, as a table.
4. Lists are shifted by the anchors' offsets and intersected: a document is a candidate for a window at
   a start if all anchors of the window point to that start. Candidates are compared word by word.
   For proximity matches the anchors may point to different starts, up to ``slop`` words apart, and so may the other words.

All of it is DataFrame expressions. Shuffled rows are postings of rare terms, not texts; texts move
once, for the comparison. Hot terms are pre-aggregated when counted, and skewed joins are left to
adaptive execution. Anchors are broadcast only if counted to be at most SMALL rows.

Defined results: a null text has no words: no hits, not contaminated. Null ids are carried, and equal
to each other; rows with the same id and text have the same result, one row each; rows with one id
and different texts are different documents. Null item texts and items without words have no windows;
a null item id is not listed. Empty tables: no rows, or no hits. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.text import plain_words
from sedimenta.session import materialize, materialize_counting

N = 13
ANCHORS = 3
SLOP = 4
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20
#: Rows up to which anchors are broadcast (some 50 bytes each); beyond it Spark joins them by shuffle.
SMALL = 200_000
_BUCKET = 16


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id``, ``mark`` (tells texts of one id apart) and ``text``."""
    return docs.select(
        docs[key].alias("doc_id"), F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("mark"), docs[text].alias("text")
    )


def _split(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "mark", plain_words(F.col("text")).alias("words"))


def test_windows(items: DataFrame, key: str = "item_id", text: str = "text", n: int = N) -> DataFrame:
    """(item_id, phrase) of every window; words of a phrase are joined with spaces."""
    words = F.col("words")
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    phrases = F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    split = items.select(items[key].alias("item_id"), plain_words(items[text]).alias("words"))
    return split.filter(F.size(words) > 0).select("item_id", F.explode(phrases).alias("phrase")).distinct()


class PhraseIndex:
    """Postings of all documents for the anchor terms of the test windows."""

    def __init__(
        self,
        docs: DataFrame,
        items: DataFrame,
        key: str = "doc_id",
        text: str = "text",
        item_key: str = "item_id",
        item_text: str = "text",
        n: int = N,
        anchors: int = ANCHORS,
    ) -> None:
        self.texts = _documents(docs, key, text)
        self.docs = _split(self.texts)
        self.items = materialize(test_windows(items, item_key, item_text, n), "test-windows")
        distinct = self.items.select("phrase").distinct()
        self.windows = materialize(
            distinct.select(
                F.monotonically_increasing_id().alias("window"), "phrase", F.size(F.split("phrase", " ")).alias("length")
            ),
            "windows",
        )
        self.anchors, self.n_anchors = self._anchors(anchors)
        self.postings = self._postings()

    def _anchors(self, most: int) -> tuple[DataFrame, int]:
        """(term, window, offset, bit, all_bits): the rarest positions of each window."""
        placed = self.windows.select("window", "length", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
        terms = placed.select("term").distinct()
        counts = self.docs.select(F.explode("words").alias("term")).groupBy("term").count()
        known = materialize(counts.join(terms, "term"), "term-counts")
        by_rarity = Window.partitionBy("window").orderBy("count", "offset")
        whole = Window.partitionBy("window")
        ranked = (
            placed.join(known, "term")
            .withColumn("found", F.count(F.lit(1)).over(whole))
            .filter(F.col("found") == F.col("length"))
            .withColumn("nth", F.row_number().over(by_rarity) - 1)
            .filter(F.col("nth") < most)
        )
        bit = F.pow(F.lit(2), F.col("nth")).cast("int")
        all_bits = F.pow(F.lit(2), F.least(F.col("length"), F.lit(most))).cast("int") - 1
        return materialize_counting(
            ranked.select("term", "window", "offset", bit.alias("bit"), all_bits.alias("all_bits")),
            F.count(F.lit(1)),
            "anchors",
        )

    def _sized(self, side: DataFrame) -> DataFrame:
        return F.broadcast(side) if self.n_anchors <= SMALL else side

    def _postings(self) -> DataFrame:
        terms = self.anchors.select("term").distinct()
        found = self.docs.select("doc_id", "mark", F.posexplode("words").alias("position", "term"))
        return materialize(found.join(self._sized(terms), "term"), "postings")

    def _pointed(self) -> DataFrame:
        """Each posting as the window starts it points to."""
        return (
            self.postings.join(self._sized(self.anchors), "term")
            .withColumn("start", F.col("position") - F.col("offset"))
            .select("doc_id", "mark", "window", "start", "bit", "all_bits")
        )

    def candidates(self) -> DataFrame:
        """(doc_id, mark, window, start) where all anchors of the window agree."""
        return (
            self._pointed()
            .filter("start >= 0")
            .groupBy("doc_id", "mark", "window", "start", "all_bits")
            .agg(F.bit_or("bit").alias("bits"))
            .filter("bits = all_bits")
            .drop("bits", "all_bits")
        )

    def exact_matches(self) -> DataFrame:
        """(doc_id, mark, hits, n_words): per document with a phrase, an array of window, start and length."""
        hit = F.struct("window", "start", "length", "phrase")
        wanted = (
            self.candidates()
            .join(self.windows, "window")
            .groupBy("doc_id", "mark")
            .agg(F.collect_list(hit).alias("hits"))  # bounded by the places of one document
        )
        # texts move, not their words, which are several times as large
        texts = self.texts
        same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["mark"] == wanted["mark"])
        found = texts.join(wanted, same).select(texts["doc_id"], texts["mark"], "text", "hits")
        split = found.withColumn("words", plain_words(F.col("text")))
        checked = split.select(
            "doc_id",
            "mark",
            F.filter(
                "hits",
                lambda h: F.array_join(F.slice("words", h["start"] + 1, h["length"]), " ") == h["phrase"],
            ).alias("hits"),
            F.size("words").alias("n_words"),
        )
        return checked.filter(F.size("hits") > 0).dropDuplicates(["doc_id", "mark"])

    def near_matches(self, slop: int = SLOP) -> DataFrame:
        """(doc_id, mark, window) of the windows all of whose words stand near each other.

        From some start on, each word of the window has a place at most ``slop`` words behind its own one, so words may be
        put in between, or change places a little. Documents whose anchors point to starts within ``slop`` words of
        each other are candidates; their words are compared.
        """
        start, width = F.col("start"), F.lit(_BUCKET)
        own = F.floor(start / width)
        # a group of starts at most slop apart lies in the bucket of its least start, or just behind it
        before = F.floor((start - slop) / width)
        buckets = F.array_distinct(F.array(own, before) if slop <= _BUCKET else F.sequence(before, own))
        seen = F.col("seen")

        def complete(first: Column) -> Column:
            inside = F.filter(seen, lambda s: s["start"].between(first["start"], first["start"] + slop))
            return F.aggregate(inside, F.lit(0), lambda bits, s: bits.bitwiseOR(s["bit"])) == F.col("all_bits")

        wanted = (
            self._pointed()
            .withColumn("bucket", F.explode(buckets))
            .groupBy("doc_id", "mark", "window", "bucket", "all_bits")
            .agg(F.collect_set(F.struct("start", "bit")).alias("seen"))  # at most a few per word of a bucket
            .withColumn("firsts", F.array_distinct(F.transform(F.filter(seen, complete), lambda s: s["start"])))
            .where(F.size("firsts") > 0)
            .join(self.windows, "window")
            .groupBy("doc_id", "mark")
            .agg(F.collect_list(F.struct("window", "firsts", F.split("phrase", " ").alias("terms"))).alias("near"))
        )
        texts = self.texts
        same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["mark"] == wanted["mark"])
        found = texts.join(wanted, same).select(texts["doc_id"], texts["mark"], plain_words(F.col("text")).alias("words"), "near")

        def stands(at: Column, term: Column) -> Column:
            """Whether a term has a place from ``at`` to ``slop`` words behind."""
            least = F.greatest(at, F.lit(0))
            return F.array_contains(F.slice("words", least + 1, F.greatest(at + slop + 1 - least, F.lit(0))), term)

        def matches(near: Column) -> Column:
            # the anchors' least start may be up to slop words behind that of all words
            starts = F.array_distinct(F.flatten(F.transform(near["firsts"], lambda s: F.sequence(s - slop, s))))
            return F.exists(
                starts, lambda s: ~F.exists(F.transform(near["terms"], lambda term, i: stands(s + i, term)), lambda there: ~there)
            )

        checked = found.select("doc_id", "mark", F.explode(F.filter("near", matches)).alias("near"))
        return checked.select("doc_id", "mark", "near.window").distinct()


def _covered(hits: Column) -> Column:
    """Words in the union of the hits' places."""
    spans = F.sort_array(
        F.array_distinct(F.transform(hits, lambda h: F.struct(h["start"].alias("s"), (h["start"] + h["length"]).alias("e"))))
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(total: Column, span: Column) -> Column:
        more = F.greatest(F.lit(0), span["e"] - F.greatest(total["end"], span["s"]))
        return F.struct(F.greatest(total["end"], span["e"]).alias("end"), (total["n"] + more).alias("n"))

    return F.aggregate(spans, zero, add)["n"]


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", n: int = N
) -> DataFrame:
    """Per document row: words, words inside test windows, items found, and the verdict."""
    index = PhraseIndex(docs, items, key, text, n=n)
    exact = materialize(index.exact_matches(), "matches")
    covered = exact.select("doc_id", "mark", _covered(F.col("hits")).cast("long").alias("n_hit"))
    found = (
        exact.select("doc_id", "mark", F.explode(F.array_distinct(F.transform("hits", lambda h: h["window"]))).alias("window"))
        .join(index.windows, "window")
        .join(index.items, "phrase")
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids"))
    )

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        other = right.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), right[right.columns[-1]])
        same = left["doc_id"].eqNullSafe(other["_id"]) & (left["mark"] == other["_mark"])
        return left.join(other, same, how).drop("_id", "_mark")

    sizes = index.docs.select("doc_id", "mark", F.size("words").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    item_ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined(joined(sizes, covered, "left"), found, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(item_ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(item_ids), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Contaminated ones are counted; up to SMALL of them are broadcast, so that the texts are not shuffled.
    """
    index = PhraseIndex(docs, items, key, text)
    judged = index.exact_matches().withColumn("n_hit", _covered(F.col("hits")))
    found, n = materialize_counting(
        judged.filter(F.col("n_hit") * SHARE >= F.col("n_words")).select("doc_id", "mark"), F.count(F.lit(1)), "contaminated"
    )
    packed = docs.select(F.struct("*").alias("_row"), F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("_mark"))
    guilty = packed["_row"][key].eqNullSafe(found["doc_id"]) & (packed["_mark"] == found["mark"])
    return packed.join(F.broadcast(found) if n <= SMALL else found, guilty, "left_anti").select("_row.*")
