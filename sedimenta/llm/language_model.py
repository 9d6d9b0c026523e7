"""Language-model scores by weighted backoff automata, from the counts of all n-grams.

The model: an n-gram of two or three words that occurs at least LEAST times in the training documents has its
discounted share of its history's count; any other backs off to the next shorter history, with the weight that makes
probabilities sum to one. Single words have add-one shares. LEAST is fixed, so the n-grams kept grow with the corpus.

Documents are read once and packed, as word numbers, into slices of about SLICE_BYTES. A slice counts its distinct
n-grams and sends the counts to buckets, which are ranges of keys; a bucket adds them up and answers each slice with the
totals. Words and pairs go first; triples only follow if both of their pairs occur LEAST times, as the others cannot. The
first slice of an n-gram adds its share to its history, once over all; histories are summed and answered likewise. Then
each slice has complete counts and weights, builds its automaton from them, and runs its texts through it: a state is a
history with n-grams of its own, an arc a kept n-gram, and where a state has no arc for a word its failure arc leads to the next
shorter history at the price of its weight. Texts are cut into runs that go left to right side by side, each carrying its state.

Slices and answers are tables bucketed by slice, so a visit to the slices shuffles neither. Nothing is broadcast. A bucket holds the
n-grams of a fixed number of tokens; slices and buckets grow in number with the corpus, and a slice sends a row to each bucket
that it has n-grams for. These rows grow faster than the corpus until a bucket has less than one n-gram of a
slice; there are never more of them than n-grams. The bucket of a frequent word has a row from every slice.

Keys are hashes besides the order, of 62 bits for words and 50 bits for pairs and triples. Among a billion distinct words two
share a key with a chance of about 1 in 10, and among a billion distinct pairs about 450 times two are counted as one.

Defined results: a null text is empty, that is one end token. A null id counts as empty text when documents are
split, so it is for training. Repeated rows count, and are scored, as often as they occur. An empty table gives
an empty result; without training documents every token has probability one. Other columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.text import lowered_bytes
from sedimenta.session import scratch_path, ship

#: Least count of an n-gram with a share of its own.
LEAST = 2
DISCOUNT = 0.5
FOLDS, HELD_OUT = 7, 2
#: Text of a slice, and tokens whose n-grams of one order go to one bucket.
SLICE_BYTES, BUCKET_TOKENS = 8 << 20, 2 << 20
ROW_BYTES = 16
#: Slices to a table bucket, on average, and tokens that a run of the traversal goes on for.
BUCKETED, RUN = 4, 256


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keyed(hashes: np.ndarray, order: int) -> np.ndarray:
    kept = hashes >> np.uint64(2)
    if order > 1:  # fewer bits, which a sorted column of keys holds in fewer bytes
        kept = kept & ~np.uint64((1 << 12) - 1)
    return kept | np.uint64(order << 62)


def _hashed(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


# No word holds a line feed.
_START_WORD, _END_WORD = b"\n\n", b"\n"
_START_KEY = int(_keyed(np.array([_hashed(_START_WORD)], np.uint64), 1)[0])


def _packed(values: np.ndarray) -> bytes:
    """First bytes of all values, then second ones and so on: the high bytes are mostly alike."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes))


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _bounds(bits: int) -> np.ndarray:
    """Least key of each bucket."""
    return np.array([o << 62 | b << 62 - bits for o in (1, 2, 3) for b in range(1 << bits)], np.uint64)


def _rows(part: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """The slices of a batch, one at a time."""
    for i in range(part.num_rows):
        yield part.slice(i, 1).to_pylist()[0]


def _slicer(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per slice: its number, tokens, ids and folds as Arrow, and its texts as word numbers."""

    def made(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        docs = pa.Table.from_batches(parts)
        out = pa.BufferOutputStream()
        carried = docs.select(["doc_id", "held_out"])
        with pa.ipc.new_stream(out, carried.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(carried)
        sizes, words, hashes = _coded(docs["text"].to_pylist())
        # the most frequent word as number 0 and so on, so that most tokens need one byte
        common = np.argsort(-np.bincount(words, minlength=len(hashes)), kind="stable").astype(np.int32)
        place = np.empty_like(common)
        place[common] = np.arange(len(common), dtype=np.int32)
        coded = [_packed(sizes), _packed(place[words]), _packed(common), _packed_keys(hashes)]
        row = [[number], [len(words)], [out.getvalue().to_pybytes()], *[[c] for c in coded]]
        kinds = [pa.int64()] * 2 + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], _SLICE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pending: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            at = 0
            for i, length in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), start=1):
                held += length + ROW_BYTES
                if held >= size:
                    yield made([*pending, batch.slice(at, i - at)], number)
                    pending, held, at, number = [], 0, i, number + 1
            if at < batch.num_rows:
                pending.append(batch.slice(at))
        if pending:
            yield made(pending, number)

    return run


_SLICE_NAMES = ["slice", "tokens", "docs", "sizes", "words", "common", "hashes"]
_SLICE = "slice long, tokens long, docs binary, sizes binary, words binary, common binary, hashes binary"


def _coded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, word numbers of all texts with both ends, and the hash of each number; numbers are sorted by hash."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    start, end = numbers[_START_WORD], numbers[_END_WORD]
    sequence, sizes = array("i"), []
    for text in texts:
        words = lowered_bytes(text).split()
        sizes.append(len(words) + 2)
        sequence.append(start)
        sequence.extend(map(numbers.__getitem__, words))
        sequence.append(end)
    hashes = np.array([_hashed(w) for w in numbers], np.uint64)
    by_key = np.argsort(hashes)
    rank = np.empty(len(by_key), np.int32)
    rank[by_key] = np.arange(len(by_key))
    return np.array(sizes, np.int64), rank[np.frombuffer(sequence, np.int32)], hashes[by_key]


class _Grams:
    """The distinct words and pairs of a slice, sorted by key, and where they occur; triples once ``answered``."""

    def __init__(self, row: dict) -> None:
        self.docs = pa.ipc.open_stream(row["docs"]).read_all()
        self.sizes = _unpacked(row["sizes"], np.int64)
        self.words = _unpacked(row["common"], np.int32)[_unpacked(row["words"], np.int32)]
        hashes = _unpacked_keys(row["hashes"])
        self.starts = np.cumsum(self.sizes) - self.sizes
        train = ~self.docs["held_out"].to_numpy().astype(bool)
        self.trained = np.repeat(train, self.sizes).astype(np.float64)
        later = np.ones(len(self.words), bool)
        later[self.starts] = False
        at2 = np.flatnonzero(later)
        later[self.starts + 1] = False
        self.at3 = np.flatnonzero(later)
        self.each = hashes[self.words]
        self.mixed = np.zeros(len(self.each), np.uint64)
        self.mixed[1:] = _mixed(self.each[:-1], self.each[1:])
        two, first, inverse = np.unique(_keyed(self.mixed[at2], 2), return_index=True, return_inverse=True)
        # which distinct pair ends at each place
        self.pairs = np.zeros(len(self.each), np.int32)
        self.pairs[at2] = inverse
        self.keys = [_keyed(hashes, 1), two]
        self.counts = [
            np.bincount(self.words, weights=self.trained, minlength=len(hashes)).astype(np.int64),
            np.bincount(inverse, weights=self.trained[at2], minlength=len(two)).astype(np.int64),
        ]
        self.head2, self.word2 = self.words[at2[first] - 1], self.words[at2[first]]

    def answered(self, answers: np.ndarray, floor: int) -> None:
        """Take complete counts of words and pairs."""
        one, two = np.split(answers >> 1, [len(self.keys[0])])
        self.owned2 = (answers[len(one) :] & 1).astype(bool)
        self.known, self.word, self.two = one > 0, (one + 1) / floor, two
        self.has2 = two >= LEAST
        self.share2 = np.where(self.has2, (two - DISCOUNT) / np.maximum(one[self.head2], 1), 1)
        #: histories that can have n-grams of their own
        self.histories = [np.flatnonzero(one >= LEAST), np.flatnonzero(self.has2)]
        self.at3 = self.at3[self.has2[self.pairs[self.at3 - 1]] & self.has2[self.pairs[self.at3]]]
        triples = _keyed(_mixed(self.mixed[self.at3 - 1], self.each[self.at3]), 3)
        self.three, first, self.inverse3 = np.unique(triples, return_index=True, return_inverse=True)
        self.counts3 = np.bincount(self.inverse3, weights=self.trained[self.at3], minlength=len(self.three)).astype(np.int64)
        at3 = self.at3[first]
        self.head3, self.tail3 = self.pairs[at3 - 1], self.pairs[at3]

    def answered3(self, answers: np.ndarray) -> None:
        """Take complete counts of triples."""
        three = answers >> 1
        self.owned3, self.has3 = (answers & 1).astype(bool), three >= LEAST
        self.share3 = np.where(self.has3, (three - DISCOUNT) / np.maximum(self.two[self.head3], 1), 1)

    def sums(self, order: int) -> list[np.ndarray]:
        """Histories of one order by key, and what the n-grams this slice adds give each: their shares, and the shorter history's."""
        has, owned, head, share, lower = (
            (self.has2, self.owned2, self.head2, self.share2, self.word[self.word2])
            if order == 1
            else (self.has3, self.owned3, self.head3, self.share3, self.share2[self.tail3])
        )
        own, keys, ids = has & owned, self.keys[order - 1], self.histories[order - 1]
        return [keys[ids], *(np.bincount(head[own], weights=w[own], minlength=len(keys))[ids] for w in (share, lower))]

    def scores(self, weights1: np.ndarray, weights2: np.ndarray, run: int) -> list[np.ndarray]:
        """Per text: known tokens, add-one score and the model's."""
        known, base = self.known[self.words].astype(np.int64), np.log10(self.word)[self.words]
        score = _Automaton(self, weights1, weights2).traversed(run)
        for each in (known, base, score):
            each[self.starts] = 0
        return [np.add.reduceat(each, self.starts) for each in (known, base, score)]


class _Automaton:
    """Transition and failure arrays over the n-grams of a slice.

    State 0 is the root; then come the words and the pairs that are histories of kept n-grams. Arcs are
    numbered like n-grams: words, which leave the root, then pairs, which leave words, then triples, which leave pairs.
    """

    def __init__(self, grams: _Grams, weights1: np.ndarray, weights2: np.ndarray) -> None:
        self.grams = grams
        words, pairs, triples = len(grams.keys[0]), len(grams.keys[1]), len(grams.three)
        ones, twos = grams.histories
        word_state, pair_state = np.zeros(words, np.int32), np.zeros(pairs, np.int32)
        word_state[ones] = 1 + np.arange(len(ones), dtype=np.int32)
        pair_state[twos] = 1 + len(ones) + np.arange(len(twos), dtype=np.int32)
        #: how many words a state remembers, the price of leaving it, and where that leads
        self.order = np.repeat(np.array([0, 1, 2], np.int8), [1, len(ones), len(twos)])
        self.weight = np.concatenate([[0.0], weights1, weights2])
        self.failure = np.zeros(len(self.order), np.int32)
        self.failure[pair_state[twos]] = word_state[grams.word2[twos]]
        #: the state behind a pair: its own, or that of its last word
        self.behind_word = word_state
        self.behind_pair = np.where(pair_state > 0, pair_state, word_state[grams.word2])
        self.first_pair, self.first_triple = words, words + pairs
        self.exists = np.concatenate([np.ones(words, bool), grams.has2, grams.has3, [False]])
        shares = np.concatenate([grams.word, grams.share2, grams.share3, [1.0]])
        self.arc = np.log10(shares)
        self.next = np.concatenate([word_state, self.behind_pair, self.behind_pair[grams.tail3], [0]]).astype(np.int32)
        # the triple that ends at each place; the last number is that of none
        self.triples = np.full(len(grams.words), triples, np.int32)
        self.triples[grams.at3] = grams.inverse3

    def _runs(self, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First places, lengths and first states of the runs, the longest first; the start of a text has no score."""
        grams = self.grams
        firsts, lengths = grams.starts + 1, grams.sizes - 1
        pieces = -(-lengths // run)
        text = np.repeat(np.arange(len(pieces)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = firsts[text] + number * run
        length = np.minimum(run, lengths[text] - number * run)
        # a run inside a text begins in the state that its last two words lead to
        state = np.where(
            number == 0, self.behind_word[grams.words[begin - 1]], self.behind_pair[grams.pairs[begin - 1]]
        )
        order = np.argsort(-length, kind="stable")
        return begin[order], length[order], state[order]

    def traversed(self, run: int) -> np.ndarray:
        """Log10 probability of the token at each place, from one pass over each run that carries its state."""
        grams, out = self.grams, np.zeros(len(self.grams.words))
        begin, length, state = self._runs(run)
        for step in range(int(length.max(initial=0))):
            running = int(np.searchsorted(-length, -step, side="left"))
            place, at = begin[:running] + step, state[:running]
            total = np.zeros(running)
            arcs = [grams.words[place], self.first_pair + grams.pairs[place], self.first_triple + self.triples[place]]
            for order in (2, 1):
                missing = (self.order[at] == order) & ~self.exists[arcs[order]]
                total[missing] += self.weight[at[missing]]
                at = np.where(missing, self.failure[at], at)
            order = self.order[at]
            arc = np.where(order == 2, arcs[2], np.where(order == 1, arcs[1], arcs[0]))
            out[place] = total + self.arc[arc]
            state[:running] = self.next[arc]
        return out


def _sent(number: int, bounds: np.ndarray, keys: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """Rows of a slice for the buckets; ``keys`` are sorted."""
    cuts = [*np.searchsorted(keys, bounds), len(keys)]
    parts = [(b, slice(lo, hi)) for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]
    columns = [pa.array([number] * len(parts), pa.int64()), pa.array([b for b, _ in parts], pa.int64())]
    columns.append(pa.array([_packed_keys(keys[p]) for _, p in parts], pa.binary()))
    columns += [pa.array([_packed(v[p]) for _, p in parts], pa.binary()) for v in values]
    columns += [pa.nulls(len(parts), pa.binary())] * (5 - len(columns))
    return pa.RecordBatch.from_arrays(columns, ["slice", "bucket", "keys", "n", "more"])


_SENT = "slice long, bucket long, keys binary, n binary, more binary"


def _answers(table: pa.Table, turn: int, orders: tuple[int, ...], bits: int, kind: type) -> np.ndarray:
    """Answers to a slice of one turn, in the order of its keys."""
    rows = sorted(zip(table["turn"].to_pylist(), table["bucket"].to_pylist(), table["answer"].to_pylist()))
    found = [_unpacked(data, kind) for t, bucket, data in rows if t == turn and (bucket >> bits) + 1 in orders]
    return np.concatenate([np.empty(0, kind), *found])


def _add(table: pa.Table) -> pa.Table:
    """What a bucket answers.

    For counts: totals, times two, plus one for the first slice of an n-gram; and totals of the bucket's words in its
    first row. For histories: the log10 weight of backing off. Slices are sorted, so that sums of floats have one order.
    """
    table = table.sort_by("slice")
    keys = [_unpacked_keys(k) for k in table["keys"].to_pylist()]
    distinct, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)

    def summed(column: str, kind: type) -> np.ndarray:
        values = np.concatenate([_unpacked(v, kind) for v in table[column].to_pylist()])
        return np.bincount(inverse, weights=values, minlength=len(distinct))

    tokens = words = 0
    if table["more"].null_count:
        totals = summed("n", np.int64).astype(np.int64)
        mine = (distinct >> np.uint64(62) == 1) & (distinct != np.uint64(_START_KEY)) & (totals > 0)
        tokens, words = int(totals[mine].sum()), int(mine.sum())
        values = totals[inverse] * 2
        values[first] += 1
    else:
        kept, lower = summed("n", np.float64), summed("more", np.float64)
        values = np.log10(np.maximum(1 - kept, 1e-12) / np.maximum(1 - lower, 1e-12))[inverse]
    answers = [_packed(v) for v in np.split(values, np.cumsum([len(k) for k in keys])[:-1])]
    rest = [0] * (table.num_rows - 1)
    return pa.table(
        {
            "slice": table["slice"],
            "bucket": table["bucket"],
            "answer": pa.array(answers, pa.binary()),
            "tokens": pa.array([tokens, *rest], pa.int64()),
            "distinct": pa.array([words, *rest], pa.int64()),
        }
    )


def _add_to(df: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write rows into a table that is bucketed by slice; a first call makes the table."""
    df.write.mode("append").bucketBy(buckets, "slice").option("path", path).saveAsTable(table)


def _answer(sent: DataFrame, turn: int, table: str, path: str, buckets: int) -> None:
    made = sent.groupBy("bucket").applyInArrow(_add, "slice long, bucket long, answer binary, tokens long, distinct long")
    _add_to(made.withColumn("turn", F.lit(turn)).repartition(buckets, "slice"), table, path, buckets)


def _own_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, with its settings, in which shuffle files go when their query has ended and not
    when the driver happens to collect its garbage."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return own


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: fold, token counts, the add-one unigram score and the model's, both log10."""
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"), held_out(docs[key]).alias("held_out"))
    size = plain.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    buckets, run = max(1, -(-size // (SLICE_BYTES * BUCKETED))), RUN
    paths = [scratch_path(spark, label) for label in ("slices", "ngram-answers")]
    names = [path.rsplit("/", 1)[1].replace("-", "_") for path in paths]
    seen = Observation()
    sliced = plain.mapInArrow(_slicer(SLICE_BYTES), _SLICE).observe(seen, F.sum("tokens").alias("tokens"))
    _add_to(sliced, names[0], paths[0], buckets)
    bits = math.ceil(math.log2(max((seen.get["tokens"] or 0) / BUCKET_TOKENS, 1)))
    own = _own_session(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                grams = _Grams(row)
                yield _sent(row["slice"], _bounds(bits), np.concatenate(grams.keys), np.concatenate(grams.counts))

    _answer(own.table(names[0]).mapInArrow(count, _SENT), 1, names[1], paths[1], buckets)
    totals = own.table(names[1]).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "distinct")]).first()
    tokens = totals["tokens"]
    floor = tokens + totals["distinct"] + 1

    def grams_of(part: pa.Table, answers: pa.Table, turn: int) -> tuple[int, _Grams]:
        [row] = _rows(part)
        grams = _Grams(row)
        grams.answered(_answers(answers, 1, (1, 2), bits, np.int64), floor)
        if turn > 2:
            grams.answered3(_answers(answers, 2, (3,), bits, np.int64))
        return row["slice"], grams

    def second(part: pa.Table, answers: pa.Table) -> pa.Table:
        number, grams = grams_of(part, answers, 2)
        return pa.Table.from_batches(
            [_sent(number, _bounds(bits), *grams.sums(1)), _sent(number, _bounds(bits), grams.three, grams.counts3)]
        )

    def third(part: pa.Table, answers: pa.Table) -> pa.Table:
        number, grams = grams_of(part, answers, 3)
        return pa.Table.from_batches([_sent(number, _bounds(bits), *grams.sums(2))])

    def score(part: pa.Table, answers: pa.Table) -> pa.Table:
        _, grams = grams_of(part, answers, 4)
        weights = [_answers(answers, turn, (order,), bits, np.float64) for turn, order in ((2, 1), (3, 2))]
        known, base, model = grams.scores(*weights, run)
        columns = [*grams.docs.columns, grams.sizes - 1, known, np.full(len(base), tokens, np.int64), base, model]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def visit(session: SparkSession, work: Callable[[pa.Table, pa.Table], pa.Table], columns: str) -> DataFrame:
        slices, answers = (session.table(name).groupBy("slice") for name in names)
        return slices.cogroup(answers).applyInArrow(work, columns)

    _answer(visit(own, second, _SENT), 2, names[1], paths[1], buckets)
    _answer(visit(own, third, _SENT), 3, names[1], paths[1], buckets)
    kind = plain.schema["doc_id"].dataType.simpleString()
    scored = visit(
        spark,
        score,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    # the plan has found the files; the names have done their work
    scored.schema  # noqa: B018
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return scored
