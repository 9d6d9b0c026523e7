import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sedimenta.llm import packing
from sedimenta.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "a", "B", " ", "  ", "\n", "\t", "é", "漢", "1", "22", "!", "'s", "'", "\r\n", "<|endoftext|>", "The", "\x1c", "\x85", "word",
]


def test_ids_are_the_tokenizer_s():
    draw, reference = random.Random(2), Tokenizer.from_file(PATH)
    for _ in range(3000):
        text = "".join(draw.choice(BITS) for _ in range(draw.randint(0, 12)))
        ids = array("I", encoder(PATH).packed(text)).tolist()
        assert ids == reference.encode(text, add_special_tokens=False).ids, text


def sequences_of(histogram, window, bins):
    """Lengths in each sequence; every piece must be placed once."""
    placed, found = Counter(), defaultdict(list)
    for length, low, high, shift, sequence, times in packing.placements(dict(histogram), window, bins):
        for rank in range(low, high):
            placed[length, rank] += 1
            found[sequence + (rank + shift) // times].append(length)
    assert placed == {(n, rank): 1 for n, count in histogram.items() for rank in range(count)}
    return found


def test_plan_places_every_piece_once():
    draw = random.Random(1)
    for window, bins, size in [(128, 16, 300), (256, 256, 3000), (2048, 256, 6000), (100, 16, 400), (64, 64, 1), (64, 64, 0)]:
        histogram = Counter(min(window, max(1, int(draw.lognormvariate(window**0.25, 1.2)))) for _ in range(size))
        found = sequences_of(histogram, window, bins)
        assert all(sum(own) <= window for own in found.values())
        assert sorted(found) == list(range(len(found)))
        if size > 1000:
            assert sum(map(sum, found.values())) > 0.97 * window * len(found)


def test_short_pieces_fill_sequences():
    found = sequences_of({3: 20_000}, 2048, 256)
    assert len(found) == 30
    found = sequences_of({1: 5000, 3: 4000, 20: 3000, 700: 5}, 2048, 256)
    assert len(found) <= -(-(5000 + 12000 + 60000 + 3500) // 2048) + 1


def test_plan_without_partners():
    assert packing.placements({60: 10**9}, 64, 64) == [(60, 0, 10**9, 0, 0, 1)]


def test_least_squares_finds_a_perfect_cover():
    matrix = np.array([[1.0, 0, 1], [0, 1, 1]])
    x = packing.nonnegative_least_squares(matrix, np.array([3.0, 2.0]))
    assert (x >= 0).all() and np.allclose(matrix @ x, [3, 2], atol=1e-6)


def test_round_trip(spark):
    draw = random.Random(9)
    texts = {i: " ".join(draw.choice(["alpha", "beta", "漢字", "x1"]) for _ in range(draw.randint(0, 4000))) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    pieces = packing.pack(docs, PATH).collect()
    reference = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for i, text in texts.items():
        ids = reference.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], dtype="<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= packing.WINDOW
    assert sum(p["length"] for p in pieces) > 0.9 * packing.WINDOW * len(by_sequence)
