"""Token counts by dynamic programming over a trie of pre-tokens.

The words of a batch, each behind a word mark, are put into a trie. Each of its nodes, a prefix that
any number of words share, gets its best unigram score and the number of pieces of that segmentation
from the nodes above it, once. Word ends are terminal nodes; their counts are kept and looked up for every
document. The trie is walked in sorted order, so only the nodes above the current word are in memory.

Piece probabilities follow the pieces' ranks in the vocabulary file (Zipf's law), since the file has
no probabilities; characters without a piece cost one byte piece per byte. No tokenizer is trained.

Defined results: a null or empty text has no words and no tokens. Null ids pass through; repeated
rows give one row each. Of equally good segmentations the one with fewer pieces counts. Empty tables
give empty results. Other columns are ignored. Texts and words of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from sedimenta.llm.batches import Made, Texts, map_texts
from sedimenta.llm.text import WORD_RE

#: Words remembered per worker process; beyond it the memory starts anew. It bounds memory only.
MEMORY = 400_000
MARK = "▁"


class UnigramPieces:
    """Log probabilities of a vocabulary's pieces, by rank."""

    def __init__(self, pieces: list[str], n_bytes: int = 256) -> None:
        norm = math.log(sum(1 / r for r in range(1, len(pieces) + n_bytes + 1)))
        self.score = {p: -math.log(r) - norm for r, p in enumerate(pieces, start=1)}
        self.byte = -math.log(len(pieces) + n_bytes) - norm
        self.longest = max(map(len, pieces), default=1)
        # how long a piece that ends in a character can be
        self.reach: dict[str, int] = {}
        for p in pieces:
            self.reach[p[-1]] = max(self.reach.get(p[-1], 1), len(p))
        self.known: dict[str, tuple[float, int]] = {}

    def extend(self, word: str, path: list[tuple[float, int]], depth: int) -> tuple[float, int]:
        """Best (score, -pieces) of the prefix of ``depth`` characters, from those of the shorter prefixes."""
        score, char = self.score.get, word[depth - 1]
        before, pieces = path[depth - 1]
        one = score(char)
        n_bytes = 1 if one is not None else len(char.encode("utf-8", "surrogatepass"))
        best = (before + (one if one is not None else n_bytes * self.byte), pieces - n_bytes)
        for start in range(max(0, depth - self.reach.get(char, 1)), depth - 1):
            weight = score(word[start:depth])
            if weight is not None:
                before, pieces = path[start]
                if (offer := (before + weight, pieces - 1)) > best:
                    best = offer
        return best

    def count(self, words: Iterable[str]) -> dict[str, tuple[float, int]]:
        """(score, pieces) of each word, by one walk over their trie in sorted order."""
        found = {}
        path: list[tuple[float, int]] = [(0.0, 0)]
        above = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(word, above):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            for depth in range(shared + 1, len(word) + 1):
                path.append(self.extend(word, path, depth))
            score, pieces = path[-1]
            found[word] = (score, -pieces)
            above = word
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> UnigramPieces:
    """The text pieces of a vocabulary file, in its order; control and byte pieces left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return UnigramPieces([model.id_to_piece(i) for i in ids])


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``n_words``, ``n_tokens`` and ``log_prob``, the natural log of the best segmentation."""

    def prepare() -> Callable[[Texts], Made]:
        pieces = vocabulary(path)

        def work(texts: Texts) -> Made:
            if len(pieces.known) > MEMORY:
                pieces.known.clear()
            known = pieces.known
            split = [[MARK + w for w in WORD_RE.findall(t)] if t else [] for t in texts]
            known.update(pieces.count({w for words in split for w in words if w not in known}))
            found = [[known[w] for w in words] for words in split]
            return None, [
                pa.array([len(words) for words in split], pa.int64()),
                pa.array([sum(n for _, n in rows) for rows in found], pa.int64()),
                pa.array([math.fsum(s for s, _ in rows) for rows in found], pa.float64()),
            ]

        return work

    return map_texts(docs, "n_words long, n_tokens long, log_prob double", prepare, key, text)
