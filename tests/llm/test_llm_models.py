"""Language model, language identification, token counts and licenses."""

import math
import random
import re
import textwrap
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pytest

from sedimenta.llm import language_id, language_model, licenses, token_counts


# Word numbers of 20 bits each, so that three fit a long.
_BITS = 20
_START, _END, _FIRST = 0, 1, 2


@dataclass(frozen=True)
class Automaton:
    """The model of a whole corpus in one piece, which the slices are tested against.

    ``arcs[state][word]`` is (log10 weight, next state); state 0 is the root, where all frequent words have arcs.
    """

    unigrams: list[float]
    arcs: list[dict[int, tuple[float, int]]]
    failure: list[int]
    weight: list[float]
    start: int

    def score(self, words: list[int]) -> float:
        """Log10 probability of a numbered text; words without a number (-1) count as one here."""
        arcs, failure, weight = self.arcs, self.failure, self.weight
        state, total = self.start, 0.0
        for word in words:
            if word < 0:
                while state:
                    total += weight[state]
                    state = failure[state]
                continue
            while (arc := arcs[state].get(word)) is None:
                total += weight[state]
                state = failure[state]
            total += arc[0]
            state = arc[1]
        return total


def build_automaton(
    words: list[int], grams: list[dict[int, int]], tokens: int, distinct: int, documents: int
) -> Automaton:
    """From the counts of frequent words, frequent n-grams of each order from two on, and the totals."""
    floor = tokens + distinct + 1
    counts = [documents, documents, *words]
    unigrams = [math.log10((n + 1) / floor) for n in counts]
    # states: 0 is the root, each history with arcs has one
    states: dict[tuple[int, int], int] = {(0, 0): 0}
    for length, table in enumerate(grams, start=1):
        for gram in table:
            states.setdefault((length, gram >> _BITS), len(states))

    def state_of(length: int, gram: int) -> int:
        """The state of the longest suffix that is one."""
        while length:
            found = states.get((length, gram & ((1 << _BITS * length) - 1)))
            if found is not None:
                return found
            length -= 1
        return 0

    longest = len(grams)
    arcs: list[dict[int, tuple[float, int]]] = [{} for _ in states]
    arcs[0] = {w: (unigrams[w], state_of(min(1, longest), w)) for w in range(_END, len(counts))}
    kept, lower = [0.0] * len(states), [0.0] * len(states)
    failure, weight = [0] * len(states), [0.0] * len(states)
    for (length, history), state in states.items():
        if length:
            failure[state] = state_of(length - 1, history & ((1 << _BITS * (length - 1)) - 1))

    def backed(state: int, word: int) -> float:
        """Probability of a word behind a shorter history, whose weights are known already."""
        total = 0.0
        while (arc := arcs[state].get(word)) is None:
            total += weight[state]
            state = failure[state]
        return 10 ** (total + arc[0])

    for length, table in enumerate(grams, start=1):
        histories = grams[length - 2] if length > 1 else None
        for gram, n in table.items():
            history, word = gram >> _BITS, gram & ((1 << _BITS) - 1)
            seen = histories[history] if histories else counts[history]
            state = states[length, history]
            share = (n - language_model.DISCOUNT) / seen
            kept[state] += share
            lower[state] += backed(failure[state], word)
            arcs[state][word] = (math.log10(share), state_of(min(length + 1, longest), gram))
        for (size, _), state in states.items():
            if size == length:
                weight[state] = math.log10(max(1 - kept[state], 1e-12) / max(1 - lower[state], 1e-12))
    return Automaton(unigrams, arcs, failure, weight, state_of(min(1, longest), _START))


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(8)
    sets = [["the", "cat", "sat", "on", "A", "mat"], ["le", "chat", "était", "sur", "Un", "tapis"]]
    rows = [(i, " ".join(draw.choice(sets[i % 2]) for _ in range(draw.randint(0, 40))) + f" only{i}") for i in range(300)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_base_scores(spark, corpus):
    rows, docs = corpus
    tokens = {i: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in t.split()] + ["\n"] for i, t in rows}
    kept = {i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = Counter(w for i in kept for w in tokens[i])
    total = sum(counts.values())
    better = 0
    for r in language_model.score_documents(docs).collect():
        words = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["train_tokens"]) == (len(words), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert r["held_out"] == (r["doc_id"] not in kept)
        better += r["score"] > r["base_score"]
    assert better > 0.9 * len(rows)  # each text keeps to one set of words, which only histories tell


def test_probabilities_of_every_state_sum_to_one():
    words = [50, 30, 20]
    two = {0 << 20 | 2: 9, 2 << 20 | 3: 20, 2 << 20 | 2: 10, 3 << 20 | 1: 8, 3 << 20 | 4: 12}
    three = {2 << 40 | 2 << 20 | 3: 6, 2 << 40 | 3 << 20 | 4: 7}
    documents, distinct, tokens = 10, 4, 110
    model = build_automaton(words, [two, three], tokens, distinct, documents)
    unseen = 1 / (tokens + distinct + 1)
    for state in range(len(model.failure)):
        total = 0.0
        for word in (1, 2, 3, 4, None):
            at, log = state, 0.0
            while word is None and at or word is not None and word not in model.arcs[at]:
                log += model.weight[at]
                at = model.failure[at]
            total += 10**log * (unseen if word is None else 10 ** model.arcs[at][word][0])
        assert total == pytest.approx(1)


def test_every_repeated_ngram_counts_at_any_size(spark, monkeypatch):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 30)))) for i in range(150)]
    rows.append((1001, "x y z v " * 450_000))  # 1.8 M tokens: a share of them would ask for more than two occurrences
    tokens = {i: t.split() for i, t in rows}
    kept = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    assert 1001 in kept
    counts = Counter(w for i in kept for w in tokens[i])
    number = {w: _FIRST + k for k, w in enumerate(sorted(counts))}
    coded = {i: [0, *(number.get(w, -1) for w in ws), 1] for i, ws in tokens.items()}
    grams = []
    for size in (2, 3):
        found = Counter(tuple(coded[i][k : k + size]) for i in kept for k in range(len(coded[i]) - size + 1))
        packed = {sum(w << 20 * (size - 1 - k) for k, w in enumerate(g)): n for g, n in found.items() if n >= 2}
        assert 2 in packed.values()
        grams.append(packed)
    total = sum(counts.values()) + len(kept)
    whole = build_automaton([counts[w] for w in sorted(counts)], grams, total, len(counts) + 1, len(kept))
    monkeypatch.setattr(language_model, "SLICE_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(language_model, "BUCKET_TOKENS", 1 << 17, raising=False)
    unseen = -math.log10(total + len(counts) + 2)
    scored = language_model.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(scored) == len(rows)
    for r in scored:
        ids = coded[r["doc_id"]][1:]
        assert r["score"] == pytest.approx(whole.score(ids) + unseen * ids.count(-1), rel=1e-9)


def test_runs_carry_their_states(spark, monkeypatch):
    """Scores do not depend on where texts are cut into runs."""
    draw = random.Random(6)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 2, 3, 50, 700])))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for run in (1, 2, 3, 10_000):
        monkeypatch.setattr(language_model, "RUN", run)
        found.append(sorted(tuple(r) for r in language_model.score_documents(docs).collect()))
    assert found[0] == found[1] == found[2] == found[3]
    assert not [t for t in spark.catalog.listTables() if "slices" in t.name or "ngram" in t.name]


def test_longer_histories_are_used():
    model = build_automaton(
        [50, 30], [{2 << 20 | 3: 20, 3 << 20 | 2: 20}, {2 << 40 | 3 << 20 | 2: 18}], 90, 3, 10
    )
    assert model.score([2, 3, 2]) > model.score([2, 3]) + math.log10((20 - 0.5) / 30)


def test_slopes_are_those_of_the_loss():
    draw = np.random.default_rng(1)
    windows = draw.integers(0, language_id._N_CLASSES, (5, language_id.WINDOW))
    labels, importance = np.array([0, 1, 2, 0, 1]), np.ones(5)
    shapes = [(language_id._N_CLASSES, language_id.EMBEDDING)]
    shapes += [(w, language_id.EMBEDDING, language_id.FILTERS) for w in language_id.WIDTHS] + [(language_id.FILTERS,)] * 3
    shapes += [(3 * language_id.FILTERS, 3), (3,)]
    values = [draw.normal(0, 0.5, s) for s in shapes]

    def loss():
        network = language_id.Network(("a", "b", "c"), values[0], tuple(values[1:4]), tuple(values[4:7]), *values[7:])
        embedded, peaks = values[0][windows], []
        for w, kernel, bias in zip(language_id.WIDTHS, network.filters, network.biases):
            span = language_id.WINDOW - w + 1
            peaks.append(sum(embedded[:, k : k + span] @ kernel[k] for k in range(w)).max(1) + bias)
        p = language_id._softmax(np.maximum(np.concatenate(peaks, 1), 0) @ values[-2] + values[-1])
        assert np.allclose(p, network.tables().probabilities(windows), atol=1e-4)
        return -np.log(p[np.arange(5), labels]).mean()

    slopes = language_id._slopes(values, windows, labels, importance)
    for value, slope in zip(values, slopes):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        step = 1e-5
        value[at] += step
        up = loss()
        value[at] -= 2 * step
        down = loss()
        value[at] += step
        assert (up - down) / (2 * step) == pytest.approx(slope[at], rel=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    joined = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    rows = joined.collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_segmentation(word, pieces):
    best = [(0.0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        offers = []
        for start in range(end):
            part = word[start:end]
            if part in pieces.score:
                offers.append((best[start][0] + pieces.score[part], best[start][1] - 1))
            elif len(part) == 1:
                n = len(part.encode())
                offers.append((best[start][0] + n * pieces.byte, best[start][1] - n))
        best[end] = max(offers)
    return best[-1][0], -best[-1][1]


def test_token_counts():
    draw = random.Random(3)
    pieces = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    words = {"▁" + "".join(draw.choice(["the", "ing", "e", "q", "漢", "é", "\U0001f600", "1"]) for _ in range(draw.randint(1, 7))) for _ in range(800)}
    assert pieces.count(words) == {w: plain_segmentation(w, pieces) for w in words}


def test_licenses_are_confirmed_by_wording():
    matches = licenses.scanner().matches

    def names(text):
        return [m.license for m in matches(text)[1]]

    assert names("Some words.\nLicensed under CC BY-NC 4.0.\nMore words") == ["CC-BY-NC-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("This work is licensed under the GNU General Public License, version 4.") == []
    assert names("you need a license to drive") == []
    assert names("") == names(None) == []
    wrapped = licenses.TEMPLATES[4][1].replace(", to any", ",\nto any").replace("to deal", "to freely deal")
    [found] = matches("é\n" + wrapped + "\nrest")[1]
    assert (found.license, found.start, found.differences) == ("MIT", 2, 1)


@pytest.mark.parametrize("before", [0, 30, 400, 3000])
def test_licenses_inside_long_lines(before):
    filler = ("some other words of a paragraph " * 100)[:before]
    for name, text in licenses.TEMPLATES:
        [found] = licenses.scanner().matches(f"{filler} {text} {filler}")[1]
        assert (found.license, found.start >= before, found.differences) == (name, True, 0), text
    two = f"{filler} Licensed under CC BY 4.0. Released under the MIT License. {filler} Licensed under CC BY 4.0."
    assert [m.license for m in licenses.scanner().matches(two)[1]] == ["CC-BY-4.0", "MIT", "CC-BY-4.0"]
    notice = "redistribution and use in source and binary forms with or without any modification are permitted provided that the following conditions are met"
    near = licenses.scanner().matches(f"{notice} {notice.replace(' any', '')} {notice}")[1]
    assert [(m.license, m.differences) for m in near] == [("BSD", 1), ("BSD", 0), ("BSD", 1)]


@pytest.mark.parametrize("prefix", ["", "# ", " * "])
def test_wrapped_licenses_are_found(prefix):
    for name, text in licenses.TEMPLATES:
        for width in range(20, 81):
            lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
            wrapped = "Some words\n" + "\n".join(prefix + line for line in lines) + "\nother words"
            [found] = licenses.scanner().matches(wrapped)[1]
            assert (found.license, found.differences) == (name, 0), wrapped


def test_license_compression_prefers_the_right_template():
    for name, text in licenses.TEMPLATES:
        assert [m.license for m in licenses.scanner().matches(text)[1]] == [name], text


def plain_licenses(text):
    """Names of the templates that match around a cue somewhere, by trying every stretch of words with every template."""
    there = [(m[0], m.start(), m.end()) for m in re.finditer(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower())]
    words = [w for w, _, _ in there]
    cues = {next(k for k, (_, _, end) in enumerate(there) if end > m.start()) for m in licenses._CUE.finditer(text.lower())}
    found = set()
    for name, template in licenses.TEMPLATES:
        wanted = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", template.lower())
        most = math.floor(licenses.DIFFERENCES * len(wanted))
        for first in range(len(words)):
            if words[first] not in wanted or not any(first <= c < first + len(wanted) + most for c in cues):
                continue
            # longest common subsequence of the template and each stretch from here on, row by row; numbers come first
            row = [0] * (len(wanted) + 1)
            for last in range(first, min(first + len(wanted) + most, len(words))):
                new = [0]
                for k, w in enumerate(wanted):
                    same = row[k] + (1001 if w[0].isdigit() else 1) if words[last] == w else 0
                    new.append(max(same, row[k + 1], new[k]))
                row = new
                common, numbers, length = row[-1] % 1000, row[-1] // 1000, last - first + 1
                if len(wanted) - common <= most and length - common <= most and any(first <= c <= last for c in cues):
                    if numbers == sum(w[0].isdigit() for w in wanted):
                        found.add(name)
    return found


def test_license_scan_loses_no_template_that_matches():
    draw = random.Random(11)
    filler = "a the license of and software is free version 2.0 under public some text general this".split()
    hits = 0
    for _ in range(400):
        words = []
        for _ in range(draw.randint(1, 2)):
            words += [draw.choice(filler) for _ in range(draw.randint(0, 12))]
            part = draw.choice(licenses.TEMPLATES)[1].split()
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                at = draw.randrange(len(part))
                if draw.random() < 0.5:
                    part.insert(at, draw.choice(filler))
                elif len(part) > 1:
                    part.pop(at)
            words += part
        text = " ".join(words)
        expected, got = plain_licenses(text), {m.license for m in licenses.scanner().matches(text)[1]}
        assert got <= expected, (text, got, expected)
        # one match may cover the place of another; where there is any match, one is found
        assert bool(got) == bool(expected), (text, got, expected)
        hits += bool(got)
    assert 100 < hits < 390


def test_the_template_that_saves_most_wins():
    def names(text):
        return [m.license for m in licenses.scanner().matches(text)[1]]

    gpl = dict(licenses.TEMPLATES)["GPL-2.0-or-later"]
    for name in ("GPL-2.0-or-later", "LGPL-2.1-or-later", "AGPL-3.0-or-later", "GPL-3.0-or-later"):
        text = [t for n, t in licenses.TEMPLATES if n == name][0]
        assert names(f"Some program\n\n{text} It is useful.") == [name]
    assert names("x\n// SPDX-License-Identifier: LGPL-2.1-or-later\n" + gpl) == ["LGPL-2.1-or-later", "GPL-2.0-or-later"] or names(gpl) == ["GPL-2.0-or-later"]
    for name in licenses.IDENTIFIERS:
        assert names(f"# SPDX-License-Identifier: {name}\nint main() {{}}") == [name]
    assert names("The MIT License (MIT)\n\nCopyright (c) 2020 Someone") == ["MIT"]
    assert names("licensed under the Apache License 2.0, see the file") == ["Apache-2.0"]
    assert names("Distributed under the Boost Software License, Version 1.0. (See the file)") == ["BSL-1.0"]
