import random
import re
import zlib
from collections import Counter

import pytest

from sedimenta.llm import spelling

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_vocabulary(rows, least=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            digest = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if digest % 199 == 0:
                run = run[: digest % len(run)] + run[digest % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    near = {w: [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and one_apart(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * counts[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def grouped(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spelling.spelling_groups(words).collect()
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


def edited(draw, word, letters):
    at = draw.randrange(len(word) + 1)
    kind = draw.randrange(3)
    if kind == 0:
        return word[:at] + draw.choice(letters) + word[at:]
    if kind == 1:
        return word[:at] + draw.choice(letters) + word[at + 1 :]
    return word[:at] + word[at + 1 :]


@pytest.mark.parametrize(("letters", "lengths"), [("ab", (6, 9)), ("aé÷zß", (6, 14)), ("abc", (20, 30)), ("abcd", (45, 60))])
def test_brute_force(spark, letters, lengths):
    draw = random.Random(lengths[0])
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(*lengths))) for _ in range(60)}
    for _ in range(250):
        words.add(edited(draw, draw.choice(sorted(words)), letters))
    counts = {w: draw.choice([5, 6, 30, 150, 800]) for w in sorted(words) if len(w) >= 6}
    expected = plain_groups(counts)
    assert sum(e[0] is not None for e in expected.values()) > 20
    assert grouped(spark, counts) == expected


def test_long_words_and_chains(spark):
    long = "ab" * 4000
    counts = {long: 500, long + "c": 5, "c" + long: 6, long[:5000] + "z" + long[5001:]: 100, "x" * 3000: 7, "x" * 2999: 7}
    word, n = "abcdefgh", 5
    for letter in "qrstuvw":
        counts[word] = n
        word, n = word + letter, n * 5
    assert grouped(spark, counts) == plain_groups(counts)


def test_vocabulary(spark):
    draw = random.Random(9)
    pool = ["".join(draw.choice("abÀÿZé") for _ in range(draw.randint(4, 9))) for _ in range(40)]
    rows = [(i, " ".join(draw.choice(pool) for _ in range(30)) + "," + draw.choice(pool) + "9" + draw.choice(pool)) for i in range(300)]
    rows += [(None, pool[0]), (1, None), (2, ""), (2, ""), (3, "Ābcdefg " * 9), (4, "x" * 50000), (4, "x" * 50000)]
    docs = spark.createDataFrame([(*r, "", "", 0) for r in rows], "doc_id long, text string, word string, run string, n int")
    found = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    assert found == plain_vocabulary(rows)
    assert spelling.spelling_groups(spelling.vocabulary(docs.limit(0))).collect() == []
    whole = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_groups(spelling.vocabulary(docs)).collect()}
    assert whole == plain_groups(found)
