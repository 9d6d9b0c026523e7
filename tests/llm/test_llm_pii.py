import random
import re
from collections import Counter, defaultdict

import pytest

from sedimenta.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BITS = [
    "a", "B.c", "@", ".", "..", "x@y.z", "1", "12", "255", "256", "-", " ", "4111111111111111", "4111 1111 1111 1111", "+",
    "+1 (555) 555-2485", "(", ")", "é", "\n", "+44", "0", "00", "9.9.9.9", "\t", "_", "%",
]


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_base(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return found


def test_base_spans_are_those_of_the_expressions():
    draw = random.Random(3)
    for _ in range(20000):
        text = "".join(draw.choice(BITS) for _ in range(draw.randint(0, 14)))
        assert pii.scan(text)[0] == plain_base(text), text


def test_long_runs_take_linear_time():
    assert pii.scan("1" * 200_000)[0] == []
    assert pii.scan("1." * 100_000)[0][0] == ("ip", 0, 7)
    assert pii.scan("a" * 200_000 + "@" * 1000)[0] == []


def test_contexts_of_seeds_find_further_identifiers(spark):
    rows = [(i, f"hello there my phone number is +1 (555) 555-{1000 + i} thanks") for i in range(30)]
    rows += [(100, "oh my phone number is 555-123-4010 thanks a lot"), (101, "part number of 123-456-7890 thing")]
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(s) for s in found[100]["added"]] == [("phone", 22, 34)]
    assert found[101]["added"] == [] and all(found[i]["added"] == [] for i in range(30))


def test_a_context_that_mostly_holds_other_things_finds_nothing(spark):
    rows = [(i, f"see number +1 (555) 555-{1000 + i} now") for i in range(6)]
    rows += [(100 + i, f"see number 2{i:02}-555-40{10 + i} now") for i in range(30)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["added"] == [] for r in found)


def plain_patterns(rows, rounds, confidence, support):
    """The graph's scores from lists of all occurrences."""
    places = [(kind, value, fits, p) for kind, value, fits, patterns in rows for p in patterns]
    total = Counter(p for *_, p in places)
    seeds = defaultdict(set)
    for kind, value, _, p in places:
        if kind:
            seeds[p, kind].add(value)
    known = {}  # score of a value as a kind
    score = {}
    for _ in range(rounds):
        mass = defaultdict(float)
        for kind, value, fits, p in places:
            for k in [kind] if kind else fits:
                mass[p, k] += 1.0 if kind else known.get((value, k), 0.0)
        score = {(p, k): m / (total[p] + 1) for (p, k), m in mass.items()}
        sums, counts = defaultdict(float), Counter()
        for kind, value, fits, p in places:
            for k in () if kind else fits:
                sums[value, k] += score.get((p, k), 0.0)
                counts[value, k] += 1
        known = {v: s / counts[v] for v, s in sums.items()}
    return {pk: s for pk, s in score.items() if s >= confidence and len(seeds[pk]) >= support}


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_patterns_are_those_of_brute_force(spark, rounds):
    draw = random.Random(rounds)
    rows = []
    for _ in range(600):
        kind = draw.choice(["phone", "card", None, None])
        fits = [kind] if kind else draw.choice([["phone"], ["card"], ["card", "phone"]])
        # a value always fits the same kinds, and patterns lean to a kind
        value = f"{kind or '-'.join(fits)}{draw.randrange(25)}"
        lean = {"phone": [1, 2, 3], "card": [4, 5, 6]}.get(fits[-1], [7])
        patterns = [f"p{draw.choice(lean) if draw.random() < 0.9 else draw.randrange(8)}" for _ in range(draw.randint(0, 3))]
        rows.append((kind, value, fits, sorted(set(patterns))))
    seen = spark.createDataFrame(rows, "kind string, value string, fits array<string>, patterns array<string>").repartition(4)
    found = {(r["pattern"], r["kind"]): r["score"] for r in pii.learn_patterns(seen, rounds, 0.4, 3).collect()}
    expected = plain_patterns(rows, rounds, 0.4, 3)
    assert found.keys() == expected.keys() and found
    assert all(found[k] == pytest.approx(expected[k]) for k in found)


def test_planted_identifiers(spark):
    """Identifiers no base form holds, in contexts of base ones and in others: what is added, and how much of it is right."""
    draw = random.Random(12)
    contexts = {
        "phone": ["call my office at {} today", "reach the front desk under {} or write", "fax it to {} please"],
        "ip": ["the server listens on {} since then", "ping from {} failed again", "blocked the host {} for abuse"],
    }
    others = ["order number {} was shipped", "the part {} is out of stock", "lot {} expires soon", "see clause {} of it"]
    words = "some words before and after that say nothing of use here".split()

    def phone(plus):
        digits = "".join(draw.choice("0123456789") for _ in range(9))
        return f"+4{digits[:2]} {digits[2:5]} {digits[5:]}1" if plus else f"{digits[:3]}-{digits[3:6]}-{digits[6:]}"

    def address(base):
        if base:
            return ".".join(str(draw.randrange(256)) for _ in range(4))
        return ":".join(f"{draw.randrange(1, 1 << 16):x}" for _ in range(8))

    make, rows, planted = {"phone": phone, "ip": address}, [], {}
    for i in range(1500):
        kind = draw.choice(["phone", "ip"])
        value, context = None, draw.choice(contexts[kind])
        if draw.random() < 0.85:
            value = make[kind](True)
        elif draw.random() < 0.6:
            value = make[kind](False)
        else:
            value, context = make[kind](False), draw.choice(others)
            kind = None
        left = " ".join(draw.choice(words) for _ in range(draw.randrange(9)))
        text = f"{left} {context.format(value)} {left}"
        rows.append((i, text))
        if kind and not pii.scan(text)[0]:
            planted[i] = (kind, text.index(value), text.index(value) + len(value))
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {(r["doc_id"], tuple(s)) for r in found for s in r["added"]}
    right = added & set(planted.items())
    assert len(planted) > 80
    assert len(right) >= 0.95 * len(planted)  # recall
    assert len(right) >= 0.95 * len(added)  # precision


def test_candidates_do_not_overlap():
    draw = random.Random(5)
    bits = ["a@", "fe80::1", "x:1:2:3", " ", "12345678", "@", "1:2:3:4", "-", "b.c", "4111 1111 1111 1111"]
    both = 0
    for _ in range(5000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(1, 8)))
        base, others = pii.scan(text)
        ends = sorted([s[1:] for s in others])
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
        assert all(o[2] <= s[1] or s[2] <= o[1] for o in others for s in base)
        both += len(others) > 1
    assert both > 100
