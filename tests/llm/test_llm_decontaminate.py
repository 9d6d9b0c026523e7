import random

from sedimenta.llm import decontaminate


def frames(spark, docs, items):
    return (
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
    )


def plain_hits(words, windows):
    hit = set()
    for w in windows:
        for i in range(len(words) - len(w) + 1):
            if words[i : i + len(w)] == w:
                hit.update(range(i, i + len(w)))
    return len(hit)


def test_hits_are_those_of_brute_force(spark):
    draw = random.Random(2)
    vocabulary = ["a", "b", "c"]  # few words: every list is long, and phrases overlap
    docs = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 400))) for _ in range(30)]
    items = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 9))) for _ in range(6)]
    found = {r["doc_id"]: r for r in decontaminate.contamination(*frames(spark, docs, items), n=4).collect()}
    for i, text in enumerate(docs):
        words = text.split()
        windows, items_found = [], set()
        for j, item in enumerate(items):
            own = item.split()
            own = [own[k : k + 4] for k in range(len(own) - 3)] or [own]
            windows += own
            if plain_hits(words, own):
                items_found.add(j)
        n = plain_hits(words, windows)
        assert (found[i]["n_hit"], found[i]["n_items"]) == (n, len(items_found))
        assert found[i]["contaminated"] == (n > 0 and 20 * n >= len(words))


def near(words, window, slop):
    """Whether from some start on each word stands at most ``slop`` words behind its own place."""
    return any(
        all(w in words[max(s + i, 0) : max(s + i + slop + 1, 0)] for i, w in enumerate(window)) for s in range(-slop, len(words))
    )


def found_near(index, slop):
    phrases = {r["window"]: r["phrase"] for r in index.windows.collect()}
    rows = index.near_matches(slop).collect()
    found = {(r["doc_id"], phrases[r["window"]]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_proximity_matches(spark):
    item = "the red lamp stood under a wooden table near seven quiet old dogs"
    docs = [
        item,
        item.replace("wooden", "very wooden"),  # one word put in
        item.replace("red lamp", "lamp red"),  # two words change places
        "red lamp wooden table seven quiet dogs " + "filler " * 40 + "under near",
        item.replace("wooden", "very very very very very very very wooden"),
        item.replace("wooden ", ""),  # a word is missing
    ]
    index = decontaminate.PhraseIndex(*frames(spark, docs, [item]))
    assert {i for i, _ in found_near(index, 4)} == {0, 1, 2}
    assert {r["doc_id"] for r in index.exact_matches().collect()} == {0}
    assert {i for i, _ in found_near(index, 20)} == {0, 1, 2, 4}


def test_proximity_matches_are_those_of_brute_force(spark):
    draw = random.Random(7)
    vocabulary = ["a", "b", "c", "d", "e", "f"]
    docs = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    items = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 8))) for _ in range(8)]
    index = decontaminate.PhraseIndex(*frames(spark, docs, items), n=5)
    phrases = {r["phrase"] for r in index.windows.collect()}
    for slop in (0, 1, 3, 20):
        expected = {(i, p) for i, text in enumerate(docs) for p in phrases if near(text.split(), p.split(), slop)}
        assert found_near(index, slop) == expected
        assert slop == 20 or 0 < len(expected) < len(docs) * len(phrases)
