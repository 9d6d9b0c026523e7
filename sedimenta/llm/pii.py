"""Personal data: exact base forms, and bootstrapped extraction of what stands in the same contexts.

Base forms (e-mail address, IPv4 address, payment card, phone number) are found in one linear scan and
serve as seeds. The words around every seed, and around every other string that could be an identifier
(a digit group, something with an @, colon-separated hex), are lexical patterns. Patterns and
instances form a weighted bipartite graph that Spark scores in ROUNDS rounds: a pattern is as good as the
share of its occurrences that are known instances of a kind, an instance as good as the mean of its patterns.
Patterns above CONFIDENCE that SUPPORT different seeds have shown mark further instances of fitting form.

Only identifiers and their patterns are shuffled, never texts. Counts combine before the shuffle, so
a pattern or instance that a third of all documents share is one row per task.

Defined results: a null text is empty. Null ids pass through; repeated rows count as often as they
occur and give one row each; an instance that fits two kinds equally well takes the first kind
listed. Candidates never overlap a base span or each other: the one that begins first counts, the longest of those that begin
together. Empty tables give empty results. Other columns are ignored. Whole texts are scanned, in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.batches import Made, Texts, map_texts
from sedimenta.session import materialize

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 5

# A stretch in which all numeric kinds lie: it begins at a digit and holds what they may hold.
_STRETCH = re.compile(r"[0-9][0-9.\x20()-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT_WORD = re.compile(r"\S+")
_COLONS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_BEFORE = re.compile(r"(\S+)\s+(\S+)\s*\Z|(\S+)\s*\Z")
_AFTER = re.compile(r"\s*(\S+)")
_NEAR = 80
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) < 4 and int(p or 0) < 256 for p in parts)


def _is_card(text: str) -> bool:
    digits = _NO_DIGIT.sub("", text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _emails(text: str) -> list[Span]:
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            spans.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return spans


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans by kind as listed, then start; and other strings that could be identifiers."""
    if not text:
        return [], []
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    numbers = []
    found["email"] = _emails(text) if "@" in text else []
    for stretch in _STRETCH.finditer(text):
        start, content = stretch.start(), stretch[0]
        if len(content) < 7:  # no kind is shorter
            continue
        content = content.rstrip(" ().-")
        found["ip"] += [("ip", start + m.start(), start + m.end()) for m in _IP.finditer(content) if _is_ip(m[0])]
        found["card"] += [("card", start + m.start(), start + m.end()) for m in _CARD.finditer(content) if _is_card(m[0])]
        digits = len(_NO_DIGIT.sub("", content))
        if start and text[start - 1] == "+" and 9 <= digits <= 15:
            found["phone"].append(("phone", start - 1, start + len(content)))
        elif digits >= 7 and not text[start - 1 : start].isalnum() and not text[start + len(content) : start + len(content) + 1].isalnum():
            numbers.append(("number", start, start + len(content)))
    base = [span for kind in KINDS for span in found[kind]]
    others = [*numbers]
    if "@" in text:
        others += [("at", m.start(), m.end()) for m in _AT_WORD.finditer(text) if "@" in m[0]]
    if ":" in text:
        others += [("colons", m.start(), m.end()) for m in _COLONS.finditer(text) if len(m[0]) > 4]
    return base, _apart(others, base)


def _in_turn(spans: list[Span]) -> list[Span]:
    """Of spans that overlap the one that begins first, and the longest of those that begin together."""
    out, end = [], 0
    for span in sorted(spans, key=lambda x: (x[1], -x[2])):
        if span[1] >= end:
            out.append(span)
            end = span[2]
    return out


def _apart(spans: list[Span], taken: list[Span]) -> list[Span]:
    """Those of ``spans`` that overlap none of ``taken``, nor each other."""
    order = sorted((s, e) for _, s, e in taken)
    out, at, reach = [], 0, 0
    for span in sorted(spans, key=lambda x: x[1]):
        while at < len(order) and order[at][0] < span[2]:
            reach = max(reach, order[at][1])
            at += 1
        if reach <= span[1]:
            out.append(span)
    return _in_turn(out)


def _could_be(form: str, value: str) -> list[str]:
    """The kinds whose form a string nearly has."""
    digits = len(_NO_DIGIT.sub("", value))
    if form == "at":
        return ["email"]
    if form == "colons":
        return ["ip"]
    return ["card"] * (13 <= digits <= 19) + ["phone"] * (7 <= digits <= 15)


def patterns_around(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns: the word before, the two words before, and the words on both sides."""
    before = _BEFORE.search(text[max(0, start - _NEAR) : start])
    after = _AFTER.match(text[end : end + _NEAR])
    words = [w.lower().strip(".,;:!?()[]\"'") for w in (before.groups() if before else ()) if w]
    right = after[1].lower().strip(".,;:!?()[]\"'") if after else ""
    if not words:
        return []
    return [f"1 {words[-1]}", f"b {words[-1]} _ {right}"] + [f"2 {' '.join(words)}"] * (len(words) == 2)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_SEEN = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("value", pa.string()),
            ("fits", pa.list_(pa.string())),
            ("patterns", pa.list_(pa.string())),
        ]
    )
)


def _scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per document ``base`` spans, and ``seen``: seeds (with a kind) and other candidates (without)."""

    def prepare() -> Callable[[Texts], Made]:
        def work(texts: Texts) -> Made:
            bases, seens = [], []
            for content in texts:
                base, others = scan(content)
                bases.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
                seen = [(k, s, e, [k]) for k, s, e in base] + [
                    (None, s, e, fits) for form, s, e in others if (fits := _could_be(form, content[s:e]))
                ]
                seens.append(
                    [
                        {"kind": k, "start": s, "end": e, "value": content[s:e], "fits": fits, "patterns": patterns_around(content, s, e)}
                        for k, s, e, fits in seen
                    ]
                )
            return None, [pa.array(bases, _SPANS), pa.array(seens, _SEEN)]

        return work

    return map_texts(
        docs,
        "base array<struct<kind:string,start:int,end:int>>, seen array<struct<kind:string,start:int,"
        "end:int,value:string,fits:array<string>,patterns:array<string>>>",
        prepare,
        key,
        text,
    )


def learn_patterns(
    seen: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT
) -> DataFrame:
    """(pattern, kind, score) of the patterns to trust, from rows of kind (null: unknown), value, fits, patterns."""
    edges = materialize(
        seen.select("value", "kind", "fits", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value", "kind", "fits")
        .agg(F.count(F.lit(1)).alias("n")),
        "pattern-edges",
    )
    seeds = edges.filter("kind is not null")
    shown = seeds.groupBy("pattern", "kind").agg(F.count_distinct("value").alias("shown")).filter(F.col("shown") >= support)
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    known = seeds.select("pattern", "kind", "value", "n", F.lit(1.0).alias("score"))
    unknown = edges.filter("kind is null").select("pattern", "value", "n", F.explode("fits").alias("kind"))
    scores = None
    for _ in range(rounds):
        scores = materialize(
            known.groupBy("pattern", "kind")
            .agg(F.sum(F.col("n") * F.col("score")).alias("mass"))
            .join(totals, "pattern")
            .select("pattern", "kind", (F.col("mass") / (F.col("total") + 1)).alias("score")),
            "pattern-scores",
        )
        # an instance is as good as the mean of its patterns; patterns without any score count as nothing
        guessed = (
            unknown.join(scores, ["pattern", "kind"], "left")
            .groupBy("value", "kind")
            .agg((F.sum(F.col("n") * F.coalesce("score", F.lit(0.0))) / F.sum("n")).alias("score"))
            .filter("score > 0")
        )
        known = seeds.select("pattern", "kind", "value", "n", F.lit(1.0).alias("score")).unionByName(
            unknown.join(guessed, ["value", "kind"]).select("pattern", "kind", "value", "n", "score")
        )
    return scores.join(shown, ["pattern", "kind"]).filter(F.col("score") >= confidence).select("pattern", "kind", "score")


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings: float) -> DataFrame:
    """Per document ``base`` and ``added`` spans (kind, start, end), each by kind as listed, then start."""
    scanned = materialize(
        _scanned(docs, key, text).withColumn("row", F.monotonically_increasing_id()), "personal-data"
    )
    seen = scanned.select("row", F.inline("seen"))
    trusted = learn_patterns(seen, **settings)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = Window.partitionBy("row", "start", "end").orderBy(F.desc("score"), "rank")
    added = (
        seen.filter("kind is null")
        .select("row", "start", "end", "fits", F.explode("patterns").alias("pattern"))
        .join(trusted, "pattern")
        .filter(F.array_contains("fits", F.col("kind")))
        .withColumn("rank", rank)
        .withColumn("nth", F.row_number().over(best))
        .filter("nth = 1")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "start", "end", "kind"))).alias("added"))  # one document's
    )
    plain = F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    nothing = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return scanned.drop("seen").join(added, "row", "left").select(
        "doc_id", "base", F.coalesce(plain, nothing).alias("added")
    )


def digest(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined with commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Base counts per kind, the digest of the base spans, all spans as one string, and how many were added."""
    found = find_personal_data(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def of_kind(kind: str) -> Column:
        return F.sort_array(F.filter(F.concat("base", "added"), lambda s: s["kind"] == kind))

    in_order = F.flatten(F.array(*[of_kind(kind) for kind in KINDS]))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(in_order).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
