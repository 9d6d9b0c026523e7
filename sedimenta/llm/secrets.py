"""Secret scans with one combined deterministic automaton.

All rules are read backwards into one automaton that may begin anywhere. A single pass from a text's
last byte to its first therefore marks every byte at which some rule's match starts, for all rules
together. Each rule then takes its marks from left to right, skips those inside its last match, and
walks its own automaton to the longest end. That gives the leftmost-longest, non-overlapping matches
of each rule, in time linear in the text.

Defined results: a null text is empty. Null ids, ties and repeated rows do not matter: each row is
scanned alone and gives one row. Empty tables give empty results. ``find_secrets`` ignores columns it
is not told to keep; ``redact`` keeps all. Texts are scanned whole; memory is a few times one Arrow
batch plus the transition arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.automaton import Automaton, compile_rules, parse, reverse
from sedimenta.llm.batches import Made, Texts, map_texts
from sedimenta.session import ship


@dataclass(frozen=True)
class Rule:
    """``head`` then ``body``; a match counts if its body and whole are long enough, in bytes.

    Matches that are too short are dropped, but the text they cover is used up. A length may be part of
    an expression only where a match is a maximal run of one class (``hex``); there it means the same
    and saves a mark for each short run. More such counters would multiply the automaton's states.
    """

    kind: str
    head: str
    body: str
    least_body: int = 1
    least: int = 1
    base: bool = False


# Forms of secrets that the base rules ask for, then public token formats of well-known services.
RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=-]+",
        least_body=12,
        base=True,
    ),
    Rule("access", "AKIA", "[A-Z0-9]+", least=18, base=True),
    Rule("hex", "", "[0-9a-f]{16,}", base=True),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", ""),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]+", least_body=36),
    Rule("slack", "xox[abprs]-", "[0-9A-Za-z-]+", least_body=20),
    Rule("google", "AIza", "[0-9A-Za-z_-]+", least_body=35),
    Rule("stripe", "[rs]k_live_", "[0-9A-Za-z]+", least_body=24),
    Rule("jwt", r"eyJ[0-9A-Za-z_-]+\.eyJ[0-9A-Za-z_-]+\.", "[0-9A-Za-z_-]+", least_body=16, least=40),
)

SPAN = "array<struct<kind:string,start:int,end:int>>"
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    starts: Automaton
    whole: tuple[Automaton, ...]
    heads: tuple[Automaton | None, ...]

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """Kind, start and end in code points, by start, then in the order of rules."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        found = []
        for rule, marks in enumerate(self._marks(data)):
            free = len(data)
            for back in range(len(marks) - 1, -1, -1):  # marks were made from right to left
                start = marks[back]
                if back < len(marks) - 1 and start < free:
                    continue
                end = _longest(self.whole[rule], data, start)
                free = end
                if self._long_enough(rule, data, start, end):
                    found.append((start, rule, end))
        found.sort()
        return _in_code_points(data, text, [(self.rules[r].kind, s, e) for s, r, e in found])

    def _marks(self, data: bytes) -> list[list[int]]:
        """Where each rule's matches start, from right to left; the one pass over all bytes."""
        step, quiet, accepts = self.starts.next, self.starts.quiet, self.starts.accepts
        marks: list[list[int]] = [[] for _ in self.rules]
        state, at = 0, len(data)
        for byte in reversed(data):
            state = step[state + byte]
            at -= 1
            if state >= quiet:
                for rule in accepts[state >> 8]:
                    marks[rule].append(at)
        return marks

    def _long_enough(self, rule: int, data: bytes, start: int, end: int) -> bool:
        wanted, head = self.rules[rule], self.heads[rule]
        body = end - (_longest(head, data, start) if head else start)
        return end - start >= wanted.least and body >= wanted.least_body * bool(wanted.body)


def _longest(automaton: Automaton, data: bytes, start: int) -> int:
    """End of the longest match that begins at ``start``."""
    step, quiet, dead = automaton.next, automaton.quiet, automaton.dead
    state, end, at = 0, start, start
    for at in range(start, len(data)):
        state = step[state + data[at]]
        if state >= quiet:
            end = at + 1
        elif state == dead:
            break
    return end


def _in_code_points(data: bytes, text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if len(data) == len(text):
        return spans
    place, before, count = {}, 0, 0
    for at in sorted({x for _, s, e in spans for x in (s, e)}):
        count += len(data[before:at].decode("utf-8", "surrogatepass"))
        before, place[at] = at, count
    return [(kind, place[s], place[e]) for kind, s, e in spans]


@lru_cache
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """Compiled once per process."""
    wholes = [parse(rule.head + rule.body) for rule in rules]
    return Scanner(
        rules,
        compile_rules([reverse(node) for node in wholes], anywhere=True),
        tuple(compile_rules([node], anywhere=False) for node in wholes),
        tuple(compile_rules([parse(rule.head)], anywhere=False) if rule.head else None for rule in rules),
    )


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per document: ``doc_id`` and ``secrets``, an array of kind, start and end."""
    def prepare() -> Callable[[Texts], Made]:
        spans_of = scanner(rules).spans

        def scan(texts: Texts) -> Made:
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t)] for t in texts]
            return None, [pa.array(rows, ARROW_SPAN)]

        return scan

    return map_texts(docs, f"secrets {SPAN}", prepare, key, text)


def digest(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined with commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as one string."""
    base = [rule.kind for rule in rules if rule.base]
    found = find_secrets(docs, rules=rules)

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{kind}": count(kind) for kind in base}
    return found.withColumns(counts).select(
        "doc_id",
        *counts,
        F.sha2(digest(F.filter("secrets", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        digest(F.col("secrets")).alias("spans"),
    )


def _masked(text: str | None, rules: tuple[Rule, ...], mask: str) -> str | None:
    spans = scanner(rules).spans(text)
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in spans:
        if end <= at:
            continue
        out += [text[at : max(start, at)], mask.format(kind=kind)] if start >= at else []
        at = end
    return "".join([*out, text[at:]])


def redact(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mask: str = "[{kind}]"
) -> DataFrame:
    """All documents and columns, with each secret in ``text`` replaced; overlapping ones by one mask."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def mask_all(texts: pd.Series) -> pd.Series:
        return pd.Series([_masked(t, rules, mask) for t in texts], dtype="object")

    return docs.withColumn(text, mask_all(docs[text]))
