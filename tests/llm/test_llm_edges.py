"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import public_tokenizers
import pytest

from sedimenta.llm import (
    decontaminate,
    language_id,
    language_model,
    licenses,
    packing,
    pii,
    quality_rules,
    secrets,
    simhash,
    token_counts,
)

ODD = [
    (1, None, None),
    (2, "", "en"),
    (2, "", "en"),
    (3, " \n\t ", "en"),
    (None, "some text of no one", None),
    (None, None, None),
    (4, "The quick brown fox jumps over the lazy dog. " * 3000, "en"),
    (4, "another text under the same id", "en"),
    (5, "é ß 漢字 \U0001f600", "de"),
    (6, "x" * 20000, None),
]
# names the operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, fp long, n_words long, row long, words string, start int, word string, `a.b` int, `c``[d]` string"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, lang, "s", 0, 0, 0, "", 0, "", 0, "") for i, t, lang in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "quick brown fox"), (1, "quick brown fox"), (2, None), (3, ""), (None, "under the same"), (4, "!!")]
    return spark.createDataFrame(rows, "item_id long, text string")


PER_DOCUMENT = {
    "simhash": simhash.near_duplicates,
    "licenses": licenses.license_report,
    "pii": pii.personal_data_report,
    "secrets": secrets.secret_report,
    "language_model": language_model.score_documents,
    "language_id": language_id.identify,
    "quality": quality_rules.score_documents,
    "tokens": lambda docs: token_counts.count_tokens(docs, PIECES),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(odd, name):
    rows = PER_DOCUMENT[name](odd).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i, _, _ in ODD)
    twice = [r for r in rows if r["doc_id"] == 2]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_empty_table(empty, name):
    assert PER_DOCUMENT[name](empty).collect() == []


def test_defined_results(odd):
    by_id = {r["doc_id"]: r for r in simhash.near_duplicates(odd).collect()}
    assert by_id[1]["fingerprint"] == by_id[3]["fingerprint"] == "0" * 16 and by_id[3]["component_id"] == 1
    assert {r["score"] for r in language_id.identify(odd).collect() if r["doc_id"] == 3} == {0.0}
    assert {r["lang_pred"] for r in language_id.identify(odd).collect() if r["doc_id"] == 1} == {"und"}
    assert {r["n_tokens"] for r in language_model.score_documents(odd).collect() if r["doc_id"] == 2} == {1}
    judged = {r["doc_id"]: r for r in quality_rules.score_documents(odd).collect()}
    assert judged[1]["base_failed"] and not judged[1]["kept"] and judged[1]["n_words"] == 0


def test_packing(odd, empty):
    pieces = packing.pack(odd, TOKENIZER).collect()
    assert packing.pack(empty, TOKENIZER).collect() == []
    assert sum(p["length"] == p["doc_tokens"] == 1 for p in pieces) == 4  # no text: the end id alone
    assert sorted({p["doc_id"] for p in pieces if p["doc_id"] is not None}) == [1, 2, 3, 4, 5, 6]


def test_contamination(odd, empty, items):
    rows = decontaminate.contamination(odd, items).collect()
    assert len(rows) == len(ODD)
    hit = {(r["doc_id"], r["n_words"]): r for r in rows}
    assert hit[4, 27000]["n_hit"] == 9000 and hit[4, 27000]["contaminated"] and hit[4, 27000]["n_items"] == 1
    assert hit[4, 6]["n_hit"] == 3 and hit[4, 6]["n_items"] == 0  # an item without an id is found, but not listed
    assert hit[1, 0]["n_hit"] == 0 and not hit[1, 0]["contaminated"]
    assert decontaminate.contamination(empty, items).collect() == []
    assert all(r["n_hit"] == 0 for r in decontaminate.contamination(odd, items.limit(0)).collect())


@pytest.mark.parametrize("keep", [simhash.keep_one, quality_rules.keep_documents, secrets.redact])
def test_filters_keep_all_columns(odd, empty, keep):
    assert keep(odd).columns == odd.columns
    assert keep(empty).collect() == []


def test_decontamination_keeps_all_columns(odd, items):
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == len(ODD) - 2
