"""Arrow batches of texts in, Arrow columns out, with document ids carried unchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from sedimenta.session import ship

#: Documents turned into Python objects at a time.
ROWS = 1000

Texts = list[str | None]
#: Output columns of a batch, and which document each row belongs to (None: one row per document, in order).
Made = tuple[Sequence[int] | None, list[pa.Array]]


def map_texts(
    docs: DataFrame,
    columns: str,
    prepare: Callable[[], Callable[[Texts], Made]],
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``doc_id``, the columns to ``keep``, then ``columns`` as made from each batch of texts.

    ``prepare`` runs once per task. Ids may be null and of any type; they never leave Arrow.
    """
    ship(docs.sparkSession)
    plain = docs.select(docs[key].alias("doc_id"), docs[text].alias("_text"), *[docs[c] for c in keep])
    kept = [f for f in plain.schema.fields if f.name != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        names = [f.name for f in kept] + [c.strip().split()[0] for c in _top_level(columns)]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                owners, made = work(batch.column(1).to_pylist())
                carried = [batch.column(i) for i in range(batch.num_columns) if i != 1]
                if owners is not None:
                    rows = pa.array(owners, pa.int64())
                    carried = [c.take(rows) for c in carried]
                yield pa.RecordBatch.from_arrays(carried + made, names)

    before = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return plain.mapInArrow(run, f"{before}, {columns}")


def _top_level(columns: str) -> list[str]:
    """``columns`` cut at commas outside brackets."""
    parts, depth = [""], 0
    for char in columns:
        depth += (char in "<(") - (char in ">)")
        if char == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += char
    return parts
