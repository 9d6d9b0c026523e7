"""Settings and results of the jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from sedimenta.operators.conform import ConformSpec
from sedimenta.operators.layers import CastSpec
from sedimenta.operators.mapping import CUTOFF, PREFIX
from sedimenta.operators.quality import Expectation


@dataclass(frozen=True)
class MappingPolicy:
    """How column names are grouped and named.

    ``exclusive`` names are grouped alone; ``split`` names are taken out of groups afterwards;
    ``manual`` gives the name of the group that holds a given member.
    """

    exclusive: tuple[str, ...] = ()
    split: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    manual: Mapping[str, str] = field(default_factory=dict)
    prefix: str = PREFIX
    cutoff: float = CUTOFF
    top_n: int | None = None
    veto: bool = True


@dataclass(frozen=True)
class BronzePolicy:
    """``layout`` and ``mode`` as in ``repartition_for_write`` and ``write_partitioned``.

    With ``mode="publish"`` partitions are written aside and become current in one step. ``manifest_path`` keeps the catalog
    of files, so that a later run opens new and changed ones only. ``layout="sized"`` takes the bytes of the input from
    that catalog. ``preview`` rows of the result go into the report.
    """

    mapping: MappingPolicy
    conform: ConformSpec
    ts_col: str
    keys: tuple[str, ...]
    layout: str | int = "none"
    mode: str = "dynamic"
    glob: str = "*.parquet"
    mapping_path: str | None = None
    quarantine_path: str | None = None
    manifest_path: str | None = None
    preview: int = 0


@dataclass(frozen=True)
class SilverSpec:
    """``on_fail="raise"`` checks before writing; ``"warn"`` checks during the write.

    With ``mode="publish"`` both check during the write, and ``"raise"`` leaves the rows unpublished. Rows that
    fail a check go to ``violations_path``, if there are any; ``preview`` rows of the result go into the report.
    """

    source_keys: tuple[str, ...]
    casts: tuple[CastSpec, ...]
    amounts: tuple[str, ...]
    total: str
    output: tuple[str, ...]
    keys: tuple[str, ...]
    where: Mapping[str, str] = field(default_factory=dict)
    suite: tuple[Expectation, ...] = ()
    on_fail: str = "warn"
    amount_type: str | None = None
    layout: str | int = "none"
    mode: str = "dynamic"
    report_path: str | None = None
    violations_path: str | None = None
    preview: int = 0


@dataclass(frozen=True)
class MartSpec:
    """``scale``: decimals of the values; with it means do not depend on the order of rows.

    ``parts_path`` keeps sums and counts of each partition of a published table, so that a later run reads only the
    partitions that were published since; it needs ``scale``.
    """

    keys: tuple[str, ...]
    amount: str
    ts: str
    passengers: str
    digits: int = 2
    scale: int | None = None
    parts_path: str | None = None


@dataclass(frozen=True)
class RunConfig:
    """A full run: raw files to bronze, bronze to silver, silver to the two means."""

    raw: str
    bronze: str
    silver: str
    table: str
    bronze_policy: BronzePolicy
    silver_spec: SilverSpec
    mart_spec: MartSpec


@dataclass
class RunReport:
    """Outcome of a job: ``ok``, ``no_data``, ``missing`` (no such input) or ``failed``."""

    job: str
    status: str
    rows: int | None = None
    error: Exception | None = None
    quality: DataFrame | None = None
    frames: dict[str, DataFrame] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.status == "ok"

    @property
    def exit_code(self) -> int:
        return 0 if self.ok else 1
