"""Table definitions and the names every module agrees on."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Reserved names and stamps.
BRANCH, INSERTED, UPDATED, HASH, VERSION, VERSION_DATE = "BRANCH_ID", "insert_at", "Recorded_updated_at", "merge_hash", "version", "version_date"
HELPER_CDC, HELPER_DATE = "ETL_HELPER_CDC", "ETL_HELPER_DATE"
DERIVED_KEY = "DERIVED_KEY"
INJECTED = (BRANCH, INSERTED, UPDATED)
STAMPS = (*INJECTED, HASH, VERSION, VERSION_DATE)
OPERATORS = frozenset({"<", "<=", ">", ">=", "="})


@dataclass(frozen=True)
class HelperJoin:
    """A parent table that lends its change columns to a child without any: ``pairs`` of (child, parent) columns."""

    table: str
    pairs: tuple[tuple[str, str], ...]
    cdc_column: str | None = None
    date_column: str | None = None


@dataclass(frozen=True)
class TableDef:
    """``category``: masters, transactions or snapshots. ``table`` may be a query in brackets, which then needs a ``name``."""

    table: str
    keys: tuple[str, ...] = ()
    category: str = "masters"
    name: str | None = None
    cdc_column: str | None = None
    date_column: str | None = None
    date_operator: str = ">="
    date_value: str | None = None
    date_max: str | None = None
    date_max_operator: str = "<="
    date_is_julian: bool = False
    derived_key: str | None = None
    helper: HelperJoin | None = None
    options: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self):
        if self.is_query and not self.name:
            raise ValueError("a query source needs a name")
        if {self.date_operator, self.date_max_operator} - OPERATORS:
            raise ValueError("unknown comparison operator")

    @property
    def is_query(self) -> bool:
        return self.table.lstrip().startswith("(")

    @property
    def is_snapshot(self) -> bool:
        return self.category == "snapshots"

    @property
    def lake_name(self) -> str:
        return normal(self.name or self.table.rsplit(".", 1)[-1])

    @property
    def change_column(self) -> str | None:
        return HELPER_CDC if self.helper and self.helper.cdc_column else self.cdc_column

    @property
    def time_column(self) -> str | None:
        return HELPER_DATE if self.helper and self.helper.date_column else self.date_column


def normal(name: str) -> str:
    """Lower snake: every run of other characters is one underscore, none at the ends."""
    return re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()
