"""Column contracts, validation rules and lineage — plain data, no Spark work."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


class ContractError(ValueError):
    """The input does not meet its contract (missing or colliding columns, no rule columns)."""


class GateError(RuntimeError):
    """A quality gate failed after its evidence (summary, quarantine) was written."""


@dataclass(frozen=True)
class TableContract:
    """Standardised column name -> Spark SQL type, plus key and required columns.

    The contract is open: columns present in the data but not named here pass
    through as strings; contract columns absent from the data produce warnings.
    """

    name: str
    columns: dict[str, str]
    keys: tuple[str, ...] = ()
    required: tuple[str, ...] | None = None

    @property
    def required_columns(self) -> tuple[str, ...]:
        return self.keys if self.required is None else self.required


@dataclass(frozen=True)
class ValidationRules:
    """What the single-pass validation checks, and the metric names it reports."""

    fact_keys: tuple[str, ...]
    ref_keys: tuple[str, ...]
    nonnegative: tuple[str, ...]
    fact_ref_key: str
    ref_key: str
    fact_label: str = "staffing"
    ref_label: str = "provider"
    measure_label: str = "hours"
    reasons: dict[str, str] = field(default_factory=dict)

    def reason(self, kind: str) -> str:
        if kind in self.reasons:
            return self.reasons[kind]
        # Quarantine reasons.
        defaults = {
            "fact_missing": f"missing_required_{self.fact_label}_fields",
            "ref_missing": f"missing_required_{self.ref_label}_key",
            "fact_duplicate": f"duplicate_{self.fact_label}_keys",
            "ref_duplicate": f"duplicate_{self.ref_label}_keys",
            "negative": f"negative_{self.fact_label}_{self.measure_label}",
            "unmatched": f"unmatched_{self.ref_label}_reference_warning",
        }
        return defaults[kind]


@dataclass(frozen=True)
class Lineage:
    """Lineage stamped on refined rows; the time is fixed once per run (trap T11)."""

    run_id: str
    dataset_name: str
    source_file_name: str
    run_ts: _dt.datetime

    @staticmethod
    def fixed(run_id: str, dataset_name: str, source_file_name: str,
              run_ts: str = "2024-07-01 00:00:00") -> "Lineage":
        return Lineage(run_id, dataset_name, source_file_name,
                       _dt.datetime.fromisoformat(run_ts))
