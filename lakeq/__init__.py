"""lakeq — a Spark-native lake quality and curation library.

Land files, refine them against column contracts, validate in one pass,
curate facts and dimensions, serve joins and metrics, and profile tables —
all as DataFrame / SQL expressions that Catalyst plans.
"""

from lakeq.contracts import ContractError, GateError, Lineage, TableContract, ValidationRules
from lakeq.session import get_session, scratch_path

__all__ = [
    "ContractError",
    "GateError",
    "Lineage",
    "TableContract",
    "ValidationRules",
    "get_session",
    "scratch_path",
]
