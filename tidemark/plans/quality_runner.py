"""Q6: the blocking gate runner.

The gate values are five one-row aggregates; only those five numbers reach
the driver.  The ledger row is written before the failure is raised, so an
audit trail exists for every refused publication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.lake import Lake
from .ingest import save_quality


def run_gates(lake: Lake, gates: DataFrame) -> dict:
    results = {r["gate"]: int(r["value"]) for r in gates.collect()}
    passed = all(v == 0 for v in results.values())
    save_quality(lake, results, passed)
    if not passed:
        raise ValueError("blocking_quality_failure_" + ",".join(k for k, v in results.items() if v))
    return results
