"""Readers, writers, snapshots and the demo and fixture tables."""

from riskframe.sources.demo import synthetic_policies
from riskframe.sources.policies import POLICIES_SQL, policies
from riskframe.sources.readers import (
    coerce_date,
    coerce_numeric,
    coercion_report,
    load_policies,
    preview,
    read_policies,
)
from riskframe.sources.records import malformed_report, read_csv_records
from riskframe.sources.tables import (
    check_snapshot,
    read_snapshot,
    shared_folder,
    snapshot_table,
    stage,
    table_diff,
    table_fingerprint,
    write_result,
)

__all__ = [
    "POLICIES_SQL", "check_snapshot", "coerce_date", "coerce_numeric", "coercion_report", "load_policies",
    "malformed_report", "policies", "preview", "read_csv_records", "read_policies", "read_snapshot",
    "shared_folder", "snapshot_table", "stage", "synthetic_policies", "table_diff", "table_fingerprint", "write_result",
]
