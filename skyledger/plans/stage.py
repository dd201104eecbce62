"""Guarded stages: every run is logged, a failed one leaves its tables as they were."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from skyledger.contracts import contract
from skyledger.sources.snapshots import SnapshotTable, Tables

AUDIT_TABLE = "audit.pipeline_run_log"


def new_run_id() -> str:
    return str(uuid.uuid4())


class RunLog:
    """Appends events to the audit table; without that table nothing is logged."""

    def __init__(self, tables: Tables, name: str):
        self.tables = tables
        self.name = name
        self._writer = uuid.uuid4().hex

    def write(self, status: str, **event: Any) -> None:
        audit = self.tables.log(AUDIT_TABLE)
        if not audit.exists():
            return
        details = event.pop("details", None)
        row = {
            "event_timestamp": datetime.now(timezone.utc),
            "pipeline_name": self.name,
            "status": status,
            "details": json.dumps(details, sort_keys=True, default=str) if details else None,
            **event,
        }
        entry = tuple(row.get(n) for n in contract(AUDIT_TABLE).schema.names)
        # Threads that log at once are writers of their own.
        audit.append_rows([entry], f"{self._writer}-{threading.get_ident()}")


@dataclass
class StageResult:
    """What a stage did; the body of the stage fills it in."""

    target_table: str
    rows_written: int = 0
    rows_removed: int = 0
    rows_rescued: int | None = None
    details: dict[str, Any] = field(default_factory=dict)

    def record(self, version) -> None:
        self.rows_written, self.rows_removed = version.rows_written, version.rows_removed


@contextmanager
def guarded(
    log: RunLog,
    stage: str,
    targets: Sequence[SnapshotTable],
    *,
    run_id: str,
    batch_id: str | None = None,
    **details: Any,
) -> Iterator[StageResult]:
    """Log STARTED, run the body, log SUCCESS; on an error restore all targets, log FAILED
    and raise. The first target is the one the log names."""
    about = {
        "stage_name": stage, "target_table": targets[0].name, "run_id": run_id, "batch_id": batch_id,
    }
    log.write("STARTED", **about, details=details)
    before = [table.version() for table in targets]
    result = StageResult(targets[0].name)
    try:
        yield result
    except Exception as error:
        restored = [
            table.restore(number) if table.version() != number else number
            for table, number in zip(targets, before)
        ]
        log.write(
            "FAILED", **about, restored_version=restored[0], error_message=str(error),
            details={**details, **dict(zip((t.name for t in targets), restored))},
        )
        raise
    log.write(
        "SUCCESS", **about, rows_written=result.rows_written, rows_removed=result.rows_removed,
        rows_rescued=result.rows_rescued, details={**details, **result.details},
    )
