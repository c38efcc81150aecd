"""Run parameters, passed explicitly to whatever needs them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Parameters of one pipeline run.

    ``copper_per_gold`` is the currency rate, ``run_mode`` the order-fact mode
    (``"standard"`` stores it, ``"backfill"`` keeps it as a plan only) and ``run_id``
    the identifier stamped into audit columns and the build ledger.

    ``task_bytes`` is what one task of a join should hold, in file bytes: join keys whose rows
    would fill two tasks or more are spread over as many as they fill. A lookup whose files are
    at most ``broadcast_bytes`` is broadcast; its joins do not shuffle and are not profiled. File
    bytes are compressed: decoded, a lookup may take about ten times that on every executor.
    """

    copper_per_gold: int = 100
    run_mode: str = "standard"
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    task_bytes: int = 64 << 20
    broadcast_bytes: int = 10 << 20

    def __post_init__(self) -> None:
        if self.copper_per_gold <= 0:
            raise ValueError("copper_per_gold must be positive")
        if self.run_mode not in ("standard", "backfill"):
            raise ValueError(f"unknown run_mode {self.run_mode!r}")
