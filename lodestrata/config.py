"""Settings of a deployment, from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta

from .operators.purge import Limits


@dataclass(frozen=True)
class Config:
    """Where to read, where to keep, and the knobs. A value that can't be right is an error at the start."""

    source: str
    store: str
    checkpoint: str
    prefix: str = "catalog"
    consumer: str = "tables"
    files_per_trigger: int = 100
    batch_interval_s: float = 5.0
    strict_hash: bool = False
    refresh_mode: str = "durable"
    limits: Limits = Limits()

    def __post_init__(self):
        if self.files_per_trigger < 1 or self.batch_interval_s <= 0:
            raise ValueError("batches need at least one file and a positive interval")
        if self.refresh_mode not in ("durable", "inline"):
            raise ValueError(f"unknown refresh mode {self.refresh_mode!r}")
        if not 0 < self.limits.most_deleted <= 1 or not 0 <= self.limits.least_seen <= 1:
            raise ValueError("fractions lie between zero and one")


def from_env(env: Mapping[str, str] = os.environ) -> Config:
    limits = Limits(
        most_deleted=float(env.get("PURGE_MAX_DELETE_FRACTION", 0.90)),
        least_seen=float(env.get("SEEN_MIN_FRACTION", 0.95)),
        margin=timedelta(minutes=float(env.get("SEEN_MARGIN_MINUTES", 15))),
        mode=env.get("SEEN_LIST_MODE", "touch"),
    )
    return Config(
        source=env["CATALOG_SOURCE"],
        store=env["CATALOG_STORE"],
        checkpoint=env["CATALOG_CHECKPOINT"],
        files_per_trigger=int(env.get("BATCH_FILES", 100)),
        batch_interval_s=float(env.get("BATCH_INTERVAL_SECONDS", 5)),
        strict_hash=env.get("STRICT_HASH", "").lower() in ("1", "true", "yes"),
        refresh_mode=env.get("DERIVED_REFRESH_MODE", "durable"),
        limits=limits,
    )
