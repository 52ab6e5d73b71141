"""Run parameters: all required, none with a default, blanks refused."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from carelake.fixed_values import BUSINESS_TIMEZONE, ENTITIES


def require(params: Mapping[str, str], name: str, allowed: Collection[str] | None = None) -> str:
    """The stripped value of a parameter; ValueError if absent, blank or not allowed."""
    value = (params.get(name) or "").strip()
    if not value:
        raise ValueError(f"{name} is missing or blank; no parameter has a default")
    if allowed is not None and value not in allowed:
        raise ValueError(f"{name} = {value!r} is not among: {', '.join(sorted(allowed))}")
    return value


@dataclass(frozen=True)
class LakeConfig:
    """Where a run reads and writes.

    ``run_id`` names the batch and must be the same when a run is retried: files and
    audit rows of the retry then replace or close those of the first attempt (C03).
    """

    catalog: str
    storage_root: str
    source: str
    entity: str
    run_id: str
    timezone: str = BUSINESS_TIMEZONE

    @classmethod
    def from_params(cls, params: Mapping[str, str]) -> LakeConfig:
        return cls(
            catalog=require(params, "catalog"),
            storage_root=require(params, "storage_root").rstrip("/"),
            source=require(params, "source"),
            entity=require(params, "entity", allowed=ENTITIES),
            run_id=require(params, "run_id"),
        )

    def table(self, layer: str, name: str) -> str:
        return f"{self.catalog}.{layer}.{name}"

    def layer(self, layer: str) -> str:
        return f"{self.catalog}.{layer}"

    def published(self, group: str) -> str:
        """Where a group of tables that change together is published."""
        return f"{self.storage_root}/groups/{group}"

    @property
    def landing_path(self) -> str:
        return f"{self.storage_root}/landing/raw/{self.source}/{self.entity}"

    @property
    def bronze_path(self) -> str:
        return f"{self.storage_root}/bronze/{self.source}_{self.entity}"

    @property
    def checkpoint_path(self) -> str:
        """Kept under ops: file retention on the landing area must never reach it."""
        return f"{self.storage_root}/ops/checkpoints/{self.source}_{self.entity}"

    @property
    def modified_field(self) -> str | None:
        return ENTITIES[self.entity]["modified_field"]
