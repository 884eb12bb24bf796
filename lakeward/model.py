"""Data-product model: a contract names a source, a column contract, ordered
steps, quality rules and storage.  Loaded from a dict or a YAML file and
validated at load time (unknown source or step types are errors, not warnings).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

SOURCE_TYPES = {"kafka", "file", "json", "parquet", "delta_table", "table", "stream"}
STEP_TYPES = {"deduplicate", "filter", "hash", "sql", "expr", "join", "pyspark_function",
              "merge", "upgrade"}
ON_FAILURE = {"warn", "alert_squad", "block_silver_write", "block_gold_write", "block"}


class ContractError(ValueError):
    """A contract that cannot be run."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    pii: bool = False
    pii_class: str | None = None
    pk: bool = False
    allowed_values: tuple | None = None
    system_assigned: bool = False
    description: str | None = None

    @staticmethod
    def from_dict(d: dict) -> "Field":
        if "name" not in d or "type" not in d:
            raise ContractError(f"schema field needs name and type: {d}")
        av = d.get("allowed_values")
        return Field(name=d["name"], type=str(d["type"]), nullable=bool(d.get("nullable", True)),
                     pii=bool(d.get("pii", False)), pii_class=d.get("pii_class"),
                     pk=bool(d.get("pk", False)), allowed_values=tuple(av) if av else None,
                     system_assigned=bool(d.get("system_assigned", False)),
                     description=d.get("description"))


@dataclass(frozen=True)
class Step:
    name: str
    type: str
    params: dict = field(default_factory=dict)

    @staticmethod
    def from_dict(d: dict) -> "Step":
        if d.get("type") not in STEP_TYPES:
            raise ContractError(f"unknown step type {d.get('type')!r} in step {d.get('name')!r}")
        params = {k: v for k, v in d.items() if k not in ("name", "type")}
        return Step(name=d.get("name", d["type"]), type=d["type"], params=params)


@dataclass(frozen=True)
class Tier:
    enabled: bool = True
    format: str = "parquet"
    path: str | None = None
    partition_by: tuple = ()
    z_order_by: tuple = ()
    retention_days: int | None = None

    @staticmethod
    def from_dict(d: dict | None) -> "Tier":
        d = d or {}
        return Tier(enabled=d.get("enabled", True) is not False and bool(d),
                    format=d.get("format", "parquet"), path=d.get("path"),
                    partition_by=tuple(d.get("partition_by", []) or []),
                    z_order_by=tuple(d.get("z_order_by", []) or []),
                    retention_days=d.get("retention_days"))


@dataclass(frozen=True)
class Quality:
    completeness: tuple = ()      # dicts: column, check, threshold, ref
    uniqueness: tuple = ()        # dicts: columns, threshold
    business_rules: tuple = ()    # dicts: name, violation | sql, expected, on_failure
    volume: dict | None = None
    freshness_sla_minutes: float | None = None
    on_failure: str = "warn"

    @staticmethod
    def from_dict(d: dict | None) -> "Quality":
        d = d or {}
        on_failure = d.get("on_failure", "warn")
        if on_failure not in ON_FAILURE:
            raise ContractError(f"unknown on_failure {on_failure!r}")
        return Quality(completeness=tuple(d.get("completeness", []) or []),
                       uniqueness=tuple(d.get("uniqueness", []) or []),
                       business_rules=tuple(d.get("business_rules", []) or []),
                       volume=d.get("volume"), freshness_sla_minutes=d.get("freshness_sla_minutes"),
                       on_failure=on_failure)


@dataclass(frozen=True)
class Product:
    name: str
    version: str
    owner: str
    source: dict
    fields: tuple
    steps: tuple
    quality: Quality
    storage: dict            # tier name -> Tier
    raw: dict = field(default_factory=dict, compare=False, repr=False)

    # -- schema -----------------------------------------------------------
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)

    def field(self, name: str) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)

    def pii_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.pii]

    def keys(self) -> list[str]:
        return [f.name for f in self.fields if f.pk]

    def tier(self, name: str) -> Tier:
        return self.storage.get(name, Tier(enabled=False))


def load_product(spec: dict | str | Path) -> Product:
    """Build a Product from a dict or a YAML path; raise ContractError if unusable."""
    if not isinstance(spec, dict):
        import yaml

        with open(spec) as fh:
            spec = yaml.safe_load(fh)
    if "contract" not in spec:
        raise ContractError("missing 'contract' block")
    if "schema" not in spec:
        raise ContractError("missing 'schema' block")
    c = spec["contract"]
    for k in ("name", "version"):
        if k not in c:
            raise ContractError(f"contract.{k} is required")
    owner = c.get("owner_squad") or c.get("owner")
    if not owner:
        raise ContractError("contract needs an owner (owner_squad)")
    if "quality" not in spec:
        raise ContractError("contract needs a quality block")
    source = dict(spec.get("source") or {})
    if source.get("type") not in SOURCE_TYPES:
        raise ContractError(f"unknown source type {source.get('type')!r}")
    fields_ = tuple(Field.from_dict(f) for f in spec["schema"])
    names = [f.name for f in fields_]
    if len(set(names)) != len(names):
        raise ContractError("duplicate field names in schema")
    steps = tuple(Step.from_dict(s) for s in spec.get("transformations", []) or [])
    storage = {t: Tier.from_dict(v) for t, v in (spec.get("storage") or {}).items()}
    return Product(name=c["name"], version=str(c["version"]), owner=owner, source=source,
                   fields=fields_, steps=steps, quality=Quality.from_dict(spec.get("quality")),
                   storage=storage, raw=spec)


def parse_version(v: str) -> tuple[int, int, int]:
    try:
        parts = tuple(int(p) for p in str(v).split("."))
    except ValueError as exc:
        raise ContractError(f"invalid version {v!r}") from exc
    if len(parts) != 3:
        raise ContractError(f"invalid version {v!r}")
    return parts  # type: ignore[return-value]


def as_dict(x: Any) -> dict:
    return dict(x) if isinstance(x, dict) else {}
