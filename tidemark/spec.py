"""Column-role metadata that drives hashing and merges.

A `TableSpec` lists the declared columns of a table in order and tags each with a
role: natural key, audit column, SCD1 / SCD2 tracked column. Columns whose name
ends with ``_PK`` are treated as keys for the change hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    columns: tuple[str, ...]
    natural_keys: tuple[str, ...] = ()
    audit: tuple[str, ...] = ()
    scd1: tuple[str, ...] = ()
    scd2: tuple[str, ...] = ()
    pk_suffix: str = "_PK"
    widths: dict = field(default_factory=dict)

    def change_columns(self) -> list[str]:
        """Columns in the change hash: all declared minus keys, audit and *_PK."""
        skip = set(self.natural_keys) | set(self.audit)
        return [c for c in self.columns if c not in skip and not c.endswith(self.pk_suffix)]

    def full_columns(self) -> list[str]:
        """Columns in the full hash: all declared minus audit columns."""
        skip = set(self.audit)
        return [c for c in self.columns if c not in skip]

    def scd1_columns(self) -> list[str]:
        return [c for c in self.columns if c in set(self.scd1)]

    def scd2_columns(self) -> list[str]:
        return [c for c in self.columns if c in set(self.scd2)]
