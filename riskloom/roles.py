"""Which column plays which part; every operator takes roles, never fixed column names."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    id: str
    target: str
    numeric: tuple[str, ...] = field(default_factory=tuple)
    categorical: tuple[str, ...] = field(default_factory=tuple)

    def all(self) -> list[str]:
        return [self.id, self.target, *self.numeric, *self.categorical]
