"""Where the tables of a lake live under its root."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._at("bronze", "transactions")

    @property
    def silver(self) -> str:
        return self._at("silver", "transactions")

    def staging(self, name: str) -> str:
        return self._at("staging", name)

    def gold(self, name: str) -> str:
        return self._at("gold", name)

    def raw(self, entity: str) -> str:
        return self._at("raw", entity)

    @property
    def model(self) -> str:
        return self._at("models", "isolation_forest")

    @property
    def audit(self) -> str:
        return self._at("audit")
