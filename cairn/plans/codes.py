"""Source-system codes that models tag their rows with."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SystemCodes:
    """Codes per system, with an optional organisation prefix.

    ``SystemCodes("ABC")`` gives ``ABC-GEO-01`` and so on, for warehouses whose
    registry carries prefixed codes.
    """

    prefix: str = ""

    def _code(self, code: str) -> str:
        return f"{self.prefix}-{code}" if self.prefix else code

    @property
    def geo(self) -> str:
        return self._code("GEO-01")

    @property
    def bookings(self) -> str:
        return self._code("REV-01")

    @property
    def assets(self) -> str:
        return self._code("AST-01")

    @property
    def people(self) -> str:
        return self._code("HCM-01")

    @property
    def finance(self) -> str:
        return self._code("FIN-01")

    @property
    def enforcement(self) -> str:
        return self._code("LES-01")
