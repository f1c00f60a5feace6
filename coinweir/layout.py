"""Where each layer lives under one base URI."""

from __future__ import annotations

from dataclasses import dataclass

from coinweir.vocab import MARTS


@dataclass(frozen=True)
class Layout:
    """Paths of the layers. `base` is any URI Spark can read and write.

    The incoming folders and `raw` are inputs; everything a job writes lies outside the
    folders it watches, so that no job can trigger itself.
    """

    base: str

    def _under(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self._under("raw")

    @property
    def landing(self) -> str:
        return self._under("landing")

    @property
    def rejects(self) -> str:
        return self._under("rejects")

    def archive(self, source: str) -> str:
        return self._under("archive", source)

    @property
    def staging(self) -> str:
        return self._under("staging")

    @property
    def places(self) -> str:
        return self._under("ops", "places")

    @property
    def claims(self) -> str:
        return self._under("ops", "claims")

    @property
    def landing_folds(self) -> str:
        return self._under("ops", "landing_folds")

    @property
    def month_parts(self) -> str:
        return self._under("ops", "month_parts")

    @property
    def late_rows(self) -> str:
        return self._under("ops", "late_rows")

    @property
    def heartbeat(self) -> str:
        return self._under("ops", "heartbeat")

    def checkpoint(self, job: str) -> str:
        return self._under("checkpoints", job)

    def mart(self, name: str) -> str:
        if name not in MARTS:
            raise ValueError(f"unknown mart {name!r}, expected one of {', '.join(MARTS)}")
        return self._under("marts", name)
