"""What workers hold: a bounded memory of results for pieces of text that come again, and memory that they have freed."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa


def _trimmer() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):  # not glibc
        return None


_trim = _trimmer()

_held: dict[str, dict] = {}


def held_by(owner: str) -> dict:
    """What an operator keeps in a worker process from one task to the next."""
    return _held.setdefault(owner, {})


def keep_only(owner: str | None = None) -> None:
    """To be called where a task begins: what other operators kept in this process is given back."""
    for name, kept in _held.items():
        if name != owner:
            kept.clear()
    give_back()


def give_back() -> None:
    """To be called where a task ends: what this process has freed goes back to the system. A worker stays for the tasks after it, and
    the allocators of Arrow and the C library would keep the most that any task took, beside what the executor's JVM takes by then."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


class Memory(dict):
    """What short pieces came to. When the newer half is full, it becomes the older one, and what was old and not met since goes."""

    def __init__(self, limit: int):
        super().__init__()
        self._limit, self._older = limit // 2, {}

    def turn(self) -> None:
        """To be called between batches: what a batch has asked for stays until then."""
        if len(self) > self._limit:
            self._older = dict(self)
            self.clear()

    def missing(self, pieces: set) -> list:
        """Those that are not known at all; the others can be looked up from now on."""
        older = self._older
        rest = pieces.difference(self)
        self.update((piece, older[piece]) for piece in rest if piece in older)
        return [piece for piece in rest if piece not in older]
