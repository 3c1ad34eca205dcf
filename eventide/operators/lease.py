"""Who may write: leases with fencing numbers, as files that can be made once only.

A lease is a numbered claim. The next number is taken by making its file, which
only one writer can; whoever holds the highest number that is neither released
nor over holds the lease. A writer whose lease ran out may still be at work, so
what it does is checked by its number: numbers only grow, and a pointer that was
turned under a higher one isn't turned back (:func:`publish.publish`).
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from eventide.operators.catalog import canonical_json
from eventide.operators.publish import Held, Store


@dataclass
class Lease:
    store: Store
    name: str
    owner: str
    fence: int
    clock: Callable[[], float]

    def _file(self, what: str = "") -> str:
        return f"leases/{self.name}/{self.fence:012d}{what}"

    def held(self) -> bool:
        """Whether it is still ours: not over, not released, and no higher number taken."""
        top, own = highest(self.store, self.name)
        return top == self.fence and own["until"] > self.clock() and not self.store.exists(self._file(".released"))

    def renew(self, seconds: float) -> None:
        """Hold on longer; Held if it is lost."""
        if not self.held():
            raise Held(f"lease {self.name}/{self.fence} of {self.owner} is lost")
        self.store.write(self._file(".json"), canonical_json({"owner": self.owner, "until": self.clock() + seconds}), replace=True)

    def release(self) -> None:
        self.store.create(self._file(".released"), b"{}")

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def highest(store: Store, name: str) -> tuple[int, dict]:
    numbers = [int(n[:-5]) for n in store.names(f"leases/{name}") if n.endswith(".json")]
    return (0, {}) if not numbers else (max(numbers), json.loads(store.read(f"leases/{name}/{max(numbers):012d}.json")))


def acquire(store: Store, name: str, owner: str, seconds: float, clock: Callable[[], float] = time.time) -> Lease:
    """The lease under the next number; Held while another has it."""
    top, now = highest(store, name)
    if top and now["until"] > clock() and not store.exists(f"leases/{name}/{top:012d}.released"):
        raise Held(f"lease {name} is held by {now['owner']}")
    lease = Lease(store, name, owner, top + 1, clock)
    if not store.create(lease._file(".json"), canonical_json({"owner": owner, "until": clock() + seconds})):
        raise Held(f"lease {name} was taken by another writer just now")
    return lease
