"""Active/passive lease on a shared file."""

from __future__ import annotations

import os
import threading
import time
from collections.abc import Callable


class Lease:
    """``owner time`` in a file. Taking over is one atomic step: a lock file that only one can create.

    ``lost`` is set when another node has taken the lease, so that work can stop.
    """

    def __init__(self, path: str, node: str, timeout: float = 15, clock: Callable[[], float] = time.time):
        self.path, self.node, self.timeout, self.clock = path, node, timeout, clock
        self.lost, self._stop, self._beat = threading.Event(), threading.Event(), None

    @property
    def enabled(self) -> bool:
        return bool(self.path)

    def read(self) -> tuple[str, float] | None:
        try:
            with open(self.path) as f:
                owner, _, at = f.read().rpartition(" ")
            return (owner, float(at)) if owner else None
        except (FileNotFoundError, ValueError):
            return None

    def _write(self) -> None:
        beside = f"{self.path}.{self.node}.tmp"
        with open(beside, "w") as f:
            f.write(f"{self.node} {self.clock()}")
        os.replace(beside, self.path)

    def _locked(self) -> bool:
        """Creates the lock file; False if another node holds it. One left by a node that died is removed after the timeout."""
        lock = f"{self.path}.lock"
        try:
            os.close(os.open(lock, os.O_CREAT | os.O_EXCL))
            return True
        except FileExistsError:
            try:
                if self.clock() - os.path.getmtime(lock) > self.timeout:
                    os.unlink(lock)
            except FileNotFoundError:
                pass
            return False

    def try_take(self) -> bool:
        """Takes a lease that is free, stale or ours."""
        if not self._locked():
            return False
        try:
            held = self.read()
            if held and held[0] != self.node and self.clock() - held[1] < self.timeout:
                return False
            self._write()
            return True
        finally:
            os.unlink(f"{self.path}.lock")

    def beat(self) -> bool:
        """Keeps the lease fresh; False if it is another's, or ours but older than the timeout, so that another may have begun."""
        if not self._locked():
            held = self.read()
            return bool(held) and held[0] == self.node and self.clock() - held[1] < self.timeout
        try:
            held = self.read()
            if not held or held[0] != self.node or self.clock() - held[1] >= self.timeout:
                return False
            self._write()
            return True
        finally:
            os.unlink(f"{self.path}.lock")

    def acquire(self, stop: Callable[[], bool] = lambda: False, wait: float = 1.0) -> bool:
        """Waits for the lease, then keeps it fresh; False if stopped or not enabled."""
        while self.enabled and not stop():
            if self.try_take():
                self._beat = threading.Thread(target=self._keep, daemon=True)
                self._beat.start()
                return True
            time.sleep(wait)
        return False

    def _keep(self) -> None:
        while not self._stop.wait(self.timeout / 3):
            if not self.beat():
                self.lost.set()
                return

    def release(self) -> None:
        self._stop.set()
        if self._beat:
            self._beat.join()

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_) -> None:
        self.release()
