"""Leaving an overloaded provider alone: a state that all tasks of all executors share, in the shared folder."""

from __future__ import annotations

import math
import random
import re
import time
import uuid
from collections.abc import Callable

import pyarrow.fs as pafs

from firmlens.shared import open_store

#: What in an error says that the provider is overloaded.
OVERLOAD = r"rate.?limit|resource.?exhausted|exhausted|service.?unavailable|429|503"


def overloaded(error: Exception) -> bool:
    return bool(re.search(OVERLOAD, f"{type(error).__name__} {error}".lower()))


def backoff(attempt: int, base: float = 1.0, most: float = 30.0, jitter: float = 0.0) -> float:
    """Seconds to wait before a retry: doubling from base up to most, plus a share (0 to 1) of a second."""
    return min(most, base * 2 ** max(0, attempt - 1)) + min(max(jitter, 0.0), 1.0)


class Pressure:
    """A provider's recent errors, as small files that are only ever added: no task can overwrite what another one noted.

    `burst` errors without a success between them, by any tasks, begin a cooldown of `cooldown` seconds for all. Names hold
    times in milliseconds: e… an error, s… a success after errors, c… until when to wait. What is older than the last
    cooldown is deleted when the next one begins.
    """

    def __init__(self, folder: str, *, burst: int = 3, cooldown: float = 30.0, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.folder, self.burst, self.cooldown, self.clock, self.sleep = folder, burst, cooldown, clock, sleep

    def _noted(self) -> list[tuple[str, int, str]]:
        """(kind, time, name) of all notes."""
        fs, path = open_store(self.folder)
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return [(m[1], int(m[2]), f.base_name) for f in found if (m := re.fullmatch(r"([esc])(\d+)-\w+", f.base_name))]

    def _note(self, kind: str, at: float) -> None:
        fs, path = open_store(self.folder)
        fs.create_dir(path, recursive=True)
        fs.open_output_stream(f"{path}/{kind}{math.ceil(at * 1000):015d}-{uuid.uuid4().hex}").close()

    def _pending(self, noted: list[tuple[str, int, str]]) -> int:
        """Errors since the last success and the last cooldown."""
        since = max([t for k, t, _ in noted if k == "s"] + [t - int(self.cooldown * 1000) for k, t, _ in noted if k == "c"], default=-1)
        return sum(k == "e" and t > since for k, t, _ in noted)

    def until(self) -> float:
        """When the last cooldown ends; 0 if there was none."""
        return max((t for k, t, _ in self._noted() if k == "c"), default=0) / 1000

    def wait(self) -> float:
        """Return when no cooldown is on; the seconds waited."""
        began = self.clock()
        while (rest := self.until() - self.clock()) > 0:
            self.sleep(rest)
        return self.clock() - began

    def failed(self) -> None:
        """Note an error of overload."""
        now = self.clock()
        self._note("e", now)
        noted = self._noted()
        if self._pending(noted) >= self.burst and not any(k == "c" and t > now * 1000 for k, t, _ in noted):
            self._note("c", now + self.cooldown)
            fs, path = open_store(self.folder)
            for kind, at, name in noted:
                if kind != "c" and at < (now - 2 * self.cooldown) * 1000 or kind == "c" and at < now * 1000 - self.cooldown * 1000:
                    try:
                        fs.delete_file(f"{path}/{name}")
                    except FileNotFoundError:  # another task was faster
                        pass

    def succeeded(self) -> None:
        """Note a success, if errors are pending: a call without errors before it writes nothing."""
        if self._pending(self._noted()):
            self._note("s", self.clock())


def call(provider: Callable[[str], tuple[str, int]], prompt: str, pressure: Pressure | None, tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> tuple[str, int]:
    """The provider's answer, asked for up to `tries` times where it is overloaded: a cooldown is waited out first, then each retry
    waits longer than the last. The last error, and any other, goes up."""
    for attempt in range(1, tries + 1):
        if pressure:
            pressure.wait()
        try:
            answer = provider(prompt)
        except Exception as e:
            if pressure and overloaded(e):
                pressure.failed()
            if attempt == tries or not overloaded(e):
                raise
            sleep(backoff(attempt, jitter=random.random() * min(1.0, 0.25 * 2 ** (attempt - 1))))
            continue
        if pressure:
            pressure.succeeded()
        return answer
    raise ValueError("tries must be 1 at least")
