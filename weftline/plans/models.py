"""External model calls behind a replaceable provider; the default stand-ins are deterministic."""

from __future__ import annotations

import functools
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Provider:
    """A named way to answer ``(system, user)``; calls a minute, calls at once and a pause after a failure are kept for each worker process.

    A budget for a whole job is shared by giving each worker its part of it:
    ``per_minute`` over the number of tasks that call at once.
    """

    name: str
    call: Callable[[str, str], str]
    per_minute: int = 3
    cooldown: float = 60.0
    ready: bool = True
    host: str = ""
    at_once: int = 4
    _calls: deque = field(default_factory=deque, repr=False)
    _resting_until: float = 0.0

    def answer(self, system: str, user: str, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> str:
        now = clock()
        while self._calls and now - self._calls[0] >= 60:
            self._calls.popleft()
        if len(self._calls) >= self.per_minute:
            sleep(60 - (now - self._calls[0]))
        self._calls.append(clock())
        with _gate(self.name, self.at_once):
            return self.call(system, user)


@functools.lru_cache(maxsize=None)
def _gate(name: str, at_once: int) -> threading.BoundedSemaphore:
    """The calls that a provider has at once in this process."""
    return threading.BoundedSemaphore(at_once)


class Chain:
    """Providers in order of preference: one that is not ready or rests after a failure is passed over; an empty answer if all fail.

    ``host_rest`` seconds after a failure no provider of the same host is asked.
    """

    def __init__(self, providers: list[Provider], clock: Callable[[], float] = time.monotonic, host_rest: float = 5.0):
        self.providers, self.clock, self.lock, self.host_rest, self.hosts = providers, clock, threading.Lock(), host_rest, {}

    def __getstate__(self):
        return {"providers": self.providers, "clock": self.clock, "host_rest": self.host_rest, "hosts": self.hosts}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.lock = threading.Lock()

    def __call__(self, system: str, user: str) -> str:
        for p in self.providers:
            if not p.ready or max(p._resting_until, self.hosts.get(p.host, 0.0) if p.host else 0.0) > self.clock():
                continue
            try:
                return p.answer(system, user)
            except Exception:  # noqa: BLE001  Any failure of a provider is a reason to try the next.
                with self.lock:
                    p._resting_until = self.clock() + p.cooldown
                    self.hosts[p.host] = self.clock() + self.host_rest
        return ""


def stub(answers: Callable[[str, str], str] = lambda system, user: "") -> Chain:
    return Chain([Provider("stub", answers, per_minute=1 << 30)])


def ask(chain: Chain, system: str, user: Column) -> Column:
    """A model's answer to each text; the chain is made once in each worker."""

    @F.pandas_udf("string")
    def answered(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda u: None if u is None else chain(system, u))

    return answered(user)


#: Which kind of model each task asks for.
ROUTES = {
    "conflict_detection": "mid_reasoning", "hypothesis_synthesis": "heavy_reasoning", "verification": "heavy_reasoning", "summarization": "long_context",
    "gap_detection": "mid_reasoning", "impact_analysis": "mid_reasoning", "reasoning": "heavy_reasoning", "query_memory": "fast",
}


def route(task: str, classify: Callable[[str], str] | None = None) -> str:
    """The kind for a known task or kind, else what ``classify`` says, else mid_reasoning."""
    if task in ROUTES:
        return ROUTES[task]
    if task in ROUTES.values():
        return task
    said = classify(task) if classify else ""
    return said if said in ROUTES.values() else "mid_reasoning"
