"""Exponential back-off with jitter."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

R = TypeVar("R")


@dataclass(frozen=True)
class Policy:
    base_s: float
    most_s: float
    factor: float = 2.0
    retries: int = 3


#: The retry policies.
DEFAULT = Policy(1, 5)
FAST = Policy(0.1, 2)
SLOW = Policy(5, 30)
STREAM = Policy(1, 30)


class Backoff:
    """Delays of a policy: each grows by the factor up to the most, plus up to a fifth of jitter."""

    def __init__(self, policy: Policy, jitter: Callable[[], float] = random.random):
        self.policy, self.jitter = policy, jitter
        self.reset()

    def reset(self) -> None:
        self.delay_s, self.tries = self.policy.base_s, 0

    def next(self) -> float:
        """Seconds to wait; stays at the most once retries are used up."""
        delay = self.delay_s
        self.tries += 1
        self.delay_s = min(self.delay_s * self.policy.factor, self.policy.most_s)
        return delay + delay / 5 * self.jitter()

    @property
    def exhausted(self) -> bool:
        return self.tries >= self.policy.retries


def retry(work: Callable[[], R], policy: Policy = DEFAULT, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random, within_s: float | None = None) -> R:
    """Call until it works; the last error is raised once retries, or ``within_s`` seconds, are used up."""
    backoff, began = Backoff(policy, jitter), time.monotonic()
    while True:
        try:
            return work()
        except Exception:
            if backoff.exhausted or (within_s is not None and time.monotonic() - began >= within_s):
                raise
            sleep(backoff.next())
