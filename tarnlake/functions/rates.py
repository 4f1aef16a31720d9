"""Rate and retry rules of polite fetching: plain functions and one small object."""

from __future__ import annotations

import math
from dataclasses import dataclass

from tarnlake.functions.columns import RETRY_CODES

MAX_ATTEMPTS = 5
REQUEST_FAILED, UNDECODABLE = -1, -2


def bounds(rate: float, multiplier: float) -> tuple[int, int]:
    """Lowest and highest rate around a starting rate; never below one a second."""
    if not 0 <= multiplier:
        raise ValueError("the multiplier must not be negative")
    return math.floor(max(rate * (1 - multiplier), 1)), max(1, math.floor(rate * (1 + multiplier)))


@dataclass
class Rate:
    """Requests a second to one server. Grows when answers are quick, falls by one on each retried error."""

    value: float
    low: float
    high: float

    @classmethod
    def around(cls, rate: float, multiplier: float) -> Rate:
        low, high = bounds(rate, multiplier)
        return cls(rate, low, high)

    def succeeded(self, seconds: float) -> None:
        self.value = min(max(self.value + 1 / self.value - seconds, self.low), self.high)

    def retried(self) -> None:
        self.value = max(self.value - 1, self.low)


def wants_retry(code: int, attempts: int) -> bool:
    """Whether a request that failed with ``code`` is tried again after ``attempts`` failures."""
    return (code in RETRY_CODES or code == REQUEST_FAILED) and attempts < MAX_ATTEMPTS


def enough_time(rate: float, seconds_left: float, batch_size: int = 10_000, write_seconds: float = 600) -> bool:
    """Whether a batch can be fetched and written before a deadline."""
    return rate * (seconds_left - write_seconds) >= batch_size
