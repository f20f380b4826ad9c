"""Repeat an action that may fail for a passing reason."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

Result = TypeVar("Result")
logger = logging.getLogger(__name__)

# Attempts and seconds between them.
CONNECT_ATTEMPTS, CONNECT_WAIT = 15, 5
WRITE_ATTEMPTS, WRITE_WAIT = 3, 5


def with_retry(
    action: Callable[[], Result],
    attempts: int,
    wait: float,
    when: Callable[[Exception], bool] = lambda error: True,
) -> Result:
    """Result of ``action``; errors for which ``when`` holds are retried, the last one is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            if attempt == attempts or not when(error):
                raise
            logger.warning("attempt %d of %d failed: %s", attempt, attempts, error)
            time.sleep(wait)
    raise ValueError("attempts must be at least 1")


def is_deadlock(error: Exception) -> bool:
    return "deadlock" in str(error)
