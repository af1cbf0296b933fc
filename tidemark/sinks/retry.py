"""Writes that are tried again when a connection is lost."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")
log = logging.getLogger(__name__)

#: Java exceptions of stores that cannot be reached for now.
LOST = ("java.net.ConnectException", "java.net.SocketException", "java.net.SocketTimeoutException", "java.net.NoRouteToHostException", "java.sql.SQLTransientConnectionException", "java.sql.SQLRecoverableException")


def connection_lost(fault: BaseException) -> bool:
    """Whether a fault, or one that caused it, is a lost connection."""
    java = getattr(fault, "java_exception", None)
    if java is not None:
        while java is not None:
            if java.getClass().getName() in LOST:
                return True
            java = java.getCause()
    return isinstance(fault, (ConnectionError, TimeoutError))


def retried(write: Callable[[], T], attempts: int = 30, delay_s: float = 2.0, lost: Callable[[BaseException], bool] = connection_lost, sleep: Callable[[float], None] = time.sleep) -> T:
    """What write returns, tried again so often while connections are lost. Other faults are raised at once.

    Only for writes that can be repeated, as all sinks here can.
    """
    for left in range(attempts - 1, -1, -1):
        try:
            return write()
        except Exception as fault:
            if not left or not lost(fault):
                raise
            log.warning("a write failed (%s), %d attempts left", type(fault).__name__, left)
            sleep(delay_s)
    raise ValueError("attempts is to be 1 or more")
