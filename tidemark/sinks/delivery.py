"""Outbound delivery with bounded attempts.

The transport is the caller's: ``send(payload)`` returns the reply text or raises.
It runs inside the tasks, so it has to be picklable and should open its connection
once per process. A task that is run again sends its payloads again; receivers that
must not see one twice need a key in the payload.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import DELIVERY_RESULT

# Attempts in total, and the reply fields that mean success.
MAX_ATTEMPTS = 3
GATEWAY_FIELD = "success"
ANALYSIS_FIELD = "res"


def is_success(reply: str | None, field: str) -> bool:
    """Whether the reply is a JSON object with a truthy ``field``."""
    try:
        parsed = json.loads(reply) if reply is not None else None
    except (TypeError, ValueError):
        return False
    return isinstance(parsed, dict) and bool(parsed.get(field))


def _attempt(
    send: Callable[[str], str], payload: str, field: str, limit: int
) -> tuple[str, int, bool, str | None]:
    reply, tried = None, 0
    while tried < limit:
        tried += 1
        try:
            reply = send(payload)
        except Exception:  # the transport failed: that is one failed attempt
            reply = None
        if is_success(reply, field):
            return payload, tried, True, reply
    return payload, tried, False, reply


def deliver(
    df: DataFrame,
    send: Callable[[str], str],
    payload: str = "payload",
    field: str = GATEWAY_FIELD,
    max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Send each payload and return ``(payload, attempts, ok, reply)``.

    Write the result once and read the dead letters from there: evaluating the
    frame again would send again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_attempt(send, p, field, max_attempts) for p in batch["payload"]]
            yield pd.DataFrame(rows, columns=["payload", "attempts", "ok", "reply"])

    return df.select(F.col(payload).alias("payload")).mapInPandas(run, DELIVERY_RESULT)


def dead_letters(results: DataFrame) -> DataFrame:
    """The deliveries that failed every attempt."""
    return results.filter(~F.col("ok"))
