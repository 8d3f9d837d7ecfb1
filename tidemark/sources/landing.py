"""Fetching pages and payloads into a landing table, with retries.

``fetch`` is any callable url -> text; the default opens the URL. Each partition
fetches its own rows; a page that keeps failing becomes a null body and an error.
"""

from __future__ import annotations

import random
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def open_url(url: str, timeout: float = 25.0) -> str:
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as answer:
        return answer.read().decode("utf-8")


class RateLimit:
    """At most ``per_minute`` calls in any 60 seconds, and ``spacing`` seconds between two calls."""

    def __init__(self, per_minute: int, spacing: float = 0.0, clock: Callable[[], float] = time.monotonic, pause: Callable[[float], None] = time.sleep):
        self.per_minute, self.spacing, self.clock, self.pause = per_minute, spacing, clock, pause
        self.calls: deque[float] = deque(maxlen=per_minute)

    def wait(self) -> None:
        now, free = self.clock(), 0.0
        if self.calls:
            free = self.calls[-1] + self.spacing
        if len(self.calls) == self.per_minute:
            free = max(free, self.calls[0] + 60.0)
        if free > now:
            self.pause(free - now)
        self.calls.append(max(now, free))


def schedule(n: int, per_minute: int, spacing: float) -> list[float]:
    """When ``n`` calls that are ready at once may begin, in seconds."""
    now, begun = [0.0], []
    limit = RateLimit(per_minute, spacing, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(n):
        limit.wait()
        begun.append(now[0])
    return begun


def with_retries(fetch: Callable[[str], str], url: str, attempts: int = 3, pause: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """(body, error): pauses of 2 ** n plus 0.5 to 1.5 seconds between attempts."""
    error = None
    for n in range(attempts):
        try:
            return fetch(url), None
        except Exception as e:  # any failure of a remote call is retried
            error = f"{type(e).__name__}: {e}"
            if n + 1 < attempts:
                pause(2**n + random.uniform(0.5, 1.5))
    return None, error


def land(
    urls: DataFrame,
    column: str = "url",
    fetch: Callable[[str], str] = open_url,
    attempts: int = 3,
    pause: Callable[[float], None] = time.sleep,
    keys: Sequence[str] = (),
    per_minute: int | None = None,
    spacing: float = 0.0,
) -> DataFrame:
    """``keys``, url, body, error for every URL.

    ``per_minute`` and ``spacing`` limit the calls of each partition: a limit for all
    is divided by the number of partitions that run at once.
    """
    kinds = {f.name: f.dataType.simpleString() for f in urls.schema}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["url string", "body string", "error string"])

    def pages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit = RateLimit(per_minute, spacing, pause=pause) if per_minute else None

        def limited(url: str) -> str:
            if limit:
                limit.wait()
            return fetch(url)

        for frame in frames:
            got = [with_retries(limited, u, attempts, pause) for u in frame["url"]]
            yield frame.assign(body=[b for b, _ in got], error=[e for _, e in got])

    return urls.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{column}`").alias("url")).mapInPandas(pages, schema)


def push(df: DataFrame, keys: Sequence[str], payload: str, send: Callable[[str, list[dict]], None], target: str, batch: int = 500, attempts: int = 3, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """Upsert rows into a service: (keys, error) for every row, null where its batch arrived.

    ``send(target, rows)`` gets batches of {key columns, payload} and must replace rows
    of equal keys, since a task that is repeated sends its batches again. Only the
    last row of each key is worth sending; see ``relational.last_wins``.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def sent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            errors: list[str | None] = []
            for i in range(0, len(frame), batch):
                rows = frame.iloc[i : i + batch].to_dict("records")
                _, error = with_retries(lambda url, rows=rows: send(url, rows), target, attempts, pause)
                errors += [error] * len(rows)
            yield frame[list(keys)].assign(error=errors)

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["error string"])
    return df.select(*keys, payload).mapInPandas(sent, schema)
