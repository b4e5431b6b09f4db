"""Fetch API answers for links that have none yet.

The only Python on the data path: one remote call per link is inherently per row. Spark still
distributes it - the links still to fetch (an anti join against what has landed, so an
interrupted run resumes where it stopped) are spread over ``partitions`` tasks and each task
calls the injected ``fetch`` for its rows inside ``mapInPandas``.

``fetch(ref) -> str | None`` receives ``"tt" + imdbId`` and returns the answer text; raising or
returning None counts as a failed attempt. Failed attempts are retried with exponential backoff
(``delay * base**i`` seconds before retry ``i``) up to ``max_retries`` times within a total
``max_wait`` budget, which also ends a call that does not return; a link that never succeeds lands with a null answer and is tried again on the
next run.

A task may have several calls under way (:class:`Pace`). All calls of a task pass one :class:`Gate`: it
spaces them so that all tasks together keep to the calls per second of the whole job, holds them back
for as long as the API asks (``fetch`` raises :class:`RetryLater`), and, when many attempts in a row have
failed, for a cooling time, so an API that is down is not hammered by every link. A ``sleep`` given
without a ``clock`` brings its own time (:class:`Timeline`): a wait ends when it returns.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text

# Retry budget per call (attempts after the first, first delay in seconds,
# backoff base, total wait in seconds) and the task count of the original fetch job.
MAX_RETRIES, FIRST_DELAY, BACKOFF_BASE, MAX_WAIT = 6, 1.0, 2.0, 70.0
FETCH_PARTITIONS = 128
# Links per landed batch.
BATCH_LINKS = 20_000


class RetryLater(Exception):
    """The API asks to be left alone for some seconds (as with HTTP status 429)."""

    def __init__(self, seconds: float = 1.0):
        super().__init__(f"retry in {seconds} s")
        self.seconds = seconds


@dataclass(frozen=True)
class Pace:
    """How fast the job may call: ``calls_per_second`` over all tasks (None: no limit), ``concurrent``
    calls under way in a task; after ``trip_after`` failed attempts in a row a task pauses for
    ``cool_down`` seconds, and again after each further one until a call succeeds."""

    calls_per_second: float | None = None
    concurrent: int = 1
    trip_after: int = 20
    cool_down: float = 10.0


class Timeline:
    """Time that a given ``sleep`` passes: the monotonic clock, put forward by what the sleep did not last.
    A gate and its calls then see every wait as over when ``sleep`` returns, be it real or not."""

    def __init__(self, sleep: Callable[[float], None]):
        self.given, self.ahead = sleep, 0.0
        self.lock = threading.Lock()

    def clock(self) -> float:
        return time.monotonic() + self.ahead

    def sleep(self, seconds: float) -> None:
        until = self.clock() + seconds
        self.given(seconds)
        with self.lock:
            self.ahead = max(self.ahead, until - time.monotonic())


class Gate:
    """What the calls of one task pass, one after the other. Safe for threads."""

    def __init__(self, pace: Pace, tasks: int = 1, sleep: Callable[[float], None] = time.sleep,
                 clock: Callable[[], float] = time.monotonic):
        self.pace, self.sleep, self.clock = pace, sleep, clock
        self.interval = tasks / pace.calls_per_second if pace.calls_per_second else 0.0
        self.lock = threading.Lock()
        self.next = self.closed_until = float("-inf")
        self.failures = 0

    def enter(self, deadline: float) -> bool:
        """Wait for this call's turn; False if that would be after ``deadline``."""
        while True:
            with self.lock:
                now = self.clock()
                start = max(now, self.next, self.closed_until)
                if start > deadline:
                    return False
                if start <= now:
                    self.next = now + self.interval
                    return True
            self.sleep(start - now)

    def succeeded(self) -> None:
        with self.lock:
            self.failures = 0

    def failed(self) -> None:
        with self.lock:
            self.failures += 1
            if self.failures >= self.pace.trip_after:
                self.closed_until = max(self.closed_until, self.clock() + self.pace.cool_down)

    def hold(self, seconds: float) -> None:
        with self.lock:
            self.closed_until = max(self.closed_until, self.clock() + seconds)


def call_until(fetch: Callable[[str], str | None], ref: str, seconds: float) -> str | None:
    """One attempt that ends after ``seconds`` at the latest: the call runs on a thread of its own,
    which is left behind if it does not return. None for a failed or late call; a call that was
    told to come back later raises :class:`RetryLater`."""
    answers: queue.Queue = queue.Queue(1)

    def run():
        try:
            answers.put(fetch(ref))
        except RetryLater as later:
            answers.put(later)
        except Exception:  # noqa: BLE001 - any transport error is a failed attempt
            answers.put(None)

    threading.Thread(target=run, daemon=True).start()
    try:
        answer = answers.get(timeout=max(seconds, 0.001))
    except queue.Empty:
        return None
    if isinstance(answer, RetryLater):
        raise answer
    return answer


def call_with_backoff(fetch: Callable[[str], str | None], ref: str,
                      max_retries: int = MAX_RETRIES, delay: float = FIRST_DELAY,
                      base: float = BACKOFF_BASE, max_wait: float = MAX_WAIT,
                      sleep: Callable[[float], None] = time.sleep,
                      clock: Callable[[], float] = time.monotonic,
                      gate: Gate | None = None) -> str | None:
    """One answer, or None when every attempt failed or the time budget ran out. Being told to come
    back later is no failed attempt."""
    start = clock()
    gate = gate or Gate(Pace(trip_after=max_retries + 2), 1, sleep, clock)
    attempt = -1
    while attempt < max_retries:
        attempt += 1
        if not gate.enter(start + max_wait):
            break
        try:
            answer = call_until(fetch, ref, max_wait - (clock() - start))
        except RetryLater as later:
            gate.hold(max(later.seconds, 0.001))
            attempt -= 1
            continue
        if answer is not None:
            gate.succeeded()
            return answer
        gate.failed()
        if attempt == max_retries:
            break
        pause = delay * base ** attempt
        if clock() - start + pause > max_wait:
            break
        sleep(pause)
    return None


def missing_links(links: DataFrame, landed: DataFrame | None) -> DataFrame:
    """Links without a landed non-null answer (all links when nothing has landed)."""
    todo = links.select("movieId", "imdbId")
    if landed is None:
        return todo
    done = landed.where(F.col("response").isNotNull()).select("movieId")
    return todo.join(done, "movieId", "left_anti")


def fetch_missing(links: DataFrame, landed: DataFrame | None,
                  fetch: Callable[[str], str | None], partitions: int = FETCH_PARTITIONS,
                  pace: Pace | None = None, **retry) -> DataFrame:
    """``movieId, imdbId, response`` for every link still without an answer. With a ``pace`` of several
    concurrent calls ``fetch`` must be safe for threads."""
    todo = missing_links(links, landed).withColumn("_ref", text.imdb_ref("imdbId"))
    pace = pace or Pace()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = dict(retry)
        if "sleep" in given and "clock" not in given:
            line = Timeline(given["sleep"])
            given |= {"sleep": line.sleep, "clock": line.clock}
        gate = Gate(pace, partitions, **{k: given[k] for k in ("sleep", "clock") if k in given})

        def call(ref: str) -> str | None:
            return call_with_backoff(fetch, ref, gate=gate, **given)

        with ThreadPoolExecutor(pace.concurrent) as pool:
            for batch in batches:
                answers = list(map(call, batch["_ref"]) if pace.concurrent == 1
                               else pool.map(call, batch["_ref"]))
                yield pd.DataFrame({"movieId": batch["movieId"], "imdbId": batch["imdbId"],
                                    "response": pd.Series(answers, dtype=object)})

    return todo.repartition(partitions).mapInPandas(run, S.OMDB_RESPONSES)
