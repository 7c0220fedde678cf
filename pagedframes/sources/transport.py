"""How page bodies are fetched. A transport is pickled and used inside tasks."""

from __future__ import annotations

import copy
import http.client
import math
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column

from pagedframes.constants import (
    BACKOFF_JITTER,
    BACKOFF_MAX_SECONDS,
    BACKOFF_MIN_SECONDS,
    MAX_RETRIES,
    PAGE_SIZE,
    PAUSE_SECONDS,
    TIMEOUT_SECONDS,
)


class NotFound(LookupError):
    """There is nothing behind the URL."""


def is_absent(error: Exception) -> bool:
    """Whether ``error`` says that there is nothing behind a URL, rather than that it could not be asked."""
    return isinstance(error, LookupError) or (isinstance(error, urllib.error.HTTPError) and error.code in (404, 410))


@dataclass(frozen=True)
class Paging:
    """How an endpoint is asked for a page."""

    page_param: str = "page"
    size_param: str = "items_per_page"
    size: int = PAGE_SIZE

    def url(self, endpoint: str, page: int) -> str:
        joint = "&" if "?" in endpoint else "?"
        return f"{endpoint}{joint}{self.size_param}={self.size}&{self.page_param}={page}"


@dataclass(frozen=True)
class Budget:
    """At most ``per_second`` requests in any second, by all tasks of a read together.

    Tasks cannot talk to each other, so each gets a whole number of requests a
    second, and there are no more tasks than whole requests. An attempt waits
    before its first request, so one that takes the place of a lost task does
    not add to what that one had sent.
    """

    per_second: float

    def tasks(self, wanted: int) -> int:
        return max(1, min(wanted, math.floor(self.per_second)))

    def interval(self, tasks: int) -> float:
        """Seconds between the requests of one of ``tasks``."""
        return 1 / (math.floor(self.per_second / tasks) or self.per_second)


class Pace:
    """Called before each request of a task; sleeps until it is due."""

    def __init__(self, seconds: float):
        self.seconds, self.due = seconds, None

    def __call__(self) -> None:
        now = time.monotonic()
        due = now + self.seconds if self.due is None else self.due
        if due > now:
            time.sleep(due - now)
        self.due = time.monotonic() + self.seconds


def at_once() -> None:
    """No budget."""


class Transport:
    """Gets bodies by relative URL; override ``pages`` where a range is cheaper."""

    pace: Callable[[], None] = staticmethod(at_once)

    def paced(self, pace: Callable[[], None]) -> Transport:
        """The same transport, with ``pace`` called before each request."""
        other = copy.copy(self)
        other.pace = pace
        return other

    def get(self, url: str) -> str:
        """The body behind ``url``; raises LookupError if there is none."""
        raise NotImplementedError

    def place(self, url: Column) -> Column | None:
        """Where the body of ``url`` lies, evenly spread from 0 to under 2^32, if what lies together is cheaper to get together."""
        return None

    def fetch(self, url: str) -> str:
        """One request at the transport's pace."""
        self.pace()
        return self.get(url)

    def pages(self, endpoint: str, first: int, last: int | None, paging: Paging) -> Iterator[tuple[int, str]]:
        """The bodies of pages ``first..last``; without ``last``, on and on."""
        page = first
        while last is None or page <= last:
            yield page, self.fetch(paging.url(endpoint, page))
            page += 1


class FunctionTransport(Transport):
    """Any picklable function from relative URL to body."""

    def __init__(self, fetch: Callable[[str], str]):
        self.get = fetch


def _retry_after(headers) -> float:
    """The seconds that a server asks to wait; 0 if it gives none, or a date."""
    given = ((headers or {}).get("Retry-After") or "").strip()
    return float(given) if given.isdigit() else 0.0


class HttpTransport(Transport):
    """HTTP GET with retries, after the wait that the server asks for. ``headers`` is called per request, so tokens can be renewed."""

    def __init__(
        self,
        base_url: str,
        headers: Callable[[], dict[str, str]] = dict,
        pause: float = PAUSE_SECONDS,
        timeout: float = TIMEOUT_SECONDS,
        opener: Callable = urllib.request.urlopen,
    ):
        self.base_url, self.headers = base_url.rstrip("/"), headers
        self.pause, self.timeout, self.opener = pause, timeout, opener

    def fetch(self, url: str) -> str:
        return self.get(url)  # which paces each attempt

    def get(self, url: str) -> str:
        wait = BACKOFF_MIN_SECONDS
        asked = 0.0
        for attempt in range(MAX_RETRIES + 1):
            request = urllib.request.Request(self.base_url + url, headers=self.headers())
            self.pace()
            try:
                with self.opener(request, timeout=self.timeout) as response:
                    body = response.read().decode("utf-8", errors="replace")
                time.sleep(self.pause)
                return body
            except urllib.error.HTTPError as error:
                # a refused request stays refused; only throttling and server trouble pass
                if attempt == MAX_RETRIES or (error.code != 429 and error.code < 500):
                    raise
                asked = _retry_after(error.headers)
            except (urllib.error.URLError, TimeoutError, ConnectionError, http.client.HTTPException):
                # the last two: a connection lost while the body was read
                if attempt == MAX_RETRIES:
                    raise
                asked = 0.0
            time.sleep(max(asked, wait * (1 + random.random() * BACKOFF_JITTER)))
            wait = min(2 * wait, BACKOFF_MAX_SECONDS)
        raise AssertionError("unreachable")
