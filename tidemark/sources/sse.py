"""Server-sent events: framing, and a live feed as a streaming data source."""

from __future__ import annotations

import threading
import time
import urllib.request
from collections import deque
from collections.abc import Iterable, Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

SCHEMA = "id string, event string, data string"
#: Waits between attempts in seconds: doubled from the first to the last, and reset by any event.
FIRST_WAIT, LAST_WAIT = 1.0, 60.0


def frames(lines: Iterable[str]) -> Iterator[tuple[str | None, str, str]]:
    """(id, event, data) of each frame that a blank line ends.

    Comments are ignored, one space after the colon is dropped, data lines are joined by line feeds, the id lasts until
    another comes, and a frame without data is none.
    """
    last_id, event, data = None, "message", []
    for line in lines:
        if not line:
            if data:
                yield last_id, event, "\n".join(data)
            event, data = "message", []
            continue
        name, _, value = line.partition(":")
        value = value.removeprefix(" ")
        if name == "data":
            data.append(value)
        elif name == "event":
            event = value
        elif name == "id":
            last_id = value


def waits() -> Iterator[float]:
    """The waits before each further attempt."""
    wait = FIRST_WAIT
    while True:
        yield wait
        wait = min(2 * wait, LAST_WAIT)


def http_lines(url: str, last_id: str | None, timeout: float) -> Iterator[str]:
    headers = {"Accept": "text/event-stream"} | ({"Last-Event-ID": last_id} if last_id else {})
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as response:
        for line in response:
            yield line.decode("utf-8", "replace").rstrip("\r\n")


class FeedReader(SimpleDataSourceStreamReader):
    """Reads at most ``events`` events or ``seconds`` a batch, from the last confirmed id on.

    Spark's offset log holds the id: a batch is confirmed once it is written, so a restart resumes before any event that
    was not, and what the feed sends again is for the duplicate filter.
    """

    def __init__(self, options: dict[str, str], lines=http_lines, sleep=time.sleep):
        self.url, self.most, self.seconds = options["url"], int(options.get("events", 2000)), float(options.get("seconds", 5))
        self.attempts, self.timeout = int(options.get("attempts", 10)), float(options.get("timeout", 60))
        self.lines, self.sleep = lines, sleep

    def initialOffset(self) -> dict:
        return {"id": ""}

    def _frames(self, start: str) -> Iterator[tuple[str | None, str, str]]:
        """Frames after start, over as many connections as it takes; fails after so many attempts without an event."""
        last, waiting, tries = start or None, waits(), 0
        while True:
            try:
                for frame in frames(self.lines(self.url, last, self.timeout)):
                    last, waiting, tries = frame[0] or last, waits(), 0
                    yield frame
            except OSError:
                tries += 1
                if tries >= self.attempts:
                    raise
            else:
                tries += 1
                if tries >= self.attempts:
                    return
            self.sleep(next(waiting))

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, last, until = [], start["id"], time.monotonic() + self.seconds
        for frame in self._frames(start["id"]):
            rows.append(frame)
            last = frame[0] or last
            if len(rows) >= self.most or time.monotonic() > until:
                break
        return iter(rows), {"id": last}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """A batch that is read again. If the feed no longer holds its end, it fails after ten times a batch's events or seconds."""
        if start == end:
            return
        until = time.monotonic() + 10 * self.seconds
        for n, frame in enumerate(self._frames(start["id"])):
            yield frame
            if frame[0] == end["id"]:
                return
            if n >= 10 * self.most or time.monotonic() > until:
                raise OSError(f"the feed does not hold the event {end['id']!r} any more, which ends the batch after {start['id']!r}")


class PrefetchingReader(FeedReader):
    """Reads the feed ahead of batches, into a buffer of ``prefetch`` events.

    A thread takes events off the connection while a batch is written, so that slow sinks do not leave the feed waiting. What the
    buffer holds is waiting for a batch, or was given to one that is not confirmed; the longest confirmed prefix is
    let go. While it is full the thread takes nothing, for ``stall`` seconds at most: then it gives up the connection, before any gap,
    and the next batch resumes from the last event in the buffer. A batch that is read again comes from the buffer, if it still holds it.
    """

    def __init__(self, options: dict[str, str], lines=http_lines, sleep=time.sleep):
        super().__init__(options, lines, sleep)
        self.options = options
        self.most_held, self.stall = int(options.get("prefetch", 10_000)), float(options.get("stall", 60))
        self.changed = threading.Condition()
        self.ahead: deque = deque()
        self.given: deque = deque()  # in flight: read by a batch, not confirmed
        self.filled_to: str | None = None  # the id up to which the feed was taken
        self.read_to: str | None = None
        self.let_go: str | None = None  # the id up to which all is confirmed
        self.fault: BaseException | None = None
        self.run, self.filling, self.released = 0, False, 0

    def __reduce__(self):
        return PrefetchingReader, (self.options,)

    def _fill(self, run: int, start: str) -> None:
        try:
            for frame in self._frames(start):
                with self.changed:
                    while run == self.run and len(self.ahead) + len(self.given) >= self.most_held:
                        if not self.changed.wait(self.stall):
                            return
                    if run != self.run:
                        return
                    self.ahead.append(frame)
                    self.filled_to = frame[0] or self.filled_to
                    self.changed.notify_all()
        except OSError as e:
            self.fault = e
        finally:
            with self.changed:
                if run == self.run:
                    self.filling = False
                self.changed.notify_all()

    def _started(self, start: str) -> None:
        """The thread runs, and what it brings follows start."""
        if start != self.read_to:
            self.run += 1
            self.ahead.clear()
            self.given.clear()
            self.filled_to = self.read_to = self.let_go = start
            self.filling = False
        if not self.filling and len(self.ahead) + len(self.given) < self.most_held:
            self.filling, self.fault = True, None
            threading.Thread(target=self._fill, args=(self.run, self.filled_to or ""), daemon=True).start()

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        with self.changed:
            self._started(start["id"])
            self.changed.wait_for(lambda: self.ahead or not self.filling, self.seconds)
            if not self.ahead and self.fault:
                raise self.fault
            rows = [self.ahead.popleft() for _ in range(min(self.most, len(self.ahead)))]
            self.given.extend(rows)
            self.read_to = next((i for i, *_ in reversed(rows) if i), start["id"])
            self.changed.notify_all()
            return iter(rows), {"id": self.read_to}

    def commit(self, end: dict) -> None:
        """Lets go of what the batch up to end was given; an id that the buffer does not know changes nothing."""
        with self.changed:
            if any(i == end["id"] for i, *_ in self.given):
                while self.given:
                    i = self.given.popleft()[0]
                    self.released += 1
                    if i == end["id"] and not any(j == i for j, *_ in self.given):
                        break
                self.let_go = end["id"]
            self.changed.notify_all()

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        with self.changed:
            ids = [i for i, *_ in self.given]
            known = start["id"] in ids or start["id"] == self.let_go
            if end["id"] in ids and known:
                last = len(ids) - 1 - ids[::-1].index(end["id"])
                first = len(ids) - ids[::-1].index(start["id"]) if start["id"] in ids else 0
                return iter(list(self.given)[first : last + 1])
        return super().readBetweenOffsets(start, end)


def registered(spark) -> None:
    """Makes the format ``sse`` known to the session."""
    spark.dataSource.register(Feed)


class Feed(DataSource):
    """Options: url; events and seconds (of a batch); attempts; timeout; prefetch (events in a buffer; none: no buffer) and stall."""

    @classmethod
    def name(cls) -> str:
        return "sse"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> FeedReader:
        return (PrefetchingReader if "prefetch" in self.options else FeedReader)(dict(self.options))
