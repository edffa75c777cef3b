"""A paginated REST source of signals as a Python data source, batch and streaming.

``feed_pages`` reads several feeds of a service, each in a task of its own; ``signal_pages`` reads one in the driver.

The reader keeps what belongs to the connection: the token and its refresh on 401, the
request limiter, logins counted, one wait on 429, the following of ``nextPage`` to a cap, and the place where
a scan stops: at the first record older than ``since``, whose position on its page goes with the
page. Deduplication is the engine's.

A stream's offset is the number of polls and the newest timestamp seen so far, from which the
next poll starts. What a poll delivered is kept in the folder ``spool`` until Spark has committed it, so a
batch that is repeated after a failure has the pages that it had, whatever the service says by then.
The folder has to outlive the driver; it may be in any file system that pyarrow opens by a URI. The times of the last requests are kept with a poll:
one limiter holds for all polls of a source, before and after a restart. The token is kept in the reader alone. Options
that begin with ``auth.`` are the fields of the login's form. Records that a service drops beyond its page cap between two polls
can't be had again; ``capped`` in the offset says that a poll ended at the cap.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

from ..functions.scalar import TIMESTAMP

PAGE_DDL = "poll LONG, page INT, body STRING, stop INT"
TOKEN_FIELDS = ("dmaToken", "token", "access_token")  # fixed values: accepted in this order
TOKEN_SECONDS = 12_600  # fixed value: how long a token is used


def instant(text: object) -> dt.datetime | None:
    """An ISO-8601 timestamp, in UTC where it has no offset; None if it is none. The forms are those of ``scalar.TIMESTAMP``."""
    plain = str(text).replace("Z", "+00:00")
    if not re.match(TIMESTAMP, plain):
        return None
    try:
        found = dt.datetime.fromisoformat(plain)
    except ValueError:
        return None
    return found if found.tzinfo else found.replace(tzinfo=dt.UTC)


class RateLimiter:
    """``limit`` requests per ``window`` seconds, sliding; waits instead of failing.

    No window of that length holds more requests, unlike with a counter that is reset. ``sent`` has the times of the last
    requests by the wall clock, so that they can be kept and a later process goes on from them.
    """

    def __init__(self, limit: int = 20, window: float = 60.0, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep, sent: Iterable[float] = ()):
        self.limit, self.window, self.clock, self.sleep = limit, window, clock, sleep
        self.sent: deque[float] = deque(sorted(min(t, clock()) for t in sent))

    def acquire(self) -> None:
        while True:
            now = self.clock()
            while self.sent and now - self.sent[0] >= self.window:
                self.sent.popleft()
            if len(self.sent) < self.limit:
                self.sent.append(now)
                return
            self.sleep(max(self.window - (now - self.sent[0]), 0.001))


def absolute(next_page: str | None, base: str, prefix: str) -> str | None:
    """The URL of the following page: see ``functions.scalar.next_url``, its column form."""
    if not next_page:
        return None
    if next_page.startswith("http"):
        return next_page
    if next_page.startswith("/"):
        parts = urllib.parse.urlsplit(base)
        return f"{parts.scheme}://{parts.netloc}{next_page if next_page.startswith(prefix) else prefix + next_page}"
    return f"{base}?nextPage={next_page}"


class Client:
    def __init__(self, options: dict[str, str], limiter: RateLimiter | None = None, sleep: Callable[[float], None] = time.sleep):
        self.url = options["url"]
        self.auth_url = options.get("authurl") or options.get("authUrl")
        self.credentials = {k: options[k] for k in ("user", "password") if k in options} | {k[5:]: v for k, v in options.items() if k.lower().startswith("auth.")}
        self.prefix = options.get("prefix", "/api")
        self.cap = int(options.get("maxpages") or options.get("maxPages") or 50)
        self.limiter = limiter or RateLimiter(int(options.get("requests", 20)), float(options.get("window", 60)))
        self.sleep = sleep
        self.token_seconds = float(options.get("tokenseconds") or options.get("tokenSeconds") or TOKEN_SECONDS)
        self.token: str | None = None
        self.token_until = 0.0

    def _login(self) -> str | None:
        if self.auth_url is None:
            return None
        self.limiter.acquire()  # a login is a request like any other
        body = urllib.parse.urlencode(self.credentials).encode()
        with urllib.request.urlopen(urllib.request.Request(self.auth_url, body, method="POST"), timeout=30) as r:
            given = json.load(r)
        token = next((given[k] for k in TOKEN_FIELDS if given.get(k)), None)
        if token is None:
            raise ValueError("the login response holds no token")
        return token

    def get(self, url: str) -> str:
        refreshed = waited = False
        while True:
            if self.token is None or self.limiter.clock() >= self.token_until:
                self.token, self.token_until = self._login(), self.limiter.clock() + self.token_seconds
            self.limiter.acquire()
            headers = {"Authorization": f"Bearer {self.token}"} if self.token else {}
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60) as r:
                    return r.read().decode()
            except urllib.error.HTTPError as e:
                if e.code == 401 and not refreshed:
                    refreshed, self.token = True, None
                elif e.code == 429 and not waited:
                    waited = True
                    self.sleep(float(e.headers.get("Retry-After") or 30))
                else:
                    raise

    def pages(self, since: str | None = None) -> Iterator[tuple[int, str, int | None]]:
        """(page number, body, stop) until there is no next page, the cap, or the first record older than ``since``.

        ``stop`` is the position of that record on its page, else None. Records whose timestamp doesn't parse stop
        nothing; nor does a page that isn't JSON, which is delivered as it is and ends the scan.
        """
        start = instant(since) if since else None
        url: str | None = self.url
        page = 0
        while url and page < self.cap:
            page += 1
            body = self.get(url)
            try:
                parsed = json.loads(body)
                records = parsed.get("alerts") or []
                times = [instant(r.get("alertTimestamp")) for r in records]
            except (ValueError, AttributeError):
                yield page, body, None
                return
            stop = next((i for i, t in enumerate(times) if start and t and t < start), None)
            yield page, body, stop
            url = None if stop is not None else absolute(parsed.get("nextPage"), self.url, self.prefix)


def polled(client: Client, start: dict) -> dict:
    """A poll: its pages, where the next one starts, and the times of the last requests."""
    pages = list(client.pages(start["since"]))
    since = newest([body for _, body, _ in pages])
    latest = max((t for t in (start["since"], since) if t), key=instant)
    capped = len(pages) == client.cap and pages[-1][2] is None
    return {"pages": pages, "end": {"poll": start["poll"] + 1, "since": latest, "capped": capped}, "sent": list(client.limiter.sent)}


class Spool:
    """What polls delivered, as files that are there as a whole or not at all."""

    def __init__(self, where: str):
        self.fs, self.path = fs.FileSystem.from_uri(where if "://" in where else os.path.abspath(where))

    def get(self, name: str) -> dict | None:
        try:
            with self.fs.open_input_stream(f"{self.path}/{name}.json") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def put(self, name: str, value: dict) -> None:
        final = f"{self.path}/{name}.json"
        self.fs.create_dir(final.rpartition("/")[0], recursive=True)
        part = f"{final}.{uuid.uuid4().hex}.part"
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps(value).encode())
        self.fs.move(part, final)

    def numbers(self, folder: str = "") -> list[int]:
        """Of the files ``poll-<number>``."""
        found = self.fs.get_file_info(fs.FileSelector(f"{self.path}/{folder}", allow_not_found=True))
        return sorted(int(m[1]) for f in found if (m := re.fullmatch(r"poll-(\d+)\.json", f.base_name)))

    def drop(self, name: str) -> None:
        self.fs.delete_file(f"{self.path}/{name}.json")


def newest(bodies: list[str]) -> str | None:
    """The newest timestamp of some pages, as it is written."""
    found = []
    for body in bodies:
        try:
            found += [r["alertTimestamp"] for r in json.loads(body).get("alerts") or [] if instant(r.get("alertTimestamp"))]
        except (ValueError, AttributeError):
            continue
    return max(found, key=instant, default=None)


class PagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # pages are a chain: the next one's address stands in the one before

    def read(self, partition: InputPartition) -> Iterator[tuple[int, int, str, int | None]]:
        for page in Client(dict(self.options)).pages(self.options.get("since")):
            yield (0, *page)


def first_since(options: dict[str, str]) -> str:
    days = float(options.get("lookbackDays") or options.get("lookbackdays") or 7)
    return options.get("since") or (dt.datetime.now(dt.UTC) - dt.timedelta(days=days)).isoformat()


class PagesStreamReader(SimpleDataSourceStreamReader):
    """Offsets are {poll, since, capped}. Options: ``spool`` (required), ``since`` or ``lookbackDays`` for the first poll."""

    def __init__(self, options: dict[str, str]):
        self.options = options
        if not options.get("spool"):
            raise ValueError("the stream needs the option spool, a folder that outlives the driver")
        self.spool = Spool(options["spool"])
        self.client: Client | None = None

    def initialOffset(self) -> dict:
        return {"poll": 0, "since": first_since(self.options), "capped": False}

    def _client(self, poll: int) -> Client:
        """One for all polls of this reader; after a restart it knows the requests of the poll before."""
        if self.client is None:
            before = self.spool.get(f"poll-{poll - 1}") or {}
            limiter = RateLimiter(int(self.options.get("requests", 20)), float(self.options.get("window", 60)), sent=before.get("sent", ()))
            self.client = Client(dict(self.options), limiter)
        return self.client

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        poll = start["poll"]
        kept = self.spool.get(f"poll-{poll}")
        if kept is None:
            kept = polled(self._client(poll), start)
            self.spool.put(f"poll-{poll}", kept)
        return iter([(poll, *page) for page in kept["pages"]]), kept["end"]

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for poll in range(start["poll"], end["poll"]):
            kept = self.spool.get(f"poll-{poll}")
            if kept is None:
                raise FileNotFoundError(f"poll {poll} is gone from {self.spool.path}, so it can't be repeated")
            for page in kept["pages"]:
                yield (poll, *page)

    def commit(self, end: dict) -> None:
        for poll in self.spool.numbers():
            if poll < end["poll"] - 1:  # the last one may be repeated yet
                self.spool.drop(f"poll-{poll}")


#: Of this worker process: (token, until) by login, so that a task needn't log in again.
_tokens: dict[tuple, tuple[str | None, float]] = {}


class FeedPartition(InputPartition):
    def __init__(self, number: int, feed: str, start: int, end: int):
        super().__init__((number, feed, start, end))
        self.number, self.feed, self.start, self.end = number, feed, start, end


class FeedsStreamReader(DataSourceStreamReader):
    """Several feeds, a task each. Offsets are {poll}; where a feed's poll starts stands with its poll before, in the spool.

    So the driver reads no page: a task looks up where its feed was, scans it, and puts what it found into the spool before
    it goes on; a task that is repeated finds it there. The limit of requests is shared out among the feeds, and
    each feed's goes on from poll to poll. Options: as for one feed, with ``feeds``, a list of URLs parted by white space, in the place of ``url``. The spool has to be
    shared by all executors.
    """

    def __init__(self, options: dict[str, str]):
        self.options, self.feeds = options, options.get("feeds", "").split()
        if not options.get("spool") or not self.feeds:
            raise ValueError("the stream needs the options feeds and spool")
        self.share = int(options.get("requests", 20)) // len(self.feeds)
        if self.share < 2:
            raise ValueError(f"{len(self.feeds)} feeds need two requests each in a window at least, a login and a page")
        self.since = first_since(options)

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        """One poll beyond the last that all feeds have in the spool."""
        spool = Spool(self.options["spool"])
        return {"poll": min(max(spool.numbers(f"feed-{i}"), default=-1) for i in range(len(self.feeds))) + 2}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [FeedPartition(i, feed, start["poll"], end["poll"]) for i, feed in enumerate(self.feeds)] if start["poll"] < end["poll"] else []

    def read(self, partition: FeedPartition) -> Iterator[tuple]:
        spool = Spool(self.options["spool"])
        for poll in range(partition.start, partition.end):
            name = f"feed-{partition.number}/poll-{poll}"
            kept = spool.get(name)
            if kept is None:
                before = spool.get(f"feed-{partition.number}/poll-{poll - 1}")
                if before is None and poll > 0:
                    raise FileNotFoundError(f"poll {poll - 1} of {partition.feed} is gone from {spool.path}, so the next one has no start")
                limiter = RateLimiter(self.share, float(self.options.get("window", 60)), sent=(before or {}).get("sent", ()))
                client = Client({**self.options, "url": partition.feed}, limiter)
                login = (client.auth_url, tuple(sorted(client.credentials.items())))
                client.token, client.token_until = _tokens.get(login, (None, 0.0))
                kept = polled(client, before["end"] if before else {"poll": 0, "since": self.since})
                _tokens[login] = client.token, client.token_until
                spool.put(name, kept)
            for page in kept["pages"]:
                yield (partition.feed, poll, *page)

    def commit(self, end: dict) -> None:
        spool = Spool(self.options["spool"])
        for i in range(len(self.feeds)):
            for poll in spool.numbers(f"feed-{i}"):
                if poll < end["poll"] - 1:  # the last one may be repeated yet, and the next one starts from it
                    spool.drop(f"feed-{i}/poll-{poll}")


class FeedPages(DataSource):
    """``spark.dataSource.register(FeedPages)``; ``spark.readStream.format("feed_pages").option("feeds", "..").load()``"""

    @classmethod
    def name(cls) -> str:
        return "feed_pages"

    def schema(self) -> str:
        return f"feed STRING, {PAGE_DDL}"

    def streamReader(self, schema) -> FeedsStreamReader:  # noqa: ANN001
        return FeedsStreamReader(dict(self.options))


class SignalPages(DataSource):
    """``spark.dataSource.register(SignalPages)``; ``spark.read.format("signal_pages").option("url", ..).load()``"""

    @classmethod
    def name(cls) -> str:
        return "signal_pages"

    def schema(self) -> str:
        return PAGE_DDL

    def reader(self, schema) -> PagesReader:  # noqa: ANN001
        return PagesReader(self.options)

    def simpleStreamReader(self, schema) -> PagesStreamReader:  # noqa: ANN001
        return PagesStreamReader(self.options)
