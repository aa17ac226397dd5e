"""A paged JSON service as a Spark data source, in batches and as a stream.

Pages of one address follow one another by their ``next`` links, so an address is
a partition; asked for several courts, or for a range of years, it is one for
each.  What WHERE says of court and dates becomes parameters of the service.  A
page that fails is asked for again after a growing wait, and then fails the task,
which Spark runs again; nothing is cut short in silence.
"""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Iterable, Iterator
from typing import Any
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode, urljoin
from urllib.request import Request, urlopen

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

# Options of the source, and the service's parameters they become; columns that it filters, by equality or by range.
PARAMETERS = {"court": "court", "jurisdiction": "court__jurisdiction", "filed_from": "date_filed__gte", "filed_to": "date_filed__lte", "modified_from": "date_modified__gte", "order_by": "order_by"}
RANGES = {"date_filed": ("date_filed__gte", "date_filed__lte"), "date_modified": ("date_modified__gte", "date_modified__lte")}
#: Longest wait between tries in seconds, and by how much a wait grows after too many requests.
LONGEST_WAIT, TOO_MANY = 300.0, 3.0

ROW = T.StructType([T.StructField("start", T.StringType()), T.StructField("position", T.IntegerType()), T.StructField("record", T.StringType())])


class _Start(InputPartition):
    def __init__(self, url: str, after: tuple[str, int] | None = None, to: tuple[str, int] | None = None) -> None:
        self.url, self.after, self.to = url, after, to


def wait_before(tries: int, base: float, status: int | None = None) -> float:
    """Seconds to wait after so many failed tries: doubling from ``base``, and three times that after too many requests, within a bound."""
    return min(LONGEST_WAIT, base * 2 ** min(tries - 1, 60) * (TOO_MANY if status == 429 else 1))


def _value(v: Any, kind: T.DataType) -> Any:
    """A JSON value as one of a column; null where it can't be."""
    if v is None:
        return None
    try:
        if isinstance(kind, T.StringType):
            return v if isinstance(v, str) else json.dumps(v)
        if isinstance(kind, T.DateType):
            return datetime.date.fromisoformat(v[:10])
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            when = datetime.datetime.fromisoformat(v)
            if isinstance(kind, T.TimestampNTZType):
                return when.replace(tzinfo=None)
            return when if when.tzinfo else when.replace(tzinfo=datetime.timezone.utc)
        if isinstance(kind, T.BooleanType):
            return v if isinstance(v, bool) else None
        if isinstance(kind, T.IntegralType):
            return int(v)
        if isinstance(kind, T.FractionalType):
            return float(v)
    except (TypeError, ValueError):
        return None
    return v


class _Service:
    """What batches and streams share: addresses, pages with their tries, and rows."""

    def __init__(self, options: dict[str, str], schema: T.StructType | None = None) -> None:
        self.urls = [u for u in options["urls"].split() if u]
        self.asked = {name: options[o] for o, name in PARAMETERS.items() if options.get(o)}
        self.page_size = int(options.get("page_size", "0"))
        self.most_pages = int(options.get("max_pages", "0"))
        self.limit = int(options.get("limit", "0"))
        self.wait = float(options.get("seconds_between", "0"))
        self.tries = int(options.get("tries", "3"))
        self.base = float(options.get("seconds_before_retry", "2"))
        self.agent = options.get("user_agent", "caselake")
        self.by_year = options.get("by_year", "").lower() == "true"
        self.fields = None if schema is None or schema == ROW else list(schema.fields)

    def address(self, url: str, **more: str) -> str:
        asked = urlencode(self.asked | more)
        return url + ("&" if "?" in url else "?") * bool(asked) + asked

    def page(self, url: str) -> dict:
        for n in range(1, self.tries + 1):
            try:
                with urlopen(Request(url, headers={"User-Agent": self.agent}), timeout=60) as answer:
                    return json.load(answer)
            except HTTPError as e:
                if n == self.tries or not (e.code == 429 or e.code >= 500):
                    raise
                time.sleep(wait_before(n, self.base, e.code))
            except (URLError, TimeoutError, ConnectionError):
                if n == self.tries:
                    raise
                time.sleep(wait_before(n, self.base))
        raise ValueError("tries must be at least 1")

    def records(self, url: str) -> Iterator[dict]:
        seen: set[str] = set()
        while url and url not in seen and not (self.most_pages and len(seen) >= self.most_pages):
            seen.add(url)
            page = self.page(url)
            yield from page.get("results", [])
            whole = self.page_size and page.get("count") and len(seen) * self.page_size >= int(page["count"])
            url = urljoin(url, page["next"]) if page.get("next") and not whole else ""
            time.sleep(self.wait if url else 0)

    def row(self, start: str, n: int, record: dict) -> tuple:
        if self.fields is None:
            return start, n, json.dumps(record)
        return tuple(_value(record.get(f.name), f.dataType) for f in self.fields)


class PagedReader(_Service, DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType | None = None) -> None:
        super().__init__(options, schema)
        self.courts = [self.asked.pop("court")] if "court" in self.asked else None

    @property
    def starts(self) -> list[str]:
        courts = [{}] if self.courts is None else [{"court": c} for c in self.courts]
        return [self.address(u, **court, **years) for u in self.urls for court in courts for years in self._years()]

    def _years(self) -> list[dict[str, str]]:
        """The range of dates, as it is or by years."""
        low, high = (self.asked.get(p, "") for p in RANGES["date_filed"])
        if low and high and low > high:
            return []
        if not (self.by_year and low and high):
            return [{}]
        first, last = int(low[:4]), int(high[:4])
        return [dict(zip(RANGES["date_filed"], (max(low, f"{y:04d}-01-01"), min(high, f"{y:04d}-12-31")))) for y in range(first, last + 1)]

    def partitions(self) -> list[InputPartition]:
        return [_Start(u) for u in self.starts]

    def read(self, partition: _Start) -> Iterator[tuple]:
        if partition is None:  # no court or year is left
            return
        for n, record in enumerate(self.records(partition.url)):
            if self.limit and n >= self.limit:
                return
            yield self.row(partition.url, n, record)


class FilteringReader(PagedReader):
    """A reader of typed columns, to which conditions are handed on."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes what the service can tell; what it can't, or only nearly, goes back to Spark."""
        for f in filters:
            if not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        column = ".".join(getattr(f, "attribute", ()))
        if column == "court" and isinstance(f, (EqualTo, In)):
            told = [str(v) for v in (f.value if isinstance(f, In) else (f.value,)) if v is not None]
            self.courts = [c for c in dict.fromkeys(told) if self.courts is None or c in self.courts]
            return True
        if column not in RANGES or not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) or not isinstance(f.value, datetime.date):
            return False
        # a day is told exactly; of a moment the days around it, whatever the zone
        exact = not isinstance(f.value, datetime.datetime)
        day = datetime.timedelta(days=0 if exact else 1)
        low, high = RANGES[column]
        if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            self.asked[low] = max(self.asked.get(low, ""), (f.value - day).isoformat()[:10])
        if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
            self.asked[high] = min(self.asked.get(high, "9999-12-31"), (f.value + day).isoformat()[:10])
        return exact and column == "date_filed" and not isinstance(f, (GreaterThan, LessThan))


class PagedStream(_Service, DataSourceStreamReader):
    """New and changed records in the order of (date_modified, id).

    An offset is the last such pair.  A batch asks for all from the first pair's
    time on, so records of that very time whose id is larger are not lost, and
    leaves out what an earlier batch had.  A record that changes again after its
    batch was planned comes with its new time in a later one.
    """

    def initialOffset(self) -> dict:
        return {"modified": self.asked.get("date_modified__gte", ""), "id": -1}

    def latestOffset(self) -> dict:
        asked = self.asked | {"order_by": "-date_modified,-id"}
        newest = [r for u in self.urls if (r := self.page(self.address(u, **asked)).get("results"))]
        last = max(((r[0]["date_modified"], int(r[0]["id"])) for r in newest), default=None)
        return self.initialOffset() if last is None else {"modified": last[0], "id": last[1]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        after, to = ((o["modified"], o["id"]) for o in (start, end))
        if after >= to:
            return []
        low, high = RANGES["date_modified"]
        asked = {"order_by": "date_modified,id", high: to[0]} | ({low: after[0]} if after[0] else {})
        return [_Start(self.address(u, **asked), after, to) for u in self.urls]

    def read(self, partition: _Start) -> Iterator[tuple]:
        seen: set[tuple[str, int]] = set()  # a page may repeat the last of the one before
        for n, record in enumerate(self.records(partition.url)):
            key = (record["date_modified"], int(record["id"]))
            if partition.after < key <= partition.to and key not in seen:
                seen = {key}
                yield self.row(partition.url, n, record)

    def commit(self, end: dict) -> None:
        """Nothing is kept here: the checkpoint has the offset."""


class PagedSource(DataSource):
    """``spark.read.format("paged_json").option("urls", "...").load()``: start, position and record (JSON).

    With ``.schema("id bigint, court string, date_filed date, ...")`` fields of the
    records become columns, null where they can't be, and conditions on court,
    date_filed and date_modified are sent along; this needs
    ``spark.sql.python.filterPushdown.enabled``, which ``register`` sets.
    ``readStream`` gives new and changed records by (date_modified, id).

    Options: urls (start addresses, by blanks), limit (rows of each), max_pages,
    page_size (reading ends when so many rows a page reach the answer's count),
    by_year (a partition for each year of a range of date_filed),
    tries and seconds_before_retry (waits double, and triple after 429, up to 300
    seconds), seconds_between, user_agent, and those of ``PARAMETERS``, which are
    sent along.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> T.StructType:
        return ROW

    def reader(self, schema: T.StructType) -> DataSourceReader:
        # a reader that takes filters needs the session's leave, so one that has none to take goes without
        return PagedReader(self.options) if schema == ROW else FilteringReader(self.options, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PagedStream(self.options, schema)
