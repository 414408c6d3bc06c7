"""The paged feed as a data source: one row per page, opened only if the query can need it.

A feed covers a span of start dates (a year, or a day), and its pages are numbered by the offset of their first
record. ``format("award_feed")`` has one row per page, ``SCHEMA``: the page's body as text (parsed later by the
engine's JSON functions), how many attempts it took, and for a page that could not be had the kind of ``failure``.

*Pushdown.* Comparisons of ``feed``, ``from_date``, ``to_date`` and ``offset`` with literals are pushed: feeds and offsets
that they rule out are never listed, planned or opened. ``between_dates`` turns a range of dates into such comparisons.

*Partitions.* A task has at most ``pagesPerTask`` pages of one feed, so a feed with a third of all pages is as many tasks as
it needs. Offsets missing from the grid become rows with failure ``missing`` without being asked for.

*Retries.* A page is asked for up to ``attempts`` times with growing pauses; then its row says why it failed
(``missing``, ``unreadable``), and the others go on. A lost task reads its pages again: rows do not depend on attempts
of other tasks.

A ``Transport`` says which feeds and offsets exist and fetches one page; ``FolderTransport`` reads page files
``<root>/feed=<feed>/<offset>.json`` on any file system that pyarrow opens. ``write`` makes such files, one per row; it
is safe to repeat.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from riskmart.session import ship_package
from riskmart.sources import schemas
from riskmart.sources.readers import page_columns

FORMAT = "award_feed"
SCHEMA = "feed string, from_date date, to_date date, offset bigint, attempts int, failure string, body string"
ROWS_PER_PAGE = 25
ATTEMPTS = 3
PAGES_PER_TASK = 64
MISSING, UNREADABLE = "missing", "unreadable"


def span(feed: str) -> tuple[date, date]:
    """First and last start date of a feed: ``2024`` is a year, ``2024-05-01`` a day."""
    if len(feed) == 4:
        return date(int(feed), 1, 1), date(int(feed), 12, 31)
    day = date.fromisoformat(feed)
    return day, day


class Transport:
    """Where pages come from."""

    def feeds(self) -> list[str]:
        raise NotImplementedError

    def offsets(self, feed: str) -> list[int]:
        raise NotImplementedError

    def fetch(self, feed: str, offset: int) -> str:
        raise NotImplementedError


class FolderTransport(Transport):
    """Page files below ``feed=...`` folders."""

    def __init__(self, root: str):
        self.root = root

    def _at(self, *parts: str):
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(self.root)
        return files, "/".join([path, *parts])

    def _names(self, *parts: str) -> list[str]:
        from pyarrow import fs

        files, path = self._at(*parts)
        return [f.base_name for f in files.get_file_info(fs.FileSelector(path, allow_not_found=True))]

    def feeds(self) -> list[str]:
        return [n.removeprefix("feed=") for n in self._names() if n.startswith("feed=")]

    def offsets(self, feed: str) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names(f"feed={feed}") if n.removesuffix(".json").isdecimal()]

    def fetch(self, feed: str, offset: int) -> str:
        files, path = self._at(f"feed={feed}", f"{offset}.json")
        with files.open_input_stream(path) as page:
            return page.read().decode()

    def store(self, feed: str, offset: int, body: str) -> None:
        files, folder = self._at(f"feed={feed}")
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{offset}.json") as page:
            page.write(body.encode())


_TESTS = {
    EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
    GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
}


@dataclass
class Pages(InputPartition):
    """Some pages of one feed; ``absent`` ones are known not to exist."""

    feed: str
    offsets: tuple[int, ...]
    absent: frozenset[int]


class FeedReader(DataSourceReader):
    def __init__(self, transport: Transport, rows_per_page: int, attempts: int, pages_per_task: int, pause: float):
        self._transport, self._rpp, self._attempts = transport, rows_per_page, attempts
        self._per_task, self._pause = pages_per_task, pause
        self._pushed: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in _TESTS and name in ("feed", "from_date", "to_date", "offset"):
                self._pushed.append((name, type(f), f.value))  # decided in full here: not checked again
            else:
                yield f

    def _may(self, **values) -> bool:
        return all(_TESTS[kind](values[name], value) for name, kind, value in self._pushed if name in values)

    def partitions(self) -> list[Pages]:
        found = []
        for feed in sorted(self._transport.feeds()):
            first, last = span(feed)
            if not self._may(feed=feed, from_date=first, to_date=last):
                continue
            there = set(self._transport.offsets(feed))
            grid = set(range(0, max(there, default=-1) + 1, self._rpp))
            wanted = [o for o in sorted(there | grid) if self._may(offset=o)]
            for i in range(0, len(wanted), self._per_task):
                some = wanted[i:i + self._per_task]
                found.append(Pages(feed, tuple(some), frozenset(some) - there))
        return found or [Pages("", (), frozenset())]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for offset in partition.offsets:
            body, failure, tried = None, MISSING, 0
            if offset not in partition.absent:
                body, failure, tried = self._fetch(partition.feed, offset)
            yield (partition.feed, *span(partition.feed), offset, tried, failure, body)

    def _fetch(self, feed: str, offset: int) -> tuple[str | None, str | None, int]:
        failure = None
        for attempt in range(1, self._attempts + 1):
            try:
                return self._transport.fetch(feed, offset), None, attempt
            except FileNotFoundError:
                failure = MISSING
            except (OSError, ValueError):
                failure = UNREADABLE
            if attempt < self._attempts:
                time.sleep(self._pause * attempt)
        return None, failure, self._attempts


class FeedWriter(DataSourceWriter):
    def __init__(self, transport: FolderTransport):
        self._transport = transport

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        for row in iterator:
            self._transport.store(row["feed"], row["offset"], row["body"])
        return WriterCommitMessage()


class AwardFeed(DataSource):
    """Options: ``path`` (root of the page files), ``rowsPerPage``, ``attempts``, ``pagesPerTask``, ``pause`` (seconds)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def transport(self) -> Transport:
        return FolderTransport(self.options["path"])

    def reader(self, schema: StructType) -> DataSourceReader:
        o = self.options
        return FeedReader(
            self.transport(), int(o.get("rowsPerPage", ROWS_PER_PAGE)), int(o.get("attempts", ATTEMPTS)),
            int(o.get("pagesPerTask", PAGES_PER_TASK)), float(o.get("pause", 2.0)),
        )

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return FeedWriter(self.transport())


def register(spark: SparkSession, source: type[DataSource] = AwardFeed) -> SparkSession:
    """Make the source known to a session, and the package to its Python workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    return spark


def read_feed(spark: SparkSession, root: str, **options) -> DataFrame:
    """Pages of the feeds below ``root``."""
    reader = register(spark).read.format(FORMAT)
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load(root)


def write_feed(pages: DataFrame, root: str) -> None:
    """(feed, offset, body) rows as page files; a page that is there is replaced."""
    register(pages.sparkSession)
    pages.select("feed", "offset", "body").write.format(FORMAT).mode("append").save(root)


def between_dates(first: date, last: date) -> Column:
    """Pages of the feeds that hold start dates from ``first`` to ``last``."""
    return (F.col("to_date") >= F.lit(first)) & (F.col("from_date") <= F.lit(last))


def parsed(pages: DataFrame) -> DataFrame:
    """``response``, ``year`` (the feed), ``offset``, ``n_rows`` and ``failed``, as page files read in bulk have them."""
    read = pages.select(F.col("feed").alias("year"), "offset", "failure", F.from_json("body", schemas.ENVELOPE).alias("e"))
    return page_columns(read.select("year", "offset", "failure", "e.*"), F.col("failure").isNotNull())
