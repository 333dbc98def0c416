"""Paged services as a data source: tables and streams of (keyword, page, body)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

SCHEMA = "keyword string, page int, body string"


class Pages(InputPartition):
    """Pages ``first`` to ``last`` of one keyword."""

    def __init__(self, keyword: str, first: int, last: int):
        super().__init__(None)
        self.keyword, self.first, self.last = keyword, first, last


def _read(fetch: Callable[[str, int], str | None], part: Pages) -> Iterator[tuple[str, int, str]]:
    """A row for each page, until the service has no more of the keyword."""
    for page in range(part.first, part.last + 1):
        body = fetch(part.keyword, page)
        if body is None:
            return
        yield part.keyword, page, body


def _split(keywords: list[str], first: int, last: int, step: int) -> list[Pages]:
    return [Pages(k, p, min(p + step - 1, last)) for k in keywords for p in range(first, last + 1, step)]


class _Reader(DataSourceReader):
    def __init__(self, fetch, keywords: list[str], pages: int, step: int):
        self.fetch, self.keywords, self.pages, self.step = fetch, keywords, pages, step

    def partitions(self) -> list[Pages]:
        return _split(self.keywords, 1, self.pages, self.step) or [Pages("", 1, 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        return _read(self.fetch, partition)


class _PushingReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keywords that are asked for leave the others' pages unfetched."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("keyword",):
                self.keywords = [k for k in self.keywords if k == f.value]
            elif isinstance(f, In) and f.attribute == ("keyword",):
                self.keywords = [k for k in self.keywords if k in f.value]
            else:
                yield f


class _StreamReader(DataSourceStreamReader):
    """Offsets are numbers of pages: a batch reads the pages that the service has got since the last one."""

    def __init__(self, fetch, keywords: list[str], pages: Callable[[], int], step: int):
        self.fetch, self.keywords, self.pages, self.step = fetch, keywords, pages, step

    def initialOffset(self) -> dict:
        return {"pages": 0}

    def latestOffset(self) -> dict:
        return {"pages": self.pages()}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return _split(self.keywords, start["pages"] + 1, end["pages"], self.step)

    def read(self, partition: Pages) -> Iterator[tuple]:
        return _read(self.fetch, partition)

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession, name: str, fetch: Callable[[str, int], str | None], available: Callable[[], int] | None = None) -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read a service.

    ``fetch(keyword, page)`` gives a page's body, or None behind the last one; it
    runs in tasks. Options: ``keywords`` (a JSON list), ``pages`` (the most for a
    keyword, 1) and ``pagesPerTask`` (1). A table has a partition for each
    keyword and range of pages, and reads only keywords that a filter names, if
    ``spark.sql.python.filterPushdown.enabled`` is on when this is called. A stream reads up
    to ``available()`` pages of each keyword, or ``pages`` if it isn't given, and
    goes on from its checkpoint with those that have come since.
    """

    reader = _PushingReader if spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true" else _Reader

    class Service(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def _of(self) -> tuple[list[str], int, int]:
            return json.loads(self.options.get("keywords", "[]")), int(self.options.get("pages", 1)), int(self.options.get("pagesPerTask", 1))

        def reader(self, schema) -> DataSourceReader:
            return reader(fetch, *self._of())

        def streamReader(self, schema) -> DataSourceStreamReader:
            keywords, pages, step = self._of()
            return _StreamReader(fetch, keywords, available or (lambda: pages), step)

    spark.dataSource.register(Service)
