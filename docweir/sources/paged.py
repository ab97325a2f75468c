"""Spark data sources over paged listings, recorded as JSON files; a live one replaces the fetching alone."""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import parse_qs, urlsplit

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition


class _Listing(InputPartition):
    def __init__(self, name: str) -> None:
        super().__init__(name)
        self.name = name


class Recording:
    """A folder of listings, each a folder of JSON pages, in any file system that pyarrow opens by its URI."""

    def __init__(self, folder: str) -> None:
        self.system, self.root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")

    def names(self, *below: str, kind: fs.FileType = fs.FileType.File) -> list[str]:
        found = self.system.get_file_info(fs.FileSelector("/".join((self.root, *below))))
        return sorted(x.base_name for x in found if x.type == kind)

    def page(self, *path: str) -> dict:
        with self.system.open_input_stream("/".join((self.root, *path))) as file:
            return json.loads(file.read())


class PagedReader(DataSourceReader):
    """One partition a listing; its pages are followed, and their promises are checked as they come.

    A filter `updated >= x` and one on the listing are taken over, as a service's query would be.
    """

    def __init__(self, folder: str) -> None:
        self.folder, self.since, self.only = folder, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, GreaterThanOrEqual) and f.attribute == ("updated",):
                self.since = f.value
            elif isinstance(f, EqualTo) and f.attribute == ("listing",):
                self.only = f.value
            else:
                yield f

    def partitions(self) -> list[_Listing]:
        names = Recording(self.folder).names(kind=fs.FileType.Directory)
        return [_Listing(n) for n in names if self.only in (None, n)]

    def _pages(self, recording: Recording, listing: str) -> Iterator[tuple[list, int | None]]:
        """(items, total) of each page, by offset: in the order of the files' names."""
        for name in recording.names(listing):
            page = recording.page(listing, name)
            yield page["values"], page["total"]

    def _updated(self, item: dict) -> str | None:
        return item.get("updated")

    def read(self, partition: _Listing) -> Iterator[tuple]:
        seen: set[str] = set()
        total = None
        for items, now in self._pages(Recording(self.folder), partition.name):
            if total is not None and now != total:
                raise ValueError(f"{partition.name}: the total changed between pages")
            total = now
            for item in items:
                if item["id"] in seen:
                    raise ValueError(f"{partition.name}: {item['id']} came twice")
                seen.add(item["id"])
                updated = self._updated(item)
                if self.since is None or (updated or "") >= self.since:
                    yield partition.name, item["id"], updated, json.dumps(item, sort_keys=True)
        if total is not None and len(seen) != total:
            raise ValueError(f"{partition.name}: {len(seen)} of {total} items came")


class CursorReader(PagedReader):
    """Pages that name the next one: the first is first.json, and what a next link's cursor names is cursor.json."""

    def _pages(self, recording: Recording, listing: str) -> Iterator[tuple[list, int | None]]:
        name, met = "first", set()
        while name:
            if name in met:
                raise ValueError(f"{listing}: cursor {name} came twice")
            met.add(name)
            page = recording.page(listing, f"{name}.json")
            items = page.get("results") if isinstance(page, dict) else None
            if not isinstance(items, list):
                raise ValueError(f"{listing}: page {name} isn't one")
            yield [x for x in items if isinstance(x, dict)], None
            link = (page.get("_links") or {}).get("next") or ""
            name = parse_qs(urlsplit(link).query).get("cursor", [""])[0]

    def _updated(self, item: dict) -> str | None:
        version = item.get("version") if isinstance(item.get("version"), dict) else {}
        return version.get("createdAt") or version.get("when") or item.get("createdAt")


class PagedSource(DataSource):
    """spark.read.format("paged").option("path", folder): listing, id, updated, and the item as JSON.

    The option paging is offset, or cursor for listings whose pages name the next one.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "listing string, id string, updated string, item string"

    def reader(self, schema) -> PagedReader:
        return (CursorReader if self.options.get("paging") == "cursor" else PagedReader)(self.options["path"])


def register(spark) -> None:
    """Makes the source known to a session, and lets it take over filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
