"""A paged JSON API as a Spark data source.

Pages are fetched by the tasks, each one a range of page numbers (or keys), so
no page passes through the driver. The number of pages is found by asking for
page 1, 2, 4, 8, ... until one is empty and halving the last step. It works
over any URL that Python can open, ``file:`` included.
"""

from __future__ import annotations

import json
import logging
import re
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "paged_json"

log = logging.getLogger(__name__)

# Asking for a page beyond this number means that the source never ends.
MAX_PAGES = 1 << 32


class PageMissing(OSError):
    """The server or file system has no such page."""


def fetch(
    url: str, headers: dict[str, str] | None = None, records_path: str = ""
) -> tuple[Iterable[dict], str]:
    """Records of a page, parsed as they are asked for, and its ``Link`` header."""
    request = urllib.request.Request(url, headers=headers or {})
    try:
        with urllib.request.urlopen(request, timeout=60) as response:
            text = response.read().decode("utf-8")
            link = response.headers.get("Link") or ""
    except urllib.error.HTTPError as error:
        if error.code == 404:
            raise PageMissing(url) from error
        raise
    except urllib.error.URLError as error:
        if isinstance(error.reason, FileNotFoundError):
            raise PageMissing(url) from error
        raise
    return records_of(text, records_path), link


def records_of(text: str, records_path: str = "") -> Iterator[dict]:
    """Records of a JSON array, a single JSON object, or one object per line (parsed line by line).

    ``records_path`` (``data.items``) names the array inside an object.
    """
    try:
        body = json.loads(text or "[]")
    except json.JSONDecodeError:
        body = (json.loads(line[0]) for line in re.finditer(r"[^\r\n]+", text) if line[0].strip())
    for step in records_path.split(".") if records_path else ():
        if not isinstance(body, dict) or step not in body:
            raise ValueError(f"a page has no '{records_path}'")
        body = body[step]
    for record in body if isinstance(body, (list, Iterator)) else [body]:
        if not isinstance(record, dict):
            raise ValueError("a page holds values that are not JSON objects")
        yield record


def link_target(link: str, relation: str) -> str | None:
    """The URL a ``Link`` header gives for a relation (``next``, ``last``)."""
    found = re.search(rf'<([^>]*)>\s*;[^,]*rel="?{relation}"?', link)
    return found.group(1) if found else None


def last_page(has_rows, base: int) -> int:
    """Number of the last page with rows (``base - 1`` if there is none).

    Pages are taken to be filled up to some number and empty after it.
    """
    step = 1
    while has_rows(base + step - 1):
        step *= 2
        if step > MAX_PAGES:
            raise ValueError(f"page {base + step // 2 - 1} still has rows: do the pages depend on their number?")
    low, high = base + step // 2 - 1, base + step - 1  # low has rows, high has none
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if has_rows(middle) else (low, middle)
    return low


class UrlRange(InputPartition):
    """URLs one task reads; with ``follow`` it goes on along the next links."""

    def __init__(self, urls: list[str], follow: bool = False):
        super().__init__(None)
        self.urls = urls
        self.follow = follow


class PagedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.url = options["url"]
        self.mode = options.get("mode", "number")
        self.base_page = int(options.get("base_page", "1"))
        self.pages_per_task = int(options.get("pages_per_task", "16"))
        self.keys = json.loads(options.get("keys", "[]"))
        self.headers = json.loads(options.get("headers", "{}"))
        self.records_path = options.get("records_path", "")
        self.skip_missing = options.get("on_missing", "fail") == "skip"

    def _ranges(self, urls: list[str]) -> list[UrlRange]:
        size = self.pages_per_task
        return [UrlRange(urls[i : i + size]) for i in range(0, len(urls), size)] or [UrlRange([])]

    def partitions(self) -> Sequence[InputPartition]:
        if self.mode == "keys":
            quoted = [urllib.parse.quote(str(k), safe="") for k in self.keys]
            return self._ranges([self.url.replace("{key}", k) for k in quoted])
        if self.mode == "link":
            _, link = fetch(self.url, self.headers, self.records_path)
            last = link_target(link, "last")
            found = re.search(r"([?&]page=)(\d+)", last) if last else None
            if not found:
                # The next page is known only from the one before it.
                return [UrlRange([self.url], follow=True)]
            head, tail = last[: found.start(2)], last[found.end(2) :]
            pages = range(self.base_page, int(found.group(2)) + 1)
            return self._ranges([f"{head}{n}{tail}" for n in pages])

        def page(n: int) -> str:
            return self.url.replace("{page}", str(n))

        def has_rows(n: int) -> bool:
            try:
                return any(self._known(record) for record in self._records(page(n))[0])
            except PageMissing:
                return False  # a page after the last one may be missing as well as empty

        last = last_page(has_rows, self.base_page)
        return self._ranges([page(n) for n in range(self.base_page, last + 1)])

    def _known(self, record: dict) -> bool:
        return any(name in record for name in self.schema.names)

    def _records(self, url: str) -> tuple[Iterator[dict], str]:
        records, link = fetch(url, self.headers, self.records_path)
        return self._checked(url, records), link

    def _checked(self, url: str, records: Iterable[dict]) -> Iterator[dict]:
        some = known = False
        for record in records:
            some, known = True, known or self._known(record)
            yield record
        if some and not known:
            raise ValueError(f"no record of {url} has a column of the schema: set records_path?")

    def read(self, partition: UrlRange) -> Iterator[tuple]:
        names = self.schema.names
        for url in partition.urls:
            following: str | None = url
            while following:
                try:
                    records, link = self._records(following)
                except PageMissing:
                    if not self.skip_missing:
                        raise
                    log.warning("skipped the missing page %s", following)
                    break
                for record in records:
                    yield tuple(record.get(name) for name in names)
                following = link_target(link, "next") if partition.follow else None


class PagedStreamReader(DataSourceStreamReader):
    """Numbered pages as a stream: the offset is the last page that has been read."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        if options.get("mode", "number") != "number":
            raise ValueError("only numbered pages can be read as a stream")
        self.pages = PagedReader(schema, options)
        self.page_size = int(options.get("page_size", "0"))

    def initialOffset(self) -> dict:
        return {"page": self.pages.base_page - 1}

    def latestOffset(self) -> dict:
        def is_full(n: int) -> bool:
            try:
                records, _ = self.pages._records(self.pages.url.replace("{page}", str(n)))
                return sum(1 for _ in records) >= max(1, self.page_size)
            except PageMissing:
                return False

        return {"page": last_page(is_full, self.pages.base_page)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        numbers = range(start["page"] + 1, end["page"] + 1)
        return self.pages._ranges([self.pages.url.replace("{page}", str(n)) for n in numbers])

    def read(self, partition: UrlRange) -> Iterator[tuple]:
        return self.pages.read(partition)


class PagedJsonSource(DataSource):
    """``format("paged_json")``: options url, mode (number, link, keys), headers, ..."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> PagedStreamReader:
        return PagedStreamReader(schema, self.options)


def read_paged(
    spark: SparkSession,
    url: str,
    schema: T.StructType | str,
    mode: str = "number",
    base_page: int = 1,
    keys: Sequence[str] = (),
    headers: dict[str, str] | None = None,
    pages_per_task: int = 16,
    records_path: str = "",
    on_missing: str = "fail",
) -> DataFrame:
    """Records of a paged API.

    A page or key that is not there fails the read; with ``on_missing='skip'`` it is
    logged by its task. In mode ``number`` a missing page ends the search for the
    last one. ``records_path`` names the array of records inside each body. A record without any
    column of the schema on a whole page is an error. Every executor must be able to open the URLs.
    Without a ``last`` link, mode ``link`` reads all pages in one task.

    ``url`` holds ``{page}`` (mode ``number``: pages until an empty one) or
    ``{key}`` (mode ``keys``: one call per key); mode ``link`` follows the
    ``Link`` header, in parallel where it names the last page.
    """
    spark.dataSource.register(PagedJsonSource)
    options = {
        "url": url,
        "mode": mode,
        "base_page": str(base_page),
        "keys": json.dumps(list(keys)),
        "headers": json.dumps(headers or {}),
        "pages_per_task": str(pages_per_task),
        "records_path": records_path,
        "on_missing": on_missing,
    }
    return spark.read.format(FORMAT).schema(schema).options(**options).load()


def stream_paged(
    spark: SparkSession,
    url: str,
    schema: T.StructType | str,
    base_page: int = 1,
    page_size: int = 0,
    headers: dict[str, str] | None = None,
    pages_per_task: int = 16,
    records_path: str = "",
) -> DataFrame:
    """Records of a paged API as a stream: a run fetches the pages added since the one before.

    The checkpoint of the query keeps the last page read, so a restart asks for no earlier one (but
    for a few, to find the last page). Pages must not change once they have been read: give
    ``page_size`` where the last page of the API is still being filled, it is then left until it has so
    many records. ``url`` holds ``{page}``.
    """
    spark.dataSource.register(PagedJsonSource)
    options = {
        "url": url,
        "base_page": str(base_page),
        "page_size": str(page_size),
        "headers": json.dumps(headers or {}),
        "pages_per_task": str(pages_per_task),
        "records_path": records_path,
    }
    return spark.readStream.format(FORMAT).schema(schema).options(**options).load()
