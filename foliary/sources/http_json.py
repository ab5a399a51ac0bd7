"""JSON over HTTP with retries, and paged interfaces as a Spark data source: one partition per page.

The transport is a parameter, so that tests and other transports need no network."""

from __future__ import annotations

import http.client
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from email.utils import parsedate_to_datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Open = Callable[[str, float], bytes]


def open_url(url: str, timeout: float) -> bytes:
    request = urllib.request.Request(url, headers={"Accept": "application/json", "User-Agent": "foliary"})
    with urllib.request.urlopen(request, timeout=timeout) as response:
        return response.read()


def build_url(url: str, params: dict | None) -> str:
    return f"{url}?{urllib.parse.urlencode(params)}" if params else url


def request_json(url: str, params: dict | None = None, attempts: int = 5, timeout: float = 90, opener: Open = open_url, sleep: Callable[[float], None] = time.sleep):
    """Parsed answer; connection and time-out errors, truncated answers and bad JSON are tried again after 1, 2, 4, ... (at most 30) seconds."""
    full, last = build_url(url, params), None
    for n in range(attempts):
        try:
            return json.loads(opener(full, timeout))
        except (urllib.error.URLError, http.client.HTTPException, TimeoutError, OSError, ValueError) as error:
            last = error
            if n + 1 < attempts:
                sleep(min(2**n, 30))
    raise RuntimeError(f"{full}: {last}") from last


def retry_after(value: str | None, now: float, fallback: float) -> float:
    """Seconds to wait by a Retry-After header: a number or an HTTP date."""
    if value is None:
        return fallback
    try:
        return max(0.0, float(value))
    except ValueError:
        try:
            return max(0.0, parsedate_to_datetime(value).timestamp() - now)
        except (TypeError, ValueError):
            return fallback


def download(url: str, attempts: int = 5, timeout: float = 90, opener: Open = open_url, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """Bytes of a URL; 429 waits as told, other 4xx end at once, all else is tried again."""
    last: Exception | None = None
    for n in range(attempts):
        try:
            return opener(url, timeout)
        except urllib.error.HTTPError as error:
            last = error
            if error.code == 429:
                sleep(retry_after(error.headers.get("Retry-After") if error.headers else None, time.time(), min(2**n, 30)))
                continue
            if 400 <= error.code < 500:
                break
        except (http.client.HTTPException, OSError) as error:
            last = error
        sleep(min(2**n, 30))
    raise RuntimeError(f"{url}: {last}") from last


def check_page(page: dict, number: int, size: int, total: int | None, total_pages: int | None) -> tuple[int, int]:
    """A page's ``page`` object must have the number and size asked for and totals that don't change."""
    if not 1 <= size <= 100:
        raise ValueError("page size must be 1 to 100")
    info = page.get("page") or {}
    if info.get("number") != number or info.get("size") != size:
        raise RuntimeError(f"page {number}: answered as {info.get('number')} of size {info.get('size')}")
    found = info.get("totalElements"), info.get("totalPages")
    if not all(isinstance(x, int) and x >= 0 for x in found):
        raise RuntimeError(f"page {number}: no totals")
    if total is not None and found != (total, total_pages):
        raise RuntimeError(f"page {number}: totals changed from {(total, total_pages)} to {found}")
    return found


class _Page(InputPartition):
    def __init__(self, number: int, total: int | None, pages: int | None) -> None:
        self.number, self.total, self.pages = number, total, pages


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict, opener: Open) -> None:
        self.url, self.size, self.opener = options["url"], int(options.get("pagesize", 100)), opener
        self.first, self.limit = int(options.get("startpage", 0)), int(options.get("pages", 0))

    def _fetch(self, number: int) -> dict:
        return request_json(self.url, {"page": number, "size": self.size}, opener=self.opener)

    def partitions(self) -> list[InputPartition]:
        total, pages = check_page(self._fetch(self.first), self.first, self.size, None, None)
        last = min(pages, self.first + self.limit) if self.limit else pages
        return [_Page(n, total, pages) for n in range(self.first, last)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        page = self._fetch(partition.number)
        check_page(page, partition.number, self.size, partition.total, partition.pages)
        items = page.get("items")
        if items is None:
            items = ((page.get("_embedded") or {}).get("searchResult", {}).get("_embedded") or {}).get("objects", [])
        expected = min(self.size, partition.total - partition.number * self.size)
        if len(items) != expected:
            raise RuntimeError(f"page {partition.number}: {len(items)} items, not {expected}")
        for i, item in enumerate(items):
            yield partition.number * self.size + i, partition.number, json.dumps(item, ensure_ascii=False, sort_keys=True)


class PagedJson(DataSource):
    """``spark.read.format("paged_json").option("url", ...)``: position, page, item (JSON text). A failed page fails its task
    alone and is read again."""

    opener: Open = staticmethod(open_url)

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "position long, page int, item string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options, type(self).opener)


class _NumberedReader(DataSourceReader):
    def __init__(self, options: dict, opener: Open) -> None:
        self.url, self.size, self.opener = options["url"], int(options.get("pagesize", 100)), opener
        self.params = json.loads(options.get("params", "{}"))

    def _fetch(self, number: int) -> tuple[int, list]:
        answer = request_json(self.url, {**self.params, "pageNo": number, "pageSize": self.size}, opener=self.opener)
        if not isinstance(answer, list) or not answer or not isinstance(answer[0], dict):
            raise RuntimeError(f"page {number}: no answer of the expected form")
        rows, total = answer[0].get("listOfQuestions"), answer[0].get("totalRecordSize")
        if not isinstance(rows, list) or total is None or int(total) < 0:
            raise RuntimeError(f"page {number}: no rows or no total")
        return int(total), rows

    def partitions(self) -> list[InputPartition]:
        total, rows = self._fetch(1)
        if total and not rows:
            raise RuntimeError(f"ended after 0 of {total} rows")
        self.size = len(rows) or self.size  # an interface may give less than was asked for
        return [_Page(n, total, len(rows)) for n in range(1, -(-total // self.size) + 1)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        size = partition.pages
        total, rows = self._fetch(partition.number)
        if total != partition.total:
            raise RuntimeError(f"page {partition.number}: the count changed from {partition.total} to {total}")
        before = (partition.number - 1) * size
        if len(rows) != min(size, total - before):
            raise RuntimeError(f"page {partition.number}: ended after {before + len(rows)} of {total} rows")
        for i, row in enumerate(rows):
            yield before + i, partition.number, json.dumps(row, ensure_ascii=False, sort_keys=True)


class NumberedJson(DataSource):
    """``spark.read.format("numbered_json")`` with options url, params (JSON) and pagesize: position, page, item of an interface
    that numbers its pages from 1 and says its total. The total must not change, and no page may end early."""

    opener: Open = staticmethod(open_url)

    @classmethod
    def name(cls) -> str:
        return "numbered_json"

    def schema(self) -> str:
        return "position long, page int, item string"

    def reader(self, schema) -> DataSourceReader:
        return _NumberedReader(self.options, type(self).opener)
