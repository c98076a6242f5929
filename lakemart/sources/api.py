"""A paged HTTP API read as a Spark data source.

``spark.read.format("paged_api")`` plans ``(skip, limit)`` windows, dealt to
input partitions in runs of neighbours (one window each up to ``max_tasks``
windows), so pages are fetched in parallel by executors, never looped over on
the driver, and the number of tasks does not follow the number of pages.  The first page is fetched once on the
driver to learn ``total``; reading stops at ``total`` or ``max_rows``.  An
answer shorter than its window (a server that caps the page size) is followed
by requests for the rest; a window that ends early is an error, never a short
result.  Without ``total`` one task follows the pages to the first empty one.

The package must be importable on the workers (``--py-files`` or installed).

Options: ``url`` — a template with ``{skip}`` and ``{limit}`` (``http(s)://``
or ``file://``), ``limit`` (page size), ``max_rows``, ``retries``,
``backoff_seconds``, ``timeout``, ``items_field`` (default ``products``),
``max_tasks`` (default 200).
"""

from __future__ import annotations

import json
import time
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

DEFAULT_SCHEMA = "id bigint, title string, price double, stock bigint"


def fetch_json(url: str, retries: int = 3, backoff: float = 0.5, timeout: float = 10.0) -> dict:
    """GET a JSON document with bounded retries and exponential backoff."""
    last = None
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as resp:  # noqa: S310 - caller's URL
                return json.loads(resp.read().decode("utf-8"))
        except Exception as e:  # noqa: BLE001 - retried, re-raised below
            last = e
            if attempt < retries:
                time.sleep(backoff * (2 ** attempt))
    raise RuntimeError(f"fetch failed after {retries + 1} attempts: {url}") from last


def write_pages(rows, root: str, key: str, page_rows: int, items_field: str = "products") -> str:
    """Answers of a paged API kept as files under ``root``: page ``k`` holds
    the rows whose place in ``key`` order is from ``k * page_rows`` on.  Returns
    the source's URL template.  Every page names the ``total``."""
    from pyspark.sql import functions as F

    from lakemart.operators.layout import numbered_rows

    total = rows.count()
    placed = numbered_rows(rows, [key], "_place", 0) if total else rows.limit(0).selectExpr("*", "0L as _place")
    # An array holds one page.
    pages = placed.groupBy((F.floor(F.col("_place") / page_rows) * page_rows).alias("skip")).agg(
        F.sort_array(F.collect_list(F.struct("_place", F.struct(*rows.columns).alias("item")))).alias("items"))
    text = F.to_json(F.struct(F.transform("items", lambda x: x["item"]).alias(items_field), F.lit(total).alias("total"), "skip"))
    base = root if "://" in root else "file://" + root.removeprefix("file:")

    def write(batches):
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(base)
        files.create_dir(folder)
        for batch in batches:
            for skip, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_output_stream(f"{folder}/page-{skip}.json") as out:
                    out.write(page.encode())
            yield batch.select(["skip"])

    pages.select("skip", text.alias("page")).mapInArrow(write, "skip long").write.format("noop").mode("overwrite").save()
    if not total:
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(base)
        files.create_dir(folder)
        with files.open_output_stream(f"{folder}/page-0.json") as out:
            out.write(json.dumps({items_field: [], "total": 0}).encode())
    return base + "/page-{skip}.json"


class IncompletePageError(RuntimeError):
    pass


class PageWindow(InputPartition):
    """Rows ``skip`` to ``skip + limit``, in windows of ``step`` rows;
    ``limit`` None: to the end."""

    def __init__(self, skip: int, limit: int | None, step: int | None = None):
        super().__init__((skip, limit, step))
        self.skip, self.limit, self.step = skip, limit, step

    def windows(self) -> list[tuple[int, int | None]]:
        if self.limit is None or not self.step:
            return [(self.skip, self.limit)]
        return [(self.skip + s, n) for s, n in plan_windows(self.limit, self.step, None)]


def plan_windows(total: int, limit: int, max_rows: int | None) -> list[tuple[int, int]]:
    """(skip, limit) windows covering min(total, max_rows) rows."""
    stop = total if max_rows is None else min(total, max_rows)
    return [(s, min(limit, stop - s)) for s in range(0, stop, limit)]


class PagedApiReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema = schema
        self.url = options["url"]
        self.limit = int(options.get("limit", 30))
        self.max_rows = int(options["max_rows"]) if "max_rows" in options else None
        self.retries = int(options.get("retries", 3))
        self.backoff = float(options.get("backoff_seconds", 0.5))
        self.timeout = float(options.get("timeout", 10))
        self.items_field = options.get("items_field", "products")
        self.max_tasks = int(options.get("max_tasks", 200))

    def _get(self, skip: int, limit: int) -> dict:
        return fetch_json(self.url.format(skip=skip, limit=limit), self.retries, self.backoff, self.timeout)

    def partitions(self):
        total = self._get(0, self.limit).get("total")
        if total is None:
            return [PageWindow(0, self.max_rows)]
        stop = int(total) if self.max_rows is None else min(int(total), self.max_rows)
        each = max(1, -(-stop // (self.limit * self.max_tasks)))   # windows per task
        # One empty window where there is nothing: a reader has a partition.
        return [PageWindow(s, n, self.limit) for s, n in plan_windows(stop, self.limit * each, None) or [(0, 0)]]

    def read(self, partition: PageWindow):
        for skip, limit in partition.windows():
            yield from self._read_window(skip, limit)

    def _read_window(self, skip: int, limit: int | None):
        names = [f.name for f in self.schema.fields]
        got, counted = 0, True
        while limit is None or got < limit:
            want = self.limit if limit is None else min(self.limit, limit - got)
            page = self._get(skip + got, want)
            items = page.get(self.items_field, [])[:want]
            counted = page.get("total") is not None
            if not items:
                break
            got += len(items)
            for item in items:
                yield tuple(item.get(n) for n in names)
        if limit is not None and got < limit and counted:
            raise IncompletePageError(f"{got} of {limit} rows from {skip} on")


class PagedApiDataSource(DataSource):
    @classmethod
    def name(cls):
        return "paged_api"

    def schema(self):
        return self.options.get("schema", DEFAULT_SCHEMA)

    def reader(self, schema):
        return PagedApiReader(schema, self.options)


def register(spark) -> None:
    spark.dataSource.register(PagedApiDataSource)
