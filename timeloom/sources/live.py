"""Live payloads as a Spark data source: one partition per series, fetched on the executors.

The transport is given by the caller as options; nothing here needs a network
until a read runs.
"""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRIES, LONGEST_WAIT, LONGEST_RETRY_AFTER = 4, 30.0, 300.0


def fetch(url: str, pause: float = 0.0, opener=urllib.request.urlopen, sleep=time.sleep) -> str:
    """The body of url; waits and tries again on 429 and 5xx, as long as the server asks, up to a limit."""
    for attempt in range(RETRIES + 1):
        sleep(pause)
        try:
            with opener(url, timeout=60) as answer:
                return answer.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as e:
            if attempt == RETRIES or (e.code != 429 and e.code < 500):
                raise
            asked = e.headers.get("Retry-After") if e.headers else None
            wait = min(float(asked), LONGEST_RETRY_AFTER) if asked and asked.isdigit() else min(2.0**attempt, LONGEST_WAIT) + random.uniform(0, 0.5)
            sleep(wait)
    raise RuntimeError("unreachable")


def pages(template: str, series: str, rows: str, pause: float = 0.0):
    """The bodies of a series: one, or where the template names {offset} or {page}, all until the answer's count or meta.total-pages is reached.

    rows: the key of an answer's list. Without such a total, an empty answer or one that repeats the last ends the list.
    """
    paged, offset, page, last = "{offset}" in template or "{page}" in template, 0, 1, None
    while True:
        body = fetch(template.format(series=series, offset=offset, page=page), pause)
        if not paged:
            yield body
            return
        answer = json.loads(body)
        found = answer.get(rows) or []
        if page == 1 or (found and body != last):
            yield body
        if not found or body == last:
            return
        offset, last = offset + len(found), body
        count, total = answer.get("count"), (answer.get("meta") or {}).get("total-pages")
        if (total is not None and page >= int(total)) or (total is None and count is not None and offset >= int(count)):
            return
        page += 1


class SeriesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.source, self.template = options["source"], options["url"]
        self.series, self.pause, self.rows = options["series"].split(","), float(options.get("pause", 0)), options.get("rows", "data")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in self.series]

    def read(self, partition: InputPartition):
        for body in pages(self.template, partition.value, self.rows, self.pause):
            yield self.source, partition.value, body


class PayloadSource(DataSource):
    """spark.dataSource.register(PayloadSource); spark.read.format("payloads").options(source=…, url="https://…{series}…", series="A,B").load()

    A row per page: url may name {offset} or {page}, and rows is the key of an answer's list ("data").
    """

    @classmethod
    def name(cls) -> str:
        return "payloads"

    def schema(self) -> str:
        return "source string, series_id string, payload string"

    def reader(self, schema) -> SeriesReader:
        return SeriesReader(dict(self.options))
