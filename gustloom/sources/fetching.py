"""A data source of requests: ``spark.read.format("requests")`` gives a row for every attempt, ``readStream`` for requests as they are planned.

The engine has no network of its own: ``transport`` names a function (``module:function``, on the PYTHONPATH of the workers) that
takes (url, timeout in seconds) and returns (HTTP status, bytes), or raises. A request is a partition: its attempts are
made by one task, one after the other, and a task that is run again makes them again. What is asked for is idempotent.

    spark.dataSource.register(fetching.RequestSource)
    spark.read.format("requests").options(plan=fetching.plan_json(planned), transport="mine:get", delays="1,2,4", magic="47524942").load()
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "key string, url string, attempt int, status string, http_status int, n_bytes long, elapsed_seconds double, exception_type string, exception_message string, sha256 string, content binary, last boolean"
#: HTTP answers after which another attempt may succeed.
PASSING = frozenset((408, 425, 429, *range(500, 600)))
#: Characters of an exception's message that are kept.
MESSAGE = 300


class Request(InputPartition):
    def __init__(self, key: str, url: str):
        self.key, self.url = key, url


def named(path: str) -> Callable:
    """The function that ``module:function`` names."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def attempts(request: Request, transport: Callable[[str, float], tuple[int, bytes]], delays: list[float], magic: list[bytes], timeout: float, sleep: Callable[[float], None] = time.sleep) -> Iterator[Row]:
    """A row for each attempt of a request, until one succeeds, fails for good or is the last: one more than there are delays.

    ``status``: received; not_found (404, 410: no other attempt); http_error; not_the_format, where the bytes begin with none
    of ``magic``; empty; transport_error, where the transport raised. Bytes are kept of what was received alone.
    """
    for n, pause in enumerate([*delays, None], 1):
        began, http, body, error = time.monotonic(), None, b"", None
        try:
            http, body = transport(request.url, timeout)
        except Exception as raised:  # whatever the caller's transport raises is what the attempt came to
            error = raised
        took = round(time.monotonic() - began, 3)
        if error is not None:
            status, again = "transport_error", True
        elif http in (404, 410):
            status, again = "not_found", False
        elif not 200 <= http < 300:
            status, again = "http_error", http in PASSING
        elif not body:
            status, again = "empty", True
        elif magic and not body.startswith(tuple(magic)):
            status, again = "not_the_format", True  # an error page, or a file that is still being written
        else:
            status, again = "received", False
        done = pause is None or not again
        good = status == "received"
        yield Row(
            key=request.key, url=request.url, attempt=n, status=status, http_status=http, n_bytes=len(body), elapsed_seconds=took, exception_type=type(error).__name__ if error else None,
            exception_message=str(error)[:MESSAGE] if error else None, sha256=hashlib.sha256(body).hexdigest() if good else None, content=body if good else None, last=done,
        )
        if done:
            return
        sleep(pause)


class _Settings:
    def __init__(self, options: dict[str, str]):
        self.transport = options["transport"]
        self.delays = [float(x) for x in options.get("delays", "1,2,4").split(",") if x.strip()]
        self.magic = [bytes.fromhex(x) for x in options.get("magic", "").split(",") if x.strip()]
        self.timeout = float(options.get("timeout", "90"))

    def read(self, request: Request) -> Iterator[Row]:
        return attempts(request, named(self.transport), self.delays, self.magic, self.timeout)


def _requests(plan: str) -> list[Request]:
    return [Request(str(x["key"]), x["url"]) for x in json.loads(plan)]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.settings, self.plan = _Settings(options), options["plan"]

    def partitions(self) -> list[Request]:
        return _requests(self.plan)

    def read(self, partition: Request) -> Iterator[Row]:
        return self.settings.read(partition)


class _StreamReader(DataSourceStreamReader):
    """Requests as a planner lists them. An offset is how many of them have been asked; the planner only adds to its list.

    A batch has ``maxRequestsPerTrigger`` at most; a run with availableNow is one batch for sources in Python.
    """

    def __init__(self, options: dict[str, str]):
        self.settings, self.planner, self.most = _Settings(options), options["planner"], int(options.get("maxrequestspertrigger", "1000"))
        self.at = 0

    def initialOffset(self) -> dict:
        return {"asked": 0}

    def latestOffset(self) -> dict:
        self.at = max(self.at, min(len(_requests(named(self.planner)())), self.at + self.most))
        return {"asked": self.at}

    def partitions(self, start: dict, end: dict) -> list[Request]:
        self.at = max(self.at, end["asked"])
        return _requests(named(self.planner)())[start["asked"] : end["asked"]]

    def read(self, partition: Request) -> Iterator[Row]:
        return self.settings.read(partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class RequestSource(DataSource):
    """Options: transport; plan (JSON list of key and url) or, for streams, planner (``module:function`` that gives such JSON); delays, magic (hex, with commas), timeout."""

    @classmethod
    def name(cls) -> str:
        return "requests"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)


def plan_json(requests: DataFrame) -> str:
    """A plan (key, url) as the source takes it. It is a list of files to ask for, hundreds a cycle, and goes through the driver."""
    return json.dumps([{"key": str(r["key"]), "url": r["url"]} for r in requests.select("key", "url").orderBy("key").toLocalIterator()])


def received(rows: DataFrame) -> DataFrame:
    """(key, url, sha256, content) of requests that succeeded."""
    return rows.where("status = 'received'").select("key", "url", "sha256", "content")


def diagnostics(rows: DataFrame) -> DataFrame:
    """(key, success, attempts, status, http_status, response_bytes, elapsed_seconds, exceptions): how each request went, all its attempts together."""
    last = F.max_by(F.struct("status", "http_status"), "attempt")
    return rows.groupBy("key").agg(
        F.bool_or(F.col("status") == "received").alias("success"), F.max("attempt").alias("attempts"), last.alias("x"), F.sum("n_bytes").alias("response_bytes"), F.sum("elapsed_seconds").alias("elapsed_seconds"),
        F.array_sort(F.collect_set("exception_type")).alias("exceptions"),
    ).select("key", "success", "attempts", "x.status", "x.http_status", "response_bytes", "elapsed_seconds", "exceptions")
