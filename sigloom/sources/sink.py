"""Rows to a GraphQL service from where they are: a data source that only writes, in batch and as a stream's sink.

Every task sends its own rows, ``batch`` of them in a request, through ``graphql.Executor`` with its retries. A task that fails
makes Spark repeat the batch, so rows are sent at least once. That each takes effect once is seen to in two ways. Each row carries its own
key, the value of the column ``key``, in the field ``keyField`` of its input; a service that heeds it ignores the second of two. And
what a failed attempt has got through is written down in the folder ``ledger`` before the task fails, so the
next attempt leaves it out, whichever task the rows come to then; that helps with services that don't heed keys, but for a
task that is killed in the middle. With the batch's end its entries are deleted.

Options: ``url``; ``operation``, one of ``OPERATIONS``; ``key``; ``keyField`` (none if empty); ``batch``; ``ledger``, a URI that pyarrow opens, shared by all executors; ``retries``;
``waitScale`` for the waits between attempts; options that begin with ``header.`` are sent as headers. An update takes its id from the
column ``key`` and leaves out what is null, so it changes only what it names.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .graphql import Executor

#: The service's mutations.
OPERATIONS = ("createSignal", "createEvent", "updateEvent", "createAlert")


@dataclass
class Sent(WriterCommitMessage):
    rows: int
    left_out: int
    requests: int


def plain(value: object) -> object:
    """A value as JSON has it."""
    if isinstance(value, Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dt.datetime):
        return (value if value.tzinfo else value.replace(tzinfo=dt.UTC)).isoformat()
    return value if value is None or isinstance(value, (str, int, float, bool)) else str(value)


def mutation(operation: str, n: int) -> str:
    """One request for n rows; row i has the variables $i<i> and, for an update, $k<i>."""
    kind = operation[0].upper() + operation[1:] + "Input"
    update = operation.startswith("update")
    given = ", ".join((f"$k{i}: String!, " if update else "") + f"$i{i}: {kind}!" for i in range(n))
    body = " ".join(f"r{i}: {operation}({f'id: $k{i}, ' if update else ''}input: $i{i}) {{ id }}" for i in range(n))
    return f"mutation({given}) {{ {body} }}"


class Rows:
    """What both writers do in a task."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.options = {k.lower(): v for k, v in options.items()}
        self.operation, self.key = self.options.get("operation"), self.options.get("key")
        if self.operation not in OPERATIONS:
            raise ValueError(f"operation must be one of {', '.join(OPERATIONS)}, not {self.operation}")
        if self.key not in schema.names:
            raise ValueError(f"key must be a column, not {self.key}")
        self.key_field = self.options.get("keyfield", "clientMutationId")

    def _ledger(self, batch: str) -> tuple[fs.FileSystem, str] | None:
        if not self.options.get("ledger"):
            return None
        system, path = fs.FileSystem.from_uri(self.options["ledger"])
        return system, f"{path}/batch-{batch}"

    def _through(self, batch: str) -> set[str]:
        """Keys that earlier attempts of the batch have got through."""
        found: set[str] = set()
        if (ledger := self._ledger(batch)) is not None:
            system, path = ledger
            for file in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if not file.base_name.endswith(".part"):
                    with system.open_input_stream(file.path) as f:
                        found |= set(json.loads(f.read()))
        return found

    def _note(self, batch: str, keys: list[str]) -> None:
        if keys and (ledger := self._ledger(batch)) is not None:
            system, path = ledger
            system.create_dir(path, recursive=True)
            name = f"{path}/{uuid.uuid4().hex}.json"
            with system.open_output_stream(name + ".part") as f:
                f.write(json.dumps(keys).encode())
            system.move(name + ".part", name)

    def forget(self, batch: str) -> None:
        if (ledger := self._ledger(batch)) is not None and ledger[0].get_file_info(ledger[1]).type == fs.FileType.Directory:
            ledger[0].delete_dir(ledger[1])

    def send(self, rows: Iterator[Row], batch: str) -> Sent:
        scale, headers = float(self.options.get("waitscale", 1)), {k[7:]: v for k, v in self.options.items() if k.startswith("header.")}
        executor = Executor(self.options["url"], headers, int(self.options.get("retries", 3)), lambda s: time.sleep(s * scale))
        known, most = self._through(batch), int(self.options.get("batch", 20))
        done: list[str] = []
        some: list[dict] = []
        left_out = requests = 0

        def flush() -> None:
            nonlocal requests
            if not some:
                return
            given: dict[str, object] = {}
            for i, row in enumerate(some):
                values = dict(row)
                if self.operation.startswith("update"):
                    given[f"k{i}"] = str(values.pop(self.key))
                    values = {k: v for k, v in values.items() if v is not None}
                given[f"i{i}"] = values | ({self.key_field: str(row[self.key])} if self.key_field else {})
            executor.execute(mutation(self.operation, len(some)), given)
            requests += 1
            done.extend(str(row[self.key]) for row in some)
            some.clear()

        try:
            for row in rows:
                values = plain(row)
                if str(values[self.key]) in known:
                    left_out += 1
                    continue
                some.append(values)
                if len(some) == most:
                    flush()
            flush()
        except BaseException:
            self._note(batch, done)
            raise
        if batch:
            self._note(batch, done)  # another task of the batch may fail yet
        return Sent(len(done), left_out, requests)


class BatchWriter(DataSourceWriter):
    def __init__(self, rows: Rows):
        self.rows = rows

    def write(self, iterator: Iterator[Row]) -> Sent:
        return self.rows.send(iterator, "")

    def commit(self, messages: list[Sent | None]) -> None:
        self.rows.forget("")

    def abort(self, messages: list[Sent | None]) -> None:
        """What went through stays; the next attempt leaves it out."""


class StreamWriter(DataSourceStreamWriter):
    def __init__(self, rows: Rows):
        self.rows = rows

    def write(self, iterator: Iterator[Row]) -> Sent:
        return self.rows.send(iterator, TaskContext.get().getLocalProperty("streaming.sql.batchId") or "")

    def commit(self, messages: list[Sent | None], batchId: int) -> None:  # noqa: N803
        self.rows.forget(str(batchId))

    def abort(self, messages: list[Sent | None], batchId: int) -> None:  # noqa: N803
        """What went through stays; the next attempt leaves it out."""


class GraphQLRows(DataSource):
    """``spark.dataSource.register(GraphQLRows)``; ``stream.writeStream.format("graphql_rows").options(..).start()``"""

    @classmethod
    def name(cls) -> str:
        return "graphql_rows"

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(Rows(dict(self.options), schema))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(Rows(dict(self.options), schema))
