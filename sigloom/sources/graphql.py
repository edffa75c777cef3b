"""A GraphQL executor for the driver side of sinks: retries, and any ``errors`` key is a failure."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable


class GraphQLError(RuntimeError):
    pass


class Executor:
    def __init__(self, url: str, headers: dict[str, str] | None = None, retries: int = 3, sleep: Callable[[float], None] = time.sleep, timeout: float = 30.0):
        self.url, self.headers, self.retries, self.sleep, self.timeout = url, headers or {}, retries, sleep, timeout

    def execute(self, query: str, variables: dict | None = None) -> dict:
        """The ``data`` of the response; waits 2 s, 4 s, ... between attempts."""
        body = json.dumps({"query": query, "variables": variables or {}}).encode()
        for attempt in range(1, self.retries + 1):
            try:
                request = urllib.request.Request(self.url, body, {"Content-Type": "application/json", **self.headers}, method="POST")
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    answer = json.load(r)
                if "errors" in answer:  # whatever it holds
                    raise GraphQLError(json.dumps(answer["errors"]))
                return answer["data"]
            except (OSError, GraphQLError):
                if attempt == self.retries:
                    raise
                self.sleep(2.0**attempt)
        raise AssertionError


def insert_rows(executor: Executor, mutation: str, rows: list[dict]) -> list[dict]:
    """One mutation per row of a small micro-batch; rows carry their own idempotency keys."""
    return [executor.execute(mutation, {"input": row}) for row in rows]
