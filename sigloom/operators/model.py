"""Answers of a model to requests, through a client per partition.

A transport is a function that takes a request and returns the answer's text. ``connect`` makes
one where the partition is worked on, so clients and their connections are never sent anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar

Transport = Callable[[str], str]
MAX_ANSWER_CHARS = 16_384


def answers(requests: DataFrame, connect: Callable[[], Transport], fields: str, key: str = "signal_id", attempts: int = 3) -> DataFrame:
    """(key, the answer's ``fields``, failure) for every row (key, request); a row each.

    The text is freed of a Markdown fence and read as JSON. ``failure`` is null, or says why the fields
    are: the transport raised on every attempt, the text wasn't a JSON object, or it was longer than ``MAX_ANSWER_CHARS``. Nothing is lost silently.
    """
    kind = requests.schema[key].dataType.simpleString()

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = None
        for frame in frames:
            texts, failures = [], []
            for request in frame["request"]:
                text = failure = None
                for _ in range(attempts):
                    try:
                        if send is None:
                            send = connect()
                        text, failure = send(request), None
                        if len(text) > MAX_ANSWER_CHARS:
                            text, failure = None, f"the answer has {len(text)} characters, more than {MAX_ANSWER_CHARS}"
                        break
                    except Exception as e:  # the client's own errors are of any kind; each is reported in the row
                        send, failure = None, f"{type(e).__name__}: {e}"
                texts.append(text)
                failures.append(failure)
            yield pd.DataFrame({key: frame[key], "text": texts, "failure": failures})

    asked = requests.select(key, "request").mapInPandas(ask, f"`{key}` {kind}, text string, failure string")
    parsed = asked.withColumn("a", F.from_json(scalar.strip_fence(F.col("text")), f"{fields}, _broken STRING", {"columnNameOfCorruptRecord": "_broken"}))
    names = [c for c in parsed.select("a.*").columns if c != "_broken"]
    broken = F.col("text").isNotNull() & (F.col("a").isNull() | F.col("a._broken").isNotNull())
    failure = F.coalesce("failure", F.when(broken, F.lit("the answer is not the JSON that was asked for")))
    return parsed.select(key, *(F.when(~broken, F.col(f"a.{c}")).alias(c) for c in names), failure.alias("failure"))


def classified(signals: DataFrame, requests: DataFrame, connect: Callable[[], Transport], fields: str, key: str = "signal_id") -> DataFrame:
    """``signals`` with the answers' columns: a model in the place of ``events.classify``."""
    return signals.join(answers(requests, connect, fields, key), key, "left")
