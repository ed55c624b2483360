"""Calls to an outside provider for every row, in batches, with retries; failures become a column, not an exception."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


class FatalProviderError(Exception):
    """A failure that no retry can mend; it ends the job."""


def with_retries(call: Callable[[str], str], request: str, attempts: int = 3, wait: float = 2.0) -> tuple[str | None, str | None]:
    """(response, error): up to ``attempts`` calls, with a longer wait after each failure."""
    for k in range(1, attempts + 1):
        try:
            return call(request), None
        except FatalProviderError:
            raise
        except Exception as e:  # any other failure of the provider may pass
            error = f"{type(e).__name__}: {e}"
            if k < attempts:
                time.sleep(wait * k)
    return None, error


def respond(requests: DataFrame, make: Callable[[], Callable[[str], str]], attempts: int = 3, wait: float = 2.0) -> DataFrame:
    """``id, response, error`` for every row of ``id long, request string``.

    ``make`` builds the client once per task. A null request gets a null response and the error ``no request``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for b in batches:
            got = [with_retries(call, r, attempts, wait) if r is not None else (None, "no request") for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=["id", "response", "error"])

    return requests.select("id", "request").mapInArrow(run, "id long, response string, error string")


def json_object(call: Callable[[str], tuple[str, bool]]) -> Callable[[str], str]:
    """A call that fails where the reply is cut off, empty, not JSON, or no object, so that ``with_retries`` asks again.

    ``call`` gives the reply and whether it was cut off.
    """

    def run(request: str) -> str:
        reply, cut = call(request)
        if cut:
            raise ValueError("the reply was cut off")
        if not (reply or "").strip():
            raise ValueError("empty reply")
        if not isinstance(json.loads(reply), dict):
            raise ValueError("the reply is no JSON object")
        return reply

    return run


def require_success(responses: DataFrame, most: float = 0.5) -> DataFrame:
    """``responses``, if at most the share ``most`` of them failed; else the job ends."""
    failed = failure_ratio(responses)
    if failed > most:
        raise FatalProviderError(f"{failed:.0%} of the requests failed")
    return responses


def embeddings(texts: DataFrame, make: Callable[[], Callable[[list[str]], list[list[float]]]], size: int = 200, attempts: int = 3, wait: float = 2.0) -> DataFrame:
    """``id, embedding array<double>`` for every row of ``id long, text string``: vectors of unit length.

    The provider is asked for ``size`` texts at a time. Null texts, texts of a request that failed, and zero vectors have
    a null embedding; such rows are compared by their words instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for b in batches:
            ids, words = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list = [None] * len(ids)
            asked = [i for i, t in enumerate(words) if t is not None]
            for at in range(0, len(asked), size):
                part = asked[at : at + size]
                got, _ = with_retries(lambda _: call([words[i] for i in part]), "", attempts, wait)  # noqa: B023
                for i, v in zip(part, got or ()):
                    norm = math.sqrt(sum(x * x for x in v))
                    out[i] = [x / norm for x in v] if norm else None
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float64()))], names=["id", "embedding"])

    return texts.select("id", "text").mapInArrow(run, "id long, embedding array<double>")


def failure_ratio(responses: DataFrame) -> float:
    """Share of rows without a response; 0 for none."""
    from pyspark.sql import functions as F

    r = responses.agg(F.avg(F.col("response").isNull().cast("double"))).first()[0]
    return float(r or 0.0)
