"""HTTP connectors. They are never used unless called, and never by tests against a network.

Requests are made in executors through a ``send`` function that the caller gives:
``send(doc_id) -> (status code, body)``. Codes of 500 and above and raised connection
errors are tried again with growing pauses; other codes are final. A retried task sends
again, so a sink's service must accept a repeated idempotency key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import files
from .calls import TokenBucket, attempts, resumable

_REPLY = "doc_id string, status_code int, body string, error string"


def fetch(ids: DataFrame, send: Callable[[str], tuple[int, str]], retries: int = 3, pause: float = 1.0, rate: float | None = None, ledger: str | None = None) -> DataFrame:
    """Documents by id: doc_id, status, pdf_buffer, file_size, error, status_code.

    With a ``ledger`` (a folder that all executors reach) the requests are made now, and
    each id that has a final reply on record is not sent again, by this run or a later one.
    """
    if ledger is not None:
        replies = resumable(ids, "doc_id", send, ledger, tries=retries, pause=pause, rate=rate).withColumnRenamed("id", "doc_id")
    else:

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            limit = TokenBucket(rate)
            for b in batches:
                yield pd.DataFrame([(i, *attempts(lambda: send(i), retries, pause, limit)) for i in b["doc_id"]], columns=["doc_id", "status_code", "body", "error"])  # noqa: B023

        replies = ids.select(F.col("doc_id").cast("string")).mapInPandas(run, _REPLY)
    refused = files.reply_status(F.col("body"))
    decoded = files.decode_payload(files.locate_payload(F.col("body")))
    rows = replies.withColumns({"_r": refused, "_d": decoded})
    ok = (F.col("status_code") == 200) & F.col("_r").isNull() & (F.col("_d.error") == "")
    error = F.when(F.col("status_code") != 200, F.col("error")).when(F.col("_r").isNotNull(), F.col("_r.error")).otherwise(F.col("_d.error"))
    return rows.select("doc_id", F.when(ok, "success").otherwise("failed").alias("status"), F.when(ok, F.col("_d.pdf_buffer")).alias("pdf_buffer"), F.lit(None).cast("string").alias("content"), F.concat("doc_id", F.lit(".pdf")).alias("file_name"), F.when(ok, F.octet_length("_d.pdf_buffer").cast("long")).alias("file_size"), error.alias("error"), F.coalesce("_r.status_code", "status_code").alias("status_code"))


def push(rows: DataFrame, payload: str, key: str, send: Callable[[str, str], tuple[int, str]], ledger: str | None = None) -> DataFrame:
    """Send a JSON column, a request a row with its idempotency key: key, status_code (-1: not reached), reply.

    With a ``ledger`` the requests are made now, and no key with a final reply is sent again.
    A reply of 409 says that an earlier request did its work (``pushed``).
    """
    if ledger is not None:
        done = resumable(rows, key, send, ledger, payload)
        return done.select(F.col("id").alias("key"), "status_code", F.coalesce(F.nullif("body", F.lit("")), "error").alias("reply"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, body in zip(b["k"], b["payload"]):
                try:
                    out.append((k, *send(k, body)))
                except OSError as e:
                    out.append((k, -1, str(e)))
            yield pd.DataFrame(out, columns=["key", "status_code", "reply"])

    return rows.select(F.col(key).cast("string").alias("k"), F.col(payload).alias("payload")).mapInPandas(run, "key string, status_code int, reply string")


def pushed(status_code: Column) -> Column:
    """Whether a reply says that the row is there: made now, or by an earlier request."""
    return status_code.isin(200, 201, 204, 409)
