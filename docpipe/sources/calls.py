"""Many requests from one task: a window of concurrent calls, a token bucket, a ledger.

A ledger is a folder with a subfolder for each bucket of ids. A task that works on a bucket
first reads what the bucket's files already hold and leaves those ids out, and writes a new
file after every few replies. So whatever ends a run (a lost executor, a retried task, a kill),
the next one sends only what has no final reply on record; replies that were under way get
the same idempotency key again, and a service's "already there" (409) counts as success.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "id string, status_code int, body string, error string, final boolean"
_LEDGER = pa.schema([("id", pa.string()), ("status_code", pa.int32()), ("body", pa.string()), ("error", pa.string()), ("final", pa.bool_())])


def windowed(items: Iterable, call: Callable, window: int, seconds: float | None = None, late=None) -> Iterator[tuple]:
    """(item, result) in the items' order, with up to ``window`` calls under way.

    A call that takes longer than ``seconds`` is given up: its result is ``late``. What a
    call raises is raised here.
    """
    waiting: deque = deque()

    def start(item):
        box, done = [], threading.Event()

        def run():
            try:
                box.append((call(item), None))
            except BaseException as e:  # noqa: BLE001  it is raised again below
                box.append((None, e))
            done.set()

        threading.Thread(target=run, daemon=True).start()
        waiting.append((item, box, done, time.monotonic()))

    def finish():
        item, box, done, began = waiting.popleft()
        if not done.wait(None if seconds is None else max(0.0, began + seconds - time.monotonic())):
            return item, late
        value, error = box[0]
        if error is not None:
            raise error
        return item, value

    for item in items:
        if len(waiting) >= window:
            yield finish()
        start(item)
    while waiting:
        yield finish()


class TokenBucket:
    """At most ``rate`` calls a second on average, ``burst`` at once; a rate of None never waits."""

    def __init__(self, rate: float | None, burst: int = 1):
        self.rate, self.burst, self.left, self.at, self.lock = rate, burst, float(burst), time.monotonic(), threading.Lock()

    def take(self) -> None:
        if self.rate is None:
            return
        with self.lock:
            now = time.monotonic()
            self.left = min(self.burst, self.left + (now - self.at) * self.rate) - 1
            self.at = now
            wait = -self.left / self.rate
        if wait > 0:
            time.sleep(wait)


def attempts(send: Callable[[], tuple[int, str]], tries: int, pause: float, limit: TokenBucket) -> tuple[int, str, str]:
    """(status code, body, error) of the first reply below 500; connection errors (-1) and others are tried again."""
    code, error = -1, ""
    for k in range(tries):
        limit.take()
        try:
            code, body = send()
            if code < 500:
                return code, body, "" if code in (200, 201, 204, 409) else f"HTTP {code}"
            error = f"HTTP {code}"
        except OSError as e:
            code, error = -1, f"Connection error: {e}"
        if k < tries - 1:
            time.sleep(pause * 2**k)
    return code, "", error


def _fixed_buckets(spark: SparkSession, ledger: str, buckets: int) -> int:
    """The ledger's number of buckets: what its first run wrote down."""
    store, path = pafs.FileSystem.from_uri(ledger if "://" in ledger else f"file://{ledger}")
    store.create_dir(path, recursive=True)
    note = f"{path}/_ledger.json"
    if store.get_file_info(note).type == pafs.FileType.NotFound:
        with store.open_output_stream(note) as f:
            f.write(json.dumps({"buckets": buckets}).encode())
    with store.open_input_stream(note) as f:
        return json.loads(f.read())["buckets"]


def resumable(rows: DataFrame, key: str, send: Callable[..., tuple[int, str]], ledger: str, payload: str | None = None, buckets: int = 200, window: int = 4, tries: int = 3, pause: float = 1.0, rate: float | None = None, flush_every: int = 50) -> DataFrame:
    """Send each id once over all runs with this ledger; the ledger's replies of these rows.

    ``send(id)``, or ``send(id, payload)`` with a payload column, gives (status code, body).
    Replies below 500 are final; ids with others only are sent again by the next run.
    ``ledger``: a folder that all executors reach. ``rate``: calls a second of one task. Null
    ids are left out; repeated ids are sent once, with the first payload that comes.

    The call itself runs the requests; the result (id, status_code, body, error, final) is a
    plain table of files, one row an id, that can be read as often as wanted.
    """
    spark = rows.sparkSession
    buckets = _fixed_buckets(spark, ledger, buckets)
    asked = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("id"), (F.col(payload).cast("string") if payload else F.lit(None).cast("string")).alias("payload"))
    asked = asked.withColumn("bucket", F.pmod(F.crc32(F.encode("id", "UTF-8")), F.lit(buckets)).cast("int"))
    where = ledger if "://" in ledger else f"file://{ledger}"

    def run(batches):
        store, root = pafs.FileSystem.from_uri(where)
        limit = TokenBucket(rate)
        now, done, held, sent = None, set(), [], 0

        def flush():
            nonlocal held
            if held:
                columns = [pa.array(x, f.type) for x, f in zip(zip(*held), _LEDGER)]
                folder = f"{root}/bucket={now}"
                store.create_dir(folder, recursive=True)
                name = uuid.uuid4().hex
                pq.write_table(pa.Table.from_arrays(columns, schema=_LEDGER), f"{folder}/.{name}", filesystem=store)
                store.move(f"{folder}/.{name}", f"{folder}/{name}.parquet")  # whole or not there
            held = []

        def finished(bucket):
            found = store.get_file_info(pafs.FileSelector(f"{root}/bucket={bucket}", allow_not_found=True))
            out = set()
            for f in found:
                if f.path.endswith(".parquet"):
                    t = pq.ParquetFile(store.open_input_file(f.path)).read(["id", "final"])
                    out.update(i for i, ok in zip(t["id"].to_pylist(), t["final"].to_pylist()) if ok)
            return out

        def fresh():
            nonlocal now, done
            for t in batches:
                for i, body, bucket in zip(*(t[c].to_pylist() for c in ("id", "payload", "bucket"))):
                    if bucket != now:
                        yield None  # what is under way ends before the bucket does
                        now, done = bucket, finished(bucket)
                    if i not in done:
                        done.add(i)
                        yield i, body

        def call(item):
            i, body = item
            return attempts((lambda: send(i, body)) if payload else (lambda: send(i)), tries, pause, limit)

        source = fresh()
        more = True
        while more:
            more = False

            def until_next():
                nonlocal more
                for item in source:
                    if item is None:
                        more = True
                        return
                    yield item

            for (i, _), (code, body, error) in windowed(until_next(), call, window):
                held.append((i, code, body, error, 0 <= code < 500))
                sent += 1
                if len(held) >= flush_every:
                    flush()
            flush()
            # the next bucket begins when the source is asked again
        yield pa.RecordBatch.from_pydict({"sent": pa.array([sent], pa.int64())})

    asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "sent long").agg(F.sum("sent")).collect()
    replies = spark.read.schema(f"{LEDGER}, bucket int").option("basePath", ledger).option("pathGlobFilter", "*.parquet").parquet(ledger)
    last = replies.groupBy("id").agg(F.max_by(F.struct("status_code", "body", "error", "final"), F.struct("final", "status_code")).alias("r"))
    wanted = asked.select("id").distinct()
    return last.join(wanted, "id", "left_semi").select("id", "r.*")
