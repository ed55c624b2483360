"""Problem 2: messages delivered more than once.

Method: an index of identifiers in sorted arrays by hash prefix. A run is an immutable table with one row per prefix:
the sorted 128-bit hashes of its identifiers, and for each the earliest delivery seen. An incoming batch is first
deduplicated locally (the aggregate combines before its shuffle, so an identifier with a third of all rows is one row
per task), then each prefix binary-searches its arrays of all runs; what is new, or earlier than what the index holds,
becomes the next run.

Runs are bucketed by prefix, so they are read where they are: only the batch is shuffled, whatever the index holds. Runs
have levels; four of a level are merged into one of the next, again without a shuffle, so an identifier is rewritten
once for each level, of which there are as many as the logarithm of the number of batches.

The index persists: its folder has a manifest with the runs, written anew under another number and renamed into place
after each step; opening the folder reads the newest one. A run that no manifest names (the job ended before) is ignored.
The index keeps the minimum per identifier, so the order in which batches arrive does not change the result.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _delete, scratch_path

#: Identifiers per prefix that a task holds at a time (32 bytes each, twice while searching).
PER_PREFIX = 50_000
_RUN = "prefix int, n long, hi binary, lo binary, ts binary, did binary"
_COLUMNS = ("hi", "lo", "ts", "did")


def source_key(source: Column) -> Column:
    """A source without letter case and surrounding white space; null is ''."""
    return F.coalesce(F.lower(F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))


def _arrays(t: pa.Table) -> list[np.ndarray]:
    hi, lo = (t.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo"))
    return [hi, lo, t.column("ts").to_numpy(), t.column("did").to_numpy()]


def _sorted_least(hi: np.ndarray, lo: np.ndarray, ts: np.ndarray, did: np.ndarray) -> list[np.ndarray]:
    """Sorted by identifier; of equal identifiers the earliest delivery."""
    order = np.lexsort((did, ts, lo, hi))
    hi, lo, ts, did = (x[order] for x in (hi, lo, ts, did))
    keep = np.ones(len(hi), bool)
    keep[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    return [x[keep] for x in (hi, lo, ts, did)]


def _row(prefix: int, a: list[np.ndarray]) -> pa.Table:
    cols = [pa.array([prefix], pa.int32()), pa.array([len(a[0])], pa.int64()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in a)]
    return pa.table(cols, names=["prefix", "n", *_COLUMNS])


def _load(row: dict) -> list[np.ndarray]:
    return [np.frombuffer(row[c], np.uint64 if c in ("hi", "lo") else np.int64) for c in _COLUMNS]


def search(run: list[np.ndarray], hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Positions of identifiers in a sorted run, -1 where it has none."""
    left, right = np.searchsorted(run[0], hi, "left"), np.searchsorted(run[0], hi, "right")
    out = np.full(len(hi), -1, np.int64)
    one = right - left == 1
    at = left[one]
    out[one] = np.where(run[1][at] == lo[one], at, -1)
    for i in np.flatnonzero(right - left > 1):  # equal first halves: a handful at most
        k = left[i] + np.searchsorted(run[1][left[i] : right[i]], lo[i])
        if k < right[i] and run[1][k] == lo[i]:
            out[i] = k
    return out


def _runs(row: dict) -> list[list[np.ndarray]]:
    """The arrays of all runs in a row with the columns of each behind one another (``r0_hi``, ...)."""
    n = sum(k.endswith("_hi") and k.startswith("r") for k in row)
    return [[np.frombuffer(row[f"r{k}_{c}"], np.uint64 if c in ("hi", "lo") else np.int64) for c in _COLUMNS] for k in range(n) if row[f"r{k}_hi"] is not None]


def _gathered(key: tuple[pa.Scalar, ...], new: pa.Table) -> pa.Table:
    """A batch's identifiers of one prefix as one row of sorted arrays."""
    return _row(key[0].as_py(), _sorted_least(*_arrays(new)))


def _probe(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """What of a batch's prefix is new to the index or earlier than there, as a row of the next run."""
    row = rows.to_pylist()[0]
    a = _load(row) if row["hi"] is not None else [np.array([], t) for t in (np.uint64, np.uint64, np.int64, np.int64)]
    keep = np.ones(len(a[0]), bool)
    for run in _runs(row) if len(keep) else ():
        at = search(run, a[0], a[1])
        hit = at >= 0
        ts, did = run[2][at[hit]], run[3][at[hit]]
        keep[hit] &= (a[2][hit] < ts) | ((a[2][hit] == ts) & (a[3][hit] < did))
    return _row(key[0].as_py(), [x[keep] for x in a])


def _merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    parts = _runs(rows.to_pylist()[0])
    return _row(key[0].as_py(), _sorted_least(*(np.concatenate(x) for x in zip(*parts))))


def _deliveries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob in b.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(blob, np.int64))], names=["did"])


class DeliveryIndex:
    """Identifiers seen so far, each with its earliest delivery; opened again by its folder."""

    def __init__(self, spark: SparkSession, expected: int = 0, merge_every: int = 4, path: str | None = None):
        """``path``: the folder of an index, new or not; a scratch folder if None. ``expected``: identifiers that a new
        index may come to hold, which sets the length of the hash prefix; an index that is there keeps its own."""
        self.spark = spark
        self.merge_every = merge_every
        self.path = path or scratch_path(spark, "delivery-index")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._views: dict[str, str] = {}
        found = self._manifest()
        if found:
            self.state = found
        else:
            bits = max(4, math.ceil(math.log2(max(1, expected) / PER_PREFIX))) if expected > PER_PREFIX else 4
            # A side that is no bucketed scan never has more partitions than these, so runs are not shuffled to match it.
            least = int(spark.conf.get("spark.sql.shuffle.partitions"))
            self.state = {"version": 0, "bits": bits, "buckets": max(least, 2**bits), "made": 0, "runs": []}

    @property
    def bits(self) -> int:
        return self.state["bits"]

    @property
    def runs(self) -> list[dict]:
        return self.state["runs"]

    def _manifest(self) -> dict | None:
        """The newest manifest of the folder."""
        folder = self._hadoop.Path(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return None
        names = sorted(str(f.getPath().getName()) for f in self._fs.listStatus(folder) if str(f.getPath().getName()).endswith(".json"))
        if not names:
            return None
        return json.loads(self.spark.sparkContext.wholeTextFiles(f"{self.path}/manifest/{names[-1]}").first()[1])

    def _commit(self, runs: list[dict]) -> None:
        """Name the runs in a new manifest; then those that it no longer names are deleted."""
        old = self.runs
        self.state = {**self.state, "version": self.state["version"] + 1, "runs": runs}
        name = f"{self.path}/manifest/{self.state['version']:09d}"
        out = self._fs.create(self._hadoop.Path(f"{name}.tmp"), True)
        out.write(bytearray(json.dumps(self.state).encode()))
        out.close()
        if not self._fs.rename(self._hadoop.Path(f"{name}.tmp"), self._hadoop.Path(f"{name}.json")):
            raise RuntimeError(f"another writer has made {name}.json")
        for r in old:
            if r not in runs:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._views.pop(r['name'], 'none')}")
                _delete(self.spark, f"{self.path}/{r['name']}")

    def _keys(self, batch: DataFrame) -> DataFrame:
        """Locally deduplicated identifiers of a batch (``s, m, ts, did``)."""
        hashed = batch.where("m IS NOT NULL").select(F.xxhash64("s", "m").alias("hi"), F.xxhash64(F.lit(77), "m", "s").alias("lo"), "ts", "did")
        least = hashed.groupBy("hi", "lo").agg(F.min(F.struct("ts", "did")).alias("x"))
        return least.select(F.shiftrightunsigned("hi", 64 - self.bits).cast("int").alias("prefix"), "hi", "lo", "x.ts", "x.did")

    def _write(self, df: DataFrame, level: int) -> dict:
        """A run with a row for every prefix, bucketed by prefix."""
        self.state["made"] += 1
        run = {"name": f"run-{self.state['made']:06d}-{uuid.uuid4().hex[:8]}", "level": level}
        view = f"weftline_{uuid.uuid4().hex}"
        df.write.option("path", f"{self.path}/{run['name']}").bucketBy(self.state["buckets"], "prefix").format("parquet").saveAsTable(view)
        self._views[run["name"]] = view
        return run

    def _table(self, run: dict) -> DataFrame:
        """A run as a bucketed table; the bucket of a file is in its name, so a folder is one again in any session."""
        if run["name"] not in self._views:
            view = f"weftline_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {view} ({_RUN}) USING parquet CLUSTERED BY (prefix) INTO {self.state['buckets']} BUCKETS LOCATION '{self.path}/{run['name']}'")
            self._views[run["name"]] = view
        return self.spark.table(self._views[run["name"]])

    def _beside(self, first: DataFrame, runs: list[dict]) -> DataFrame:
        """``first`` (rows by prefix) with the arrays of the runs; every run has all prefixes, in place."""
        for k, run in enumerate(runs):
            r = self._table(run).select("prefix", *[F.col(c).alias(f"r{k}_{c}") for c in _COLUMNS])
            first = first.join(r.hint("merge"), "prefix", "left")
        return first

    def _all(self) -> DataFrame:
        return self.spark.range(2**self.bits).select(F.col("id").cast("int").alias("prefix"))

    def ingest(self, batch: DataFrame) -> None:
        """Take in a batch of ``s string, m long, ts long, did long``; rows without ``m`` are no messages and stay out."""
        packed = self._keys(batch).groupBy("prefix").applyInArrow(_gathered, _RUN)
        rows = self._beside(self._all().join(packed.hint("shuffle_merge"), "prefix", "left"), self.runs)
        new = rows.groupBy("prefix").applyInArrow(_probe, _RUN)
        self._commit([*self.runs, self._write(new, 0)])
        level = 0
        while len(same := [r for r in self.runs if r["level"] == level]) >= self.merge_every:
            self._join(same, level + 1)
            level += 1

    def _join(self, runs: list[dict], level: int) -> None:
        merged = self._beside(self._table(runs[0]).select("prefix", *[F.col(c).alias(f"r{len(runs) - 1}_{c}") for c in _COLUMNS]), runs[1:])
        new = self._write(merged.groupBy("prefix").applyInArrow(_merge, _RUN), level)
        self._commit([*(r for r in self.runs if r not in runs), new])

    def merge(self) -> None:
        """Turn all runs into one."""
        if len(self.runs) > 1:
            self._join(self.runs, max(r["level"] for r in self.runs) + 1)

    def firsts(self) -> DataFrame:
        """``did``: the earliest delivery of each identifier."""
        self.merge()
        if not self.runs:
            return self.spark.createDataFrame([], "did long")
        return self.spark.read.schema(_RUN).parquet(f"{self.path}/{self.runs[0]['name']}").select("did").mapInArrow(_deliveries, "did long")


def _messages(posts: DataFrame) -> DataFrame:
    return posts.select(source_key(F.col("source")).alias("s"), F.col("telegram_message_id").cast("long").alias("m"), F.coalesce(F.unix_micros(F.col("exported_at").cast("timestamp")), F.lit(2**62)).alias("ts"), F.col("delivery_id").cast("long").alias("did"), F.coalesce(F.col("batch_id").cast("long"), F.lit(-1)).alias("batch"))


def index_deliveries(posts: DataFrame, waves: int = 4, path: str | None = None) -> DataFrame:
    """``did``: the first delivery of every message, by taking the export batches in ``waves`` of them, in their order.

    With ``path`` the index there takes in the deliveries, so later batches can be added in another session.
    """
    spark = posts.sparkSession
    m = _messages(posts)
    n, cuts = m.agg(F.count("*"), F.percentile_approx("batch", [k / waves for k in range(1, waves)] or [0.5], 1000)).first()
    index = DeliveryIndex(spark, n, path=path)
    bounds = [None, *sorted(set(cuts or [])), None] if waves > 1 else [None, None]
    for lo, hi in zip(bounds, bounds[1:]):
        part = m
        if lo is not None:
            part = part.where(F.col("batch") > lo)
        if hi is not None:
            part = part.where(F.col("batch") <= hi)
        index.ingest(part)
    return index.firsts()


def surplus_deliveries(posts: DataFrame, waves: int = 4) -> DataFrame:
    """``delivery_id`` of every delivery but the first of its message.

    First is the earliest ``exported_at`` (null counts as latest), then the smallest ``delivery_id``. Deliveries without
    a message id can't be told apart and are never surplus. Null sources are one source. Ids of deliveries are taken to
    be unique; further columns do not matter. An empty table gives no rows.
    """
    first = index_deliveries(posts, waves)
    return posts.where("telegram_message_id IS NOT NULL").select(F.col("delivery_id").cast("long").alias("delivery_id")).join(first, F.col("delivery_id") == F.col("did"), "left_anti")


def first_deliveries(posts: DataFrame, waves: int = 4) -> DataFrame:
    """The rows of ``posts`` without the surplus deliveries."""
    return posts.join(surplus_deliveries(posts, waves).withColumnRenamed("delivery_id", "_surplus"), F.col("delivery_id") == F.col("_surplus"), "left_anti")
