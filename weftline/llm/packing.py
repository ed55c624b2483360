"""Problem 8: filling containers of fixed capacity with documents.

Method: minimum bin slack over the multiset of remaining lengths. Only the histogram of lengths (at most one entry
per length up to the capacity) reaches the driver. There, again and again, the longest remaining length opens a
window; a bitset subset-sum over the remaining lengths and their counts finds the sum closest to the capacity, the
chosen multiset is traced back with counts, and the pattern is used as often as the counts allow. A pattern exhausts
at least one length each time, so there are at most as many patterns as lengths.

Documents then take their place in a pattern by their rank within their length. Ranks are found in two steps, in
hashed groups of bounded size and by offsets between the groups, so a length that most documents share is no hot key.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Where the vocabularies of the public tokenizers are, unless a path is given.
TOKENIZERS = os.environ.get("WEFTLINE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Documents of one length that are ranked in one group.
GROUP = 50_000

_loaded: dict[str, object] = {}


def encoder(path: str):
    """The byte-level tokenizer with the ranks in ``path``; loaded once per worker."""
    if path not in _loaded:
        import base64
        import importlib.util

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        spec = importlib.util.spec_from_file_location("_tokenizer_files", os.path.join(os.path.dirname(path), "__init__.py"))
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        _loaded[path] = tiktoken.Encoding("weftline", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], names=["doc_id", "n_tokens"])

    return run


def token_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id long, n_tokens int``; null text has no tokens."""
    path = path or os.path.join(TOKENIZERS, VOCABULARY)
    d = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return d.mapInArrow(_count(path), "doc_id long, n_tokens int")


def fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of remaining lengths with the sum closest to ``room``, longer lengths first among equal sums.

    Bit s of the set says that sum s can be reached; a length with count c is added in powers of two, so that the
    trace back needs one stored bitset per power.
    """
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []
    for w in lengths:
        left = min(counts[w], room // w) if w <= room else 0
        k = 1
        while left > 0:
            take = min(k, left)
            steps.append((w, take, reach))
            reach |= (reach << (w * take)) & mask
            if reach >> room & 1:
                left = 0
            left -= take
            k *= 2
        if reach >> room & 1:
            break
    s = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for w, take, before in reversed(steps):
        if not before >> s & 1:
            chosen[w] = chosen.get(w, 0) + take
            s -= w * take
    return chosen


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (lengths with counts) and how many containers use each; all documents of the histogram are placed."""
    counts = {w: c for w, c in histogram.items() if c > 0}
    out = []
    while counts:
        lengths = sorted(counts, reverse=True)
        longest = lengths[0]
        counts[longest] -= 1
        pattern = fill([w for w in lengths if counts[w]], counts, capacity - longest)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[w] // n for w, n in pattern.items())
        for w, n in pattern.items():
            counts[w] -= n * times
            if not counts[w]:
                del counts[w]
        out.append((pattern, times))
    return out


def pack(documents: DataFrame, capacity: int, doc_id: str = "doc_id", text: str = "text", path: str | None = None, counted: DataFrame | None = None, group: int = GROUP) -> DataFrame:
    """A container for every document: ``doc_id, piece, start_token, n_tokens, container``.

    A document longer than ``capacity`` fills containers of its own with whole pieces; its rest is placed like a
    document. Documents without tokens (null or empty text) go to container 0 with 0 tokens and take no space. Ids
    are taken to be unique; repeated ids are packed each. An empty table gives no rows. Containers are numbered from
    1; their numbers depend on the lengths and ids only.
    """
    tokens = counted if counted is not None else materialize(token_counts(documents, doc_id, text, path), "tokens")
    cap = F.lit(capacity)
    whole = F.floor(F.col("n_tokens") / cap).cast("int")
    items = tokens.where("n_tokens > 0").select("doc_id", (F.col("n_tokens") % cap).alias("size"), whole.alias("whole"))
    hist = {r["size"]: r["count"] for r in items.where("size > 0").groupBy("size").count().collect()}  # below capacity entries
    found = patterns(hist, capacity)

    # Where the documents of a length go: ranks [first, last) fall into containers from `base` on, `per` to each.
    placed: dict[int, int] = {}
    base, cells = 1, []
    for pattern, times in found:
        for w, n in pattern.items():
            first = placed.get(w, 0)
            cells.append((w, first, first + n * times, base, n))
            placed[w] = first + n * times
        base += times
    spark = tokens.sparkSession
    # One row per pattern and length: at most capacity**2 rows in theory, in practice a few per length.
    cells_df = spark.createDataFrame(cells or [(0, 0, 0, 0, 1)], "size int, first long, last long, base long, per int")

    rest = items.where("size > 0")
    salts = max(1, -(-sum(hist.values()) // group))
    salted = rest.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    sizes = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    offsets = sizes.withColumn("offset", F.sum("n").over(Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select("size", "salt", F.coalesce("offset", F.lit(0)).alias("offset"))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id")) - 1).join(offsets, ["size", "salt"]).select("doc_id", "size", "whole", (F.col("r") + F.col("offset")).alias("r"))
    joined = ranked.join(F.broadcast(cells_df) if len(cells) <= 200_000 else cells_df, "size").where("r >= first AND r < last")
    tail = joined.select("doc_id", F.col("whole").alias("piece"), (F.col("whole") * cap).alias("start_token"), F.col("size").alias("n_tokens"), (F.col("base") + F.floor((F.col("r") - F.col("first")) / F.col("per"))).alias("container"))

    # Whole pieces: numbered behind the others, by document; few and in groups again.
    long = items.where("whole > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    totals = long.groupBy("salt").agg(F.sum("whole").alias("n"))
    starts = totals.withColumn("offset", F.sum("n").over(Window.partitionBy().orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select("salt", F.coalesce("offset", F.lit(0)).alias("offset"))
    numbered = long.withColumn("before", F.sum("whole").over(Window.partitionBy("salt").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1))).join(starts, "salt")
    heads = numbered.select("doc_id", F.posexplode(F.sequence(F.lit(1), "whole")).alias("piece", "x"), (F.lit(base) + F.col("offset") + F.coalesce("before", F.lit(0))).alias("c0"))
    heads = heads.select("doc_id", "piece", (F.col("piece") * cap).alias("start_token"), cap.cast("int").alias("n_tokens"), (F.col("c0") + F.col("piece")).alias("container"))

    none = tokens.where("n_tokens <= 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).alias("start_token"), F.lit(0).alias("n_tokens"), F.lit(0).cast("long").alias("container"))
    return tail.unionByName(heads).unionByName(none).select("doc_id", "piece", "start_token", "n_tokens", F.col("container").cast("long").alias("container"))


def packing_report(packed: DataFrame, capacity: int) -> DataFrame:
    """Containers, tokens, unused space and the lower bound of containers."""
    t = packed.where("n_tokens > 0").agg(F.countDistinct("container").alias("containers"), F.sum("n_tokens").alias("tokens"))
    return t.select("containers", "tokens", (F.col("containers") * capacity - F.col("tokens")).alias("unused"), F.ceil(F.col("tokens") / capacity).alias("lower_bound"))
