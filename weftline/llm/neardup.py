"""Problem 4: near-duplicate records with small edits.

Method: MinHash banding. Every text is a set of distinct words; a signature of ``rows * bands`` minima is cut
into bands, band hashes are shuffled, records that share a band are candidates, and candidates are verified on
the full word sets. Row and band counts follow from the wanted recall at the threshold alone (``plan_bands``), so the
bytes and minima of a text are the same whatever the size of the collection.

How the data moves: one pass over the texts writes a slim table (id, message, class, size, bands, sketch). A
*class* is one distinct word set, so exact copies cost one member per band. Band entries travel as packed blobs,
one per (task, target), not as rows. An entry has the word count and 120 sketch bits: the members of a band hash stand in
the order of their word counts, each meets only those whose count the threshold allows, and the bits drop most chance
candidates where they arise.

A band hash with very many members (a phrase that a third of all texts have) is found by a count over all tasks. Its
members don't meet by it; they meet by the hash together with a further half band, one of ``HALVES``, which pairs at
the threshold share nearly surely in one of them. What is hot even then is cut into blocks that meet one another in
different targets, so no link is lost and no task is large. Candidates are thinned by a 256-bit sketch (one bit per
minimum, 4.5 standard deviations under the expected agreement) before the exact check, which reads only surviving texts
again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, partitions_for
from .canonical import canonical_sql, duckdb_batches, words_sql
from .lookalike import source_key

#: Members of a band hash beyond which it is refined, and members per block of what is hot even then.
HOT = 20_000
#: Half bands that refine a hot band: with three rows each, at a similarity of 0.7, a pair shares one of eleven with 0.99.
HALVES = 12
#: Hot hashes that may be broadcast (12 bytes each); ``HOT`` grows with what would make them more.
LISTED = 4_000_000
#: Survivor ids that may be broadcast (8 bytes each); beyond it they are joined by shuffle.
BROADCAST_IDS = 200_000


@dataclass(frozen=True)
class Bands:
    rows: int
    bands: int
    threshold: float


def plan_bands(threshold: float, recall: float, rows: int = 6) -> Bands:
    """As many bands of ``rows`` rows as give the recall at the threshold; independent of the collection."""
    return Bands(rows, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), threshold)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def signature(values: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """``k`` minima (uint32) per set; the sets are consecutive slices of ``values`` and not empty."""
    rng = np.random.default_rng(20250101)
    a = rng.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 2**32, k, dtype=np.uint32)
    # Words are hashes already; 32 bits of them under odd multipliers are permutations that numpy does in vectors.
    words = (values >> np.uint64(32)).astype(np.uint32)
    moved, out = np.empty_like(words), np.empty((k, len(starts)), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(k):
            np.multiply(words, a[i], out=moved)
            np.add(moved, b[i], out=moved)
            np.minimum.reduceat(moved, starts, out=out[i])
    return np.ascontiguousarray(out.T)


def band_hashes(sig: np.ndarray, plan: Bands) -> np.ndarray:
    """One uint32 per band; with the band's number it is the key that is shuffled."""
    h = np.empty((len(sig), plan.bands), np.uint32)
    with np.errstate(over="ignore"):
        for b in range(plan.bands):
            x = np.full(len(sig), b + 1, np.uint64)
            for r in range(plan.rows):
                x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * plan.rows + r])
            h[:, b] = (x >> np.uint64(32)).astype(np.uint32)
    return h


def half_hashes(sig: np.ndarray, plan: Bands) -> np.ndarray:
    """One uint32 for the first half of the rows of each of the first ``HALVES`` bands."""
    k = min(HALVES, plan.bands)
    return band_hashes(np.concatenate([sig[:, b * plan.rows : b * plan.rows + (plan.rows + 1) // 2] for b in range(k)], axis=1), Bands((plan.rows + 1) // 2, k, plan.threshold))


def sketch(sig: np.ndarray) -> np.ndarray:
    """Four int64 of one bit of each of the first 256 minima (fewer minima are repeated)."""
    cols = np.resize(np.arange(sig.shape[1]), 256)
    bits = ((_mix(sig[:, cols].astype(np.uint64)) >> np.uint64(40)) & np.uint64(1)).astype(np.uint8)
    return np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.int64).reshape(-1, 4)


def _set_class(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, whatever the order of its members."""
    with np.errstate(over="ignore"):
        s = np.add.reduceat(_mix(values), starts)
        x = np.bitwise_xor.reduceat(_mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
        return _mix(s * np.uint64(0x9E3779B97F4A7C15) ^ x ^ sizes.astype(np.uint64)).view(np.int64)


_SETS = "list_transform(list_distinct({w}), lambda x: hash(x))"


def _slim(plan: Bands, least: int):
    """Arrow pass: (src, id, msg, text) -> the slim table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sql = f"SELECT src, id, msg, {_SETS.format(w=words_sql())} AS ws FROM ({canonical_sql('batch', 'text', 'src, id, msg')})"
        for b in duckdb_batches(f"SELECT * FROM ({sql}) WHERE len(ws) >= {least}", batches):
            if not b.num_rows:
                continue
            ws = b.column(3)
            values = ws.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            sizes = ws.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            sig = signature(values, starts, plan.rows * plan.bands)
            bands = np.concatenate([band_hashes(sig, plan), half_hashes(sig, plan)], axis=1)
            sk = sketch(sig)
            blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * bands.shape[1]), len(sig), [None, pa.py_buffer(np.ascontiguousarray(bands))]).cast(pa.binary())
            cols = [b.column(0), b.column(1), b.column(2), pa.array(_set_class(values, starts, sizes)), pa.array(sizes.astype(np.int32)), blob, *(pa.array(np.ascontiguousarray(sk[:, i])) for i in range(4))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(_code(sizes, sk[:, 0]))], names=["src", "id", "msg", "cls", "n", "bands", "s0", "s1", "s2", "s3", "code"])

    return run


_SLIM = "src string, id long, msg long, cls long, n int, bands binary, s0 long, s1 long, s2 long, s3 long, code long"


def _salted(h: np.ndarray, salt: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(h + (salt.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _unpack(b: pa.RecordBatch, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct classes of a batch, their codes (two numbers each), their band keys (uint64), and their half bands."""
    cls, code, more = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
    code = np.stack([code, more], 1)
    flat = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint32).reshape(len(cls), -1)
    _, first = np.unique(cls, return_index=True)
    keys = _mix(flat[first, :bands].astype(np.uint64) + (np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32)))
    return cls[first], code[first], keys, flat[first, bands:]


def _among(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among the sorted keys, and the place of those."""
    if not len(keys):
        return np.zeros(len(values), bool), np.array([], np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    found = keys[at] == values
    return found, at[found]


def _keys(unpacked: tuple[np.ndarray, ...], bands: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys that are not hot with their rows; and refined keys, one per half band of another band, with theirs."""
    cls, _, keys, halves = unpacked
    h, row = keys.ravel(), np.repeat(np.arange(len(cls)), bands)
    is_hot, _ = _among(h, hot)
    if not is_hot.any():
        return h, row, h[:0], row[:0]
    k = halves.shape[1]
    band, r = np.tile(np.arange(bands), len(cls))[is_hot], row[is_hot]
    v = np.tile(np.arange(k), len(r))
    band, r, x = np.repeat(band, k), np.repeat(r, k), np.repeat(h[is_hot], k)
    other = v != band
    fine = _salted(x[other], (halves[r[other], v[other]].astype(np.uint64) << np.uint64(8)) + v[other].astype(np.uint64))
    return h[~is_hot], row[~is_hot], fine, r[other]


#: Keys of a task that are counted together (a batch more at most).
CHUNK = 4_000_000


def _local_counts(bands: int, least: int, hot=None):
    """Arrow pass: counts of the band keys (of the refined ones, if ``hot`` is given) of each chunk, those of ``least`` and more."""

    def count(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h[n >= least].view(np.int64)), pa.array(n[n >= least])], names=["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                got = _unpack(b, bands)
                held.append(got[2].ravel() if hot is None else _keys(got, bands, hot.value)[2])
                size += len(held[-1])
                if size >= CHUNK:
                    yield count(held)
                    held, size = [], 0
        if held:
            yield count(held)

    return run


def hot_bands(entries: DataFrame, bands: int, records: int, hot: int, known=None) -> dict[int, int]:
    """Blocks of every key with more than ``hot`` members in ``cls, code, more, bands``, and perhaps of some with half as many.

    Band keys, or, with the broadcast hot ones ``known``, the refined keys of those. A chunk keeps back less than
    hot / 2 / chunks of a key, so all chunks together less than hot / 2, which is added.
    """
    per = bands * (1 if known is None else HALVES)
    chunks = entries._jdf.queryExecution().toRdd().getNumPartitions() + records * per // CHUNK
    least = max(1, hot // (2 * max(1, chunks)))
    n = F.sum("n") + chunks * (least - 1)
    counts = entries.mapInArrow(_local_counts(bands, least, known), "h long, n long").groupBy("h").agg(n.alias("n")).where(F.col("n") > hot)
    return {r.h: math.ceil(r.n / hot) for r in counts.collect()}  # at most 2 * records * per / hot entries: LISTED


def _packed(found: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their blocks."""
    keys, blocks = np.array(list(found), np.int64).view(np.uint64), np.array(list(found.values()), np.int64)
    order = np.argsort(keys)
    return keys[order], blocks[order]


#: What travels per band and class: the low half of the key, the class, and its code.
_ENTRY = np.dtype([("h", "<u4"), ("code", "<i8"), ("more", "<i8"), ("cls", "<i8")])


def _scatter(bands: int, targets: int, hot, fine):
    """Arrow pass: slim rows -> (target, packed entries) blobs. ``hot``: sorted band keys; ``fine``: refined keys, blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            got = _unpack(b, bands)
            cls, code = got[0], got[1]
            h, row, x, r = _keys(got, bands, hot.value)
            if len(x):
                keys, blocks = fine.value
                split, at = _among(x, keys)
                k = blocks[at]
                s, y, i = (_mix(cls[r[split]].view(np.uint64)) % k.astype(np.uint64)).astype(np.int64), x[split], r[split]
                s, y, i, size = (np.repeat(z, k) for z in (s, y, i, k))
                t = np.arange(len(s)) - np.repeat(np.cumsum(k) - k, k)  # a member of block s meets every block t: key (s, t)
                h = np.concatenate([h, x[~split], _salted(y, np.minimum(s, t) * size + np.maximum(s, t))])
                row = np.concatenate([row, r[~split], i])
            to = ((h >> np.uint64(33)) % np.uint64(targets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            to, row = to[order], row[order]
            packed = np.empty(len(to), _ENTRY)
            packed["h"], packed["code"], packed["more"], packed["cls"] = h[order].astype(np.uint32), code[row, 0], code[row, 1], cls[row]
            cuts = np.flatnonzero(np.diff(to)) + 1
            yield pa.RecordBatch.from_arrays([pa.array(to[np.concatenate([[0], cuts])]), pa.array([p.tobytes() for p in np.split(packed, cuts)], pa.binary())], names=["target", "blob"])

    return run


def _pairs_of(h: np.ndarray, size: np.ndarray, threshold: float, step: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs with equal hash and sizes that the threshold allows, in portions.

    Members are sorted by hash and then size (255 and more are one size), so a member's partners stand right behind it.
    """
    n = len(h)
    if n < 2:
        return
    key = (h.astype(np.uint64) << np.uint64(8)) + size.astype(np.uint64)
    most = np.where(size < 255, np.minimum((size + 1e-6) / threshold, 255), 255).astype(np.uint64)
    left = np.searchsorted(key, (h.astype(np.uint64) << np.uint64(8)) + most, "right") - np.arange(n) - 1
    members = np.flatnonzero(left > 0)
    at = 0
    while at < len(members):
        total = np.cumsum(left[members[at : at + step]])
        take = max(1, int(np.searchsorted(total, step)))
        m = members[at : at + take]
        k = left[m]
        a = np.repeat(m, k)
        yield a, a + 1 + (np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
        at += take


def _code(n: np.ndarray, s0: np.ndarray) -> np.ndarray:
    """Eight bytes: the size (255 and more alike) and 56 bits of the sketch."""
    return (np.minimum(n, 255).astype(np.int64) << np.int64(56)) | (s0 & np.int64((1 << 56) - 1))


def _gather(threshold: float):
    """Arrow pass: all blobs of a target -> candidate pairs of classes that sizes and 120 bits don't rule out."""
    most = 120 * (1 - _agreement(threshold, 120))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for b in batches for x in b.column(1).to_pylist()]
        if not blobs:
            return
        flat = np.frombuffer(b"".join(blobs), _ENTRY)
        del blobs
        h, cls, size = flat["h"], flat["cls"], (flat["code"].view(np.uint64) >> np.uint64(56)).astype(np.int16)
        order = np.lexsort((cls, size, h))
        again = np.concatenate([[False], (h[order[1:]] == h[order[:-1]]) & (cls[order[1:]] == cls[order[:-1]])])  # one class from several batches
        order = order[~again]
        h, cls, size = h[order], cls[order], size[order]
        bits, more = flat["code"].view(np.uint64)[order] & np.uint64((1 << 56) - 1), flat["more"].view(np.uint64)[order]
        for a, b in _pairs_of(h, size, threshold):
            ok = np.bitwise_count(bits[a] ^ bits[b]) + np.bitwise_count(more[a] ^ more[b]) <= most
            a, b = cls[a[ok]], cls[b[ok]]
            pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pair[:, k])) for k in (0, 1)], names=["a", "b"])

    return run


def _agreement(threshold: float, bits: int, sigmas: float = 4.5) -> float:
    """Share of equal sketch bits that a pair at the threshold falls short of once in some 300,000 cases."""
    p = (1 + threshold) / 2
    return p - sigmas * math.sqrt(p * (1 - p) / bits)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sql = f"SELECT cls, list_transform({_SETS.format(w=words_sql())}, lambda x: x::BIGINT) AS ws FROM ({canonical_sql('batch', 'text', 'cls')})".replace("hash(x)", "(hash(x) >> 1)")
    yield from duckdb_batches(sql, batches)


def near_duplicates(texts: DataFrame, threshold: float, least: int, recall: float = 0.99, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Links between distinct word sets, and the membership of rows in them.

    ``texts``: ``src string, id long, msg long, text string``. Returns ``(links, members)``: ``links`` has
    ``src, a, b, similarity`` with a < b (classes), ``members`` has ``src, id, msg, cls``. Null and blank texts,
    and texts with fewer than ``least`` distinct words, are in neither. Equal word sets are one class, so exact
    copies need no links. Sources are never linked with one another. Empty tables give empty results.
    """
    spark = texts.sparkSession
    texts = texts.where(F.col("text").isNotNull())
    records = texts.count()
    plan = plan_bands(threshold, recall)
    slim = materialize(texts.mapInArrow(_slim(plan, least), _SLIM), "neardup")
    members = slim.select("src", "id", "msg", "cls")

    # Classes are named within their source, so that the sources stay apart.
    entries = slim.select(F.xxhash64("src", "cls").alias("cls"), "code", F.col("s1").alias("more"), "bands")
    hot = max(hot, 2 * HALVES * records * plan.bands // LISTED)
    share = spark.sparkContext.broadcast
    known = share(_packed(hot_bands(entries, plan.bands, records, hot))[0])
    fine = share(_packed(hot_bands(entries, plan.bands, records, hot, known) if len(known.value) else {}))
    targets = partitions_for(spark, records * plan.bands, 600_000)
    cand = entries.mapInArrow(_scatter(plan.bands, targets, known, fine), "target int, blob binary").repartitionById(targets, F.col("target")).mapInArrow(_gather(threshold), "a long, b long").distinct()

    classes = slim.groupBy(F.xxhash64("src", "cls").alias("u")).agg(F.min(F.struct("src", "cls", "n", "s0", "s1", "s2", "s3", "id")).alias("x")).select("u", "x.*")
    side = lambda p, k: classes.select(F.col("u").alias(k), *[F.col(c).alias(f"{p}{c}") for c in ("src", "cls", "n", "s0", "s1", "s2", "s3", "id")])
    agree = _agreement(threshold, min(256, plan.rows * plan.bands))
    unequal = sum((F.bit_count(F.col(f"x{s}").bitwiseXOR(F.col(f"y{s}"))) for s in ("s0", "s1", "s2", "s3")), F.lit(0))
    near = cand.join(side("x", "a"), "a").join(side("y", "b"), "b").where((F.least("xn", "yn") >= F.greatest("xn", "yn") * (threshold - 1e-9)) & (unequal <= (1 - agree) * 256) & (F.col("xsrc") == F.col("ysrc")))
    near = materialize(near.select(F.col("xsrc").alias("src"), "xcls", "xid", "ycls", "yid"), "neardup-near")

    # Exact check: read again only the texts of classes that still have a partner.
    wanted = near.select("src", F.col("xid").alias("id"), F.col("xcls").alias("cls")).union(near.select("src", F.col("yid").alias("id"), F.col("ycls").alias("cls"))).distinct()
    wanted = materialize(wanted, "neardup-wanted")
    few = wanted.count() <= BROADCAST_IDS
    again = texts.select("src", "id", "text").join(F.broadcast(wanted) if few else wanted, ["src", "id"]).select(F.xxhash64("src", "cls").alias("u"), F.col("cls"), "text")
    sets = again.select(F.col("u").alias("cls"), "text").mapInArrow(_sets, "cls long, ws array<long>")
    key = near.select("src", F.col("xcls"), F.col("ycls"), F.xxhash64("src", "xcls").alias("u"), F.xxhash64("src", "ycls").alias("v"))
    full = key.join(sets.select(F.col("cls").alias("u"), F.col("ws").alias("wa")), "u").join(sets.select(F.col("cls").alias("v"), F.col("ws").alias("wb")), "v")
    both = F.size(F.array_intersect("wa", "wb"))
    full = full.select("src", F.least("xcls", "ycls").alias("a"), F.greatest("xcls", "ycls").alias("b"), (both / (F.size("wa") + F.size("wb") - both)).alias("similarity"))
    return materialize(full.where(F.col("similarity") >= threshold), "neardup-links"), members


def row_pairs(links: DataFrame, members: DataFrame, block: int = 5_000) -> DataFrame:
    """Pairs of rows (``src, id_a, id_b``) of different messages, from links between classes and equal classes.

    Large classes are split into blocks of rows, so that no task holds all copies of one text.
    """
    counted = members.groupBy("src", "cls").agg(F.count("*").alias("c"))
    both = links.select("src", F.col("a"), F.col("b")).union(counted.where("c > 1").select("src", F.col("cls").alias("a"), F.col("cls").alias("b")))
    blocks = counted.select("src", "cls", F.ceil(F.col("c") / block).cast("int").alias("k"))
    rows = members.join(blocks, ["src", "cls"]).withColumn("g", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    both = both.join(blocks.select("src", F.col("cls").alias("a"), F.col("k").alias("ka")), ["src", "a"]).join(blocks.select("src", F.col("cls").alias("b"), F.col("k").alias("kb")), ["src", "b"])
    cells = both.withColumn("ga", F.explode(F.sequence(F.lit(0), F.col("ka") - 1))).withColumn("gb", F.explode(F.sequence(F.lit(0), F.col("kb") - 1)))
    x = rows.select("src", F.col("cls").alias("a"), F.col("g").alias("ga"), F.col("id").alias("i"), F.col("msg").alias("mi"))
    y = rows.select("src", F.col("cls").alias("b"), F.col("g").alias("gb"), F.col("id").alias("j"), F.col("msg").alias("mj"))
    out = cells.join(x, ["src", "a", "ga"]).join(y, ["src", "b", "gb"]).where((F.col("mi") != F.col("mj")) & ((F.col("a") != F.col("b")) | (F.col("i") < F.col("j"))))
    return out.select("src", F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"))


def groups(links: DataFrame, members: DataFrame) -> DataFrame:
    """``src, id, group_id, links``: the connected group of every row and the number of links of its text.

    ``group_id`` is the smallest row id of the group. Labels spread along links and jump through their own label,
    so the rounds grow with the logarithm of a group's width; they end when no label changes. Each round is written to
    the shared folder in place of the one before.
    """
    nodes = materialize(members.groupBy("src", "cls").agg(F.min("id").alias("label")), "neardup-label")
    edges = links.select("src", F.col("a").alias("x"), F.col("b").alias("y")).union(links.select("src", F.col("b"), F.col("a")))
    label = nodes
    while True:
        near = edges.join(label.select("src", F.col("cls").alias("y"), "label"), ["src", "y"]).groupBy("src", F.col("x").alias("cls")).agg(F.min("label").alias("m"))
        step = label.join(near, ["src", "cls"], "left").select("src", "cls", "label", F.least("label", F.coalesce("m", "label")).alias("new"))
        hooks = step.where("new < label").groupBy("src", F.col("label").alias("old")).agg(F.min("new").alias("root"))
        step = step.select("src", "cls", F.col("label").alias("was"), F.col("new").alias("old")).join(hooks, ["src", "old"], "left")
        nxt = materialize(step.select("src", "cls", "was", F.coalesce("root", "old").alias("label")), "neardup-label")
        discard(nodes)
        nodes, label = nxt, nxt.select("src", "cls", "label")
        if nxt.where("was <> label").limit(1).count() == 0:
            break
    degree = edges.groupBy("src", F.col("x").alias("cls")).agg(F.count("*").alias("links"))
    out = members.join(label, ["src", "cls"]).join(degree, ["src", "cls"], "left")
    return out.select("src", "id", F.col("label").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))


def texts_of(posts: DataFrame | None, candidates: DataFrame | None) -> DataFrame:
    """The input of ``near_duplicates`` from the two tables."""
    parts = []
    if posts is not None:
        parts.append(posts.select(F.lit("raw_telegram_posts").alias("src"), F.col("delivery_id").cast("long").alias("id"), F.xxhash64(source_key(F.col("source")), F.col("telegram_message_id").cast("long")).alias("msg"), "text"))
    if candidates is not None:
        parts.append(candidates.select(F.lit("candidates").alias("src"), F.col("id").cast("long").alias("id"), F.xxhash64(F.col("id").cast("long")).alias("msg"), "text"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
