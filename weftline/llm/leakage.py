"""Problem 9: passages of evaluation texts inside the corpus.

Method: suffix arrays over shards of the corpus. A task gathers documents into shards of about a million words and sorts
the shard's suffixes in full, by prefix doubling: each step doubles the words that count and sorts again only suffixes
that are still equal to others, until none is or they are equal to their documents' ends. Every suffix of every test item
is binary-searched in it, word by word, so a passage that stands a thousand times in a shard is one range of the array. A
range is expanded only where a match can't be extended to the left, to the longest verbatim matches; for the pairs of
documents and items each range counts once, with its distinct documents and its distinct items.

The corpus is only scanned: nothing of it is shuffled. Test items are broadcast in blocks of bounded size; if there are
several blocks, the shards are sorted once, written, and searched for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .canonical import duckdb_batches

#: Words of test items broadcast at once (8 bytes each).
BLOCK_WORDS = 4_000_000
#: Words of a shard; a longer document is a shard of its own.
SHARD_WORDS = 1_000_000


def plain_words_sql(text: str) -> str:
    """DuckDB SQL: hashes of the runs of letters and digits in lower case; tags, targets of links and invisible characters are none."""
    seen = f"CASE WHEN regexp_matches({text}, '[\\x{{00AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]') THEN regexp_replace({text}, '[\\x{{00AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g') ELSE {text} END"
    tags = f"CASE WHEN contains({text}, '<') THEN regexp_replace({seen}, '</?[A-Za-z][^<>]*>', ' ', 'g') ELSE {seen} END"
    tags = f"CASE WHEN contains({text}, '](') THEN regexp_replace({tags}, '\\]\\([^()\\s]*\\)', '] ', 'g') ELSE {tags} END"
    composed = f"CASE WHEN regexp_matches({text}, '\\p{{M}}') THEN nfc_normalize({tags}) ELSE {tags} END"
    return f"list_transform(regexp_extract_all(lower({composed}), '[\\p{{L}}\\p{{N}}]+'), lambda x: hash(x))"


@dataclass
class Items:
    """Test items as one sequence of word hashes."""

    ids: np.ndarray  # item of each word
    words: np.ndarray
    ends: np.ndarray  # end of its item, for each word


class Shard:
    """All suffixes of a shard in order; a suffix ends with its document, and what ends first comes first."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, order: np.ndarray | None = None):
        self.words, self.sizes = words, sizes
        self.vocabulary, rank = np.unique(words, return_inverse=True)
        self.rank = rank.astype(np.int32)
        stop = np.cumsum(sizes)
        self.starts, self.ends = np.repeat(stop - sizes, sizes), np.repeat(stop, sizes)
        self.suffixes = self._sort() if order is None else order
        before = self.suffixes - 1
        #: The word before each suffix, -2 where its document begins; and where that changes along the array.
        self.left = np.where(self.suffixes > self.starts[self.suffixes], self.rank[before], -2) if len(words) else self.rank
        self.changes = np.concatenate([[0], np.cumsum(self.left[1:] != self.left[:-1])]) if len(words) else self.left

    def _sort(self) -> np.ndarray:
        n = len(self.words)
        order = np.argsort(self.rank, kind="stable")
        sorted_rank = self.rank[order]
        new = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]]) if n else np.array([], bool)
        # A suffix's rank is the first place of its class, so refined classes keep the places of what they were.
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        width, places = 1, np.arange(n)
        single = new & np.concatenate([new[1:], [True]]) if n else new
        places = places[~single]
        while len(places):
            at = order[places]
            nxt = at + width
            behind = np.where(nxt < self.ends[at], rank[np.minimum(nxt, n - 1)] + 1, 0)
            key = rank[at] * (n + 1) + behind
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            order[places] = at
            first = np.maximum.accumulate(np.where(new, places, 0))
            if np.array_equal(first, rank[at]):  # nothing was told apart: the rest is equal to the documents' ends
                break
            rank[at] = first
            single = new & np.concatenate([new[1:], [True]])
            places = places[~single]
            width *= 2
        return order

    def _bisect(self, lo: np.ndarray, hi: np.ndarray, k: int, target: np.ndarray, right: bool) -> np.ndarray:
        """The first place in [lo, hi) whose suffix has at word ``k`` no less than the target (more, if ``right``)."""
        lo, hi = lo.copy(), hi.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            at = self.suffixes[mid] + k
            value = np.where(at < self.ends[self.suffixes[mid]], self.rank[np.minimum(at, len(self.rank) - 1)], -1)
            below = value <= target[open_] if right else value < target[open_]
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def search(self, q: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts in ``q`` whose ``depth`` words the shard has, their ranges of the array, and ``q`` in the shard's ranks."""
        if not len(q) or not len(self.words):
            return (np.array([], np.int64),) * 4
        at = np.minimum(np.searchsorted(self.vocabulary, q), len(self.vocabulary) - 1)
        ranks = np.where(self.vocabulary[at] == q, at, -1)
        missing = np.concatenate([[0], np.cumsum(ranks < 0)])
        i = np.arange(len(q))
        i = i[i + depth <= ends]
        i = i[missing[i + depth] == missing[i]]
        lo, hi = np.zeros(len(i), np.int64), np.full(len(i), len(self.words), np.int64)
        for k in range(depth):
            target = ranks[i + k]
            lo, hi = self._bisect(lo, hi, k, target, False), self._bisect(lo, hi, k, target, True)
            kept = lo < hi
            i, lo, hi = i[kept], lo[kept], hi[kept]
        return i, lo, hi, ranks


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, and the range of each."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _matches(items: Items, shard: Shard, depth: int, step: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal matches: start in the items, start in the shard, length."""
    q, lo, hi, ranks = shard.search(items.words, items.ends, depth)
    if not len(q):
        return (np.array([], np.int64),) * 3
    first = np.concatenate([[True], items.ids[1:] != items.ids[:-1]])[q]
    left = np.where(first, -1, ranks[np.maximum(q - 1, 0)])  # -1 is no word of the shard
    # Where all of a range have the word before that the item has, longer matches tell it all.
    told = (shard.changes[lo] == shard.changes[hi - 1]) & (shard.left[lo] == left)
    q, lo, hi, left = q[~told], lo[~told], hi[~told], left[~told]
    which, place = _expand(lo, hi)
    kept = shard.left[place] != left[which]
    qs, ps = q[which[kept]], shard.suffixes[place[kept]]
    length = np.full(len(qs), depth, np.int64)
    live, ahead = np.arange(len(qs)), np.arange(step)
    while len(live):
        a, b = (qs[live] + length[live])[:, None] + ahead, (ps[live] + length[live])[:, None] + ahead
        ok = (a < items.ends[qs[live]][:, None]) & (b < shard.ends[ps[live]][:, None])
        ok &= ranks[np.minimum(a, len(ranks) - 1)] == shard.rank[np.minimum(b, len(shard.rank) - 1)]
        more = np.where(ok.all(1), step, ok.argmin(1))
        length[live] += more
        live = live[more == step]
    return qs, ps, length


def _pairs(items: Items, shard: Shard, docs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and items that share ``depth`` words: each range once, with its distinct documents and items."""
    q, lo, hi, _ = shard.search(items.words, items.ends, depth)
    if not len(q):
        return np.array([], np.int64), np.array([], np.int64)
    of = np.repeat(np.arange(len(shard.sizes)), shard.sizes)
    key, index = np.unique(lo, return_index=True)
    which, place = _expand(lo[index], hi[index])
    d = np.unique(np.stack([which, of[shard.suffixes[place]]], 1), axis=0)  # documents of each range
    t = np.unique(np.stack([np.searchsorted(key, lo), items.ids[q]], 1), axis=0)  # items of each range
    count = np.bincount(t[:, 0], minlength=len(key))
    begin = np.cumsum(count) - count
    rep, at = _expand(begin[d[:, 0]], begin[d[:, 0]] + count[d[:, 0]])
    pair = np.unique(np.stack([d[rep, 1], t[at, 1]], 1), axis=0)
    return docs[pair[:, 0]], pair[:, 1]


def _gathered(shard_words: int):
    """Arrow pass: (id, text) -> shards (ids, sizes, words, order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Shard]]:
        def out(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, Shard]:
            ids, sizes, words = (np.concatenate(x) for x in zip(*parts))
            return ids, Shard(words, sizes)

        parts, total = [], 0
        for b in duckdb_batches(f"SELECT id, {plain_words_sql('text')} AS ws FROM batch", batches):
            if not b.num_rows:
                continue
            sizes = b.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            words = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            ids = b.column(0).to_numpy(zero_copy_only=False)
            # A batch is cut into shards at documents.
            at, cum = 0, np.cumsum(sizes)
            while at < len(ids):
                base = cum[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(cum, base + shard_words - total, "right")))
                parts.append((ids[at:to], sizes[at:to], words[base : cum[to - 1]]))
                total += int(cum[to - 1] - base)
                at = to
                if total >= shard_words:
                    yield out(parts)
                    parts, total = [], 0
        if parts:
            yield out(parts)

    return run


_SHARD = "ids binary, sizes binary, words binary, suffixes binary"


def _packed_shards(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, s in _gathered(shard_words)(batches):
            cols = [pa.array([x.tobytes()], pa.binary()) for x in (ids.astype("<i8"), s.sizes.astype("<i8"), s.words.astype("<u8"), s.suffixes.astype("<i4"))]
            yield pa.RecordBatch.from_arrays(cols, names=["ids", "sizes", "words", "suffixes"])

    return run


def _found(ids: np.ndarray, shard: Shard, own: Items, depth: int, pairs: bool) -> pa.RecordBatch:
    if pairs:
        d, i = _pairs(own, shard, ids, depth)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(i)], names=["doc_id", "item_id"])
    q, p, n = _matches(own, shard, depth)
    begin = np.maximum.accumulate(np.where(np.concatenate([[True], own.ids[1:] != own.ids[:-1]]), np.arange(len(own.ids)), 0)) if len(own.ids) else own.ends
    docs = np.repeat(ids, shard.sizes)
    return pa.RecordBatch.from_arrays([pa.array(docs[p]), pa.array(own.ids[q]), pa.array((p - shard.starts[p]).astype(np.int32)), pa.array((q - begin[q]).astype(np.int32)), pa.array(n.astype(np.int32))], names=["doc_id", "item_id", "doc_word", "item_word", "n_words"])


def _scan(items, depth: int, shard_words: int, pairs: bool):
    """Arrow pass: documents, sorted and searched at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, shard in _gathered(shard_words)(batches):
            yield _found(ids, shard, items.value, depth, pairs)

    return run


def _scan_packed(items, depth: int, pairs: bool):
    """Arrow pass: written shards, searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                ids, sizes, words, order = (np.frombuffer(b.column(c)[k].as_py(), t) for c, t in enumerate(("<i8", "<i8", "<u8", "<i4")))
                yield _found(ids, Shard(words, sizes, order.astype(np.int64)), items.value, depth, pairs)

    return run


def _search(documents: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str, words: int, block_words: int, shard_words: int, pairs: bool) -> DataFrame:
    spark = documents.sparkSession
    docs = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    its = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull() & F.col(item_id).isNotNull())
    sizes = its.select(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-sizes // (2 * block_words)) or 1  # a word and its blank have two characters at least
    schema = "doc_id long, item_id long" + ("" if pairs else ", doc_word int, item_word int, n_words int")
    shards = materialize(docs.mapInArrow(_packed_shards(shard_words), _SHARD), "shards") if blocks > 1 else None
    found = None
    for k in range(blocks):
        part = its if blocks == 1 else its.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k)
        rows = part.mapInArrow(lambda it: duckdb_batches(f"SELECT id, list_transform({plain_words_sql('text')}, lambda h: h::VARCHAR) AS ws FROM batch", it), "id long, ws array<string>").collect()
        rows = [(r.id, [int(x) for x in r.ws]) for r in rows if r.ws]
        n = np.array([len(w) for _, w in rows], np.int64)
        own = spark.sparkContext.broadcast(Items(np.repeat(np.array([i for i, _ in rows], np.int64), n), np.array([x for _, w in rows for x in w], np.uint64), np.repeat(np.cumsum(n), n)))
        got = docs.mapInArrow(_scan(own, words, shard_words, pairs), schema) if shards is None else shards.mapInArrow(_scan_packed(own, words, pairs), schema)
        found = got if found is None else found.unionByName(got)
    return found


def leaked_passages(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", words: int = 12, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Longest verbatim matches of at least ``words`` words between documents and test items.

    Gives ``doc_id long, item_id long, doc_word int, item_word int, n_words int``: one row per match that can be
    extended on neither side; positions count words from 0. Null and empty texts match nothing; texts shorter than
    ``words`` match nothing; equal items are reported each. Empty tables give no rows. If the items together hold
    more than ``block_words`` words, they are searched in several blocks.
    """
    return _search(documents, items, doc_id, item_id, text, words, block_words, shard_words, False)


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", words: int = 12, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, item_id``, each pair once; a shard gives a pair once, so the shuffle is small."""
    return _search(documents, items, doc_id, item_id, text, words, block_words, shard_words, True).distinct()


def without_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", **how) -> DataFrame:
    """The documents that hold no passage of a test item."""
    found = leaks(documents, items, doc_id=doc_id, **how).select(F.col("doc_id").alias(doc_id)).distinct()
    return documents.join(found, doc_id, "left_anti")
