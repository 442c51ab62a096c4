"""Benchmark decontamination by greedy string tiling.

Windows of a few words that a text shares with a benchmark item, found by a
rolling Karp-Rabin hash, are the seeds; maximal matches grow from them, and the
longest that do not overlap are marked again and again. The share of the item's
words under tiles decides, so an item whose parts come in another order counts.

A text is judged where it lies: nothing is shuffled. The benchmark goes to the
tasks in blocks of bounded size, one pass over the texts for each block.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import settle, spare

#: Lower case for A-Z, a blank for every other ASCII character that is no letter or digit; bytes above stay.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: A word as ``plain_words`` finds it.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Tiling:
    """``seed`` words make a seed and the shortest tile; an item shorter than that is its own seed. ``cover`` is the
    share of an item's words from which a text counts as holding it. Items of fewer than ``least`` words are no passages:
    texts have them by chance. ``block_words`` is about what a pass carries; an item is never parted."""

    seed: int = 5
    cover: float = 0.8
    block_words: int = 500_000
    least: int = 5


def plain_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(PLAIN).split()


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes modulo 2 ** 64 of all windows of ``size`` ids."""
    h = np.zeros(max(0, len(ids) - size + 1), np.uint64)
    for i in range(size):
        h = h * FACTOR + ids[i : i + len(h)]
    return h


class Items:
    """A block of benchmark items, ready for lookup."""

    def __init__(self, rows: list[tuple], how: Tiling):
        self.how, self.vocabulary, self.items = how, {}, []
        windows = defaultdict(lambda: ([], [], []))
        for item_id, text in rows:
            words = plain_words(text.encode() if text else None)
            if not words:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint64)
            size = min(how.seed, len(ids))
            for value, places, owners in [windows[size]]:
                value.append(h := rolling(ids, size))
                places.append(np.arange(len(h)))
                owners.append(np.full(len(h), len(self.items)))
            self.items.append((item_id, ids))
        self.seeds = {}
        for size, columns in windows.items():
            value, place, owner = map(np.concatenate, columns)
            order = np.argsort(value, kind="stable")
            self.seeds[size] = value[order], place[order], owner[order]

    def covers(self, text: bytes | None) -> list[tuple]:
        """(item_id, words under tiles, words of the item) of the items that share a seed with the text."""
        words = plain_words(text)
        known = self.vocabulary
        ids = np.fromiter(map(known.get, words, repeat(0)), np.uint64, len(words))
        seeds: dict[int, list] = defaultdict(list)
        for size, (value, place, owner) in self.seeds.items():
            # Only windows whose words are all in some item can be seeds.
            foreign = np.concatenate(([0], np.cumsum(ids == 0)))
            at = np.flatnonzero(foreign[size:] == foreign[: len(foreign) - size]) if len(ids) >= size else np.empty(0, int)
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for i in range(size):
                h = h * FACTOR + ids[at + i]
            low, high = np.searchsorted(value, h), np.searchsorted(value, h, "right")
            for p, lo, hi in zip(at[high > low], low[high > low], high[high > low]):
                for k in range(lo, hi):
                    seeds[int(owner[k])].append((int(place[k]) - int(p), int(place[k])))
        found = []
        for owner, matches in seeds.items():
            item_id, item = self.items[owner]
            size = min(self.how.seed, len(item))
            # An item that would not reach the limit if all its seeds became tiles is not tiled.
            under = np.zeros(len(item), bool)
            for q in {q for _, q in matches}:
                under[q : q + size] = True
            if under.sum() >= self.how.cover * len(item):
                found.append((item_id, tiled(ids, item, matches, size), len(item)))
        return found


def tiled(text: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]], shortest: int) -> int:
    """Words of ``item`` under the tiles of greedy string tiling; ``seeds`` are (item place - text place, item place)."""
    runs = []  # maximal matches (length, item place, text place): seeds in a row on one diagonal
    last = None
    for diagonal, q in sorted(set(seeds)):
        if last and last[0] == diagonal and last[2] == q - 1:
            last[2] = q
        else:
            last = [diagonal, q, q]
            runs.append(last)
    matches = []
    for diagonal, q, end in runs:
        n, p = end - q + shortest, q - diagonal
        if np.array_equal(item[q : q + n], text[p : p + n]):  # a hash may collide
            matches.append((n, q, p))
    in_item, in_text = np.zeros(len(item), bool), defaultdict(bool)
    # The longest first; equal ones by place in the item, then in the text. What is partly marked comes back shorter.
    heap = [(-n, q, p) for n, q, p in matches]
    heapq.heapify(heap)
    while heap:
        n, q, p = heapq.heappop(heap)
        n = -n
        free = [not in_item[q + i] and not in_text[p + i] for i in range(n)]
        if all(free):
            for i in range(n):
                in_item[q + i] = in_text[p + i] = True
            if in_item.all():
                break
            continue
        start = None
        for i, ok in enumerate([*free, False]):
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                if i - start >= shortest:
                    heapq.heappush(heap, (start - i, q + start, p + start))
                start = None
    return int(in_item.sum())


def overlaps(docs: DataFrame, items: DataFrame, how: Tiling = Tiling()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash`` and ``leaks``, the items it holds with their coverage.

    ``items`` has ``item_id`` and ``text``. NULL and empty texts, and items
    of fewer than ``least`` words, match nothing. An item_id is returned once, as
    text, with the highest coverage of the texts it has, however many blocks
    the items make. No items, no leaks. Other columns are not looked at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    leak = "leaks array<struct<item_id:string,coverage:double>>"
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    words = F.regexp_count("text", F.lit(WORD)).alias("n")
    known = items.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    known = settle(known.select("*", words).filter(F.col("n") >= how.least), "tiling-items")
    blocks = -(-(known.agg(F.sum("n")).first()[0] or 0) // how.block_words)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    found = None
    for block in range(max(1, blocks)):
        rows = [tuple(r) for r in known.filter(place == block).select("item_id", "text").collect()]
        part = texts.mapInPandas(tiler(rows, how), f"doc_id {kind}, text_hash long, {leak}")
        found = part if found is None else found.union(part)
    if blocks > 1:
        # A pass found items of its own; put together for each text, then given to each row that has it.
        each = found.filter(F.size("leaks") > 0).select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_text"), F.inline("leaks"))
        each = each.groupBy("m_id", "m_text", "item_id").agg(F.max("coverage").alias("coverage"))
        merged = each.groupBy("m_id", "m_text").agg(F.sort_array(F.collect_list(F.struct("item_id", "coverage"))).alias("leaks"))
        own = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_text"))
        found = texts.drop("text").join(merged, own, "left").select(
            "doc_id", "text_hash", F.coalesce("leaks", F.array().cast(merged.schema["leaks"].dataType)).alias("leaks")
        )
    return found


def tiler(rows: list[tuple], how: Tiling):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = Items(rows, how)
        for batch in batches:
            leaks = []
            for text in batch["text"]:
                best: dict[str | None, float] = {}
                for i, n, of in items.covers(text) if items.items else []:
                    if n / of >= how.cover:
                        best[i] = max(best.get(i, 0), n / of)
                leaks.append([{"item_id": i, "coverage": best[i]} for i in sorted(best, key=lambda i: (i is not None, i or ""))])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "leaks": leaks})

    return run


def clean(docs: DataFrame, items: DataFrame, how: Tiling = Tiling()) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    b_id, b_text = (spare(docs.columns, n) for n in ("b_id", "b_text"))
    bad = overlaps(docs, items, how).filter(F.size("leaks") > 0).select(F.col("doc_id").alias(b_id), F.col("text_hash").alias(b_text))
    bad = settle(bad.distinct(), "tiling-leaks")
    from_bad = F.col("doc_id").eqNullSafe(F.col(b_id)) & (F.xxhash64("text") == F.col(b_text))
    return docs.join(bad, from_bad, "left_anti")


def op10(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = overlaps(docs, items)
    return found.select(
        "doc_id",
        F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.transform("leaks", lambda x: x.item_id), ",").alias("items"),
        F.coalesce(F.array_max(F.transform("leaks", lambda x: x.coverage)), F.lit(0.0)).alias("coverage"),
        (F.size("leaks") == 0).alias("kept"),
    )
