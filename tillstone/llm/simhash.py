"""SimHash near-duplicates by pivot distance tables.

Every distinct fingerprint gets a table of its Hamming distances to many
reference fingerprints. By the triangle inequality the tables of two linked
fingerprints differ by no more than ``bits`` in any place. The references come
in groups, each group differing from a common reference only within its own
stretch of bits, so ``bits`` differing bits leave all but ``bits`` groups
of distances, taken against the common one, as they are: fingerprints that agree in two of
five groups are compared, and no link is missed. Of these pairs the tables discard those whose largest
difference is above ``bits``; the rest are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import settle
from tillstone.llm.components import components


@dataclass(frozen=True)
class SimHash:
    """Shingles of ``shingle`` words, hashed with ``seed``; links at ``bits`` differing bits or fewer. ``groups`` of
    ``references`` each are the pivots; a bucket of more than ``block`` fingerprints is compared block by block."""

    shingle: int = 3
    seed: int = 42
    bits: int = 3
    groups: int = 5
    references: int = 9
    block: int = 8192


def fingerprint(text: bytes | None, how: SimHash) -> int:
    """Majority of each bit over the hashes of all shingles, A-Z in lower case; zero without a word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - how.shingle + 1)
    seed, digest = how.seed, xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist())
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), "<u8", n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # the bits of a very long text are counted piece by piece
        counts += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, how: SimHash) -> DataFrame:
    """(doc_id, fp) of every row, ``fp`` the fingerprint as a signed number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, how) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": found})

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def pivots(how: SimHash) -> np.ndarray:
    """The references, group after group. A group's first has the common pattern; the others differ from it in its stretch only."""
    rng = np.random.default_rng(13)
    common = rng.integers(0, 2**64, dtype=np.uint64)
    out = []
    for stretch in np.array_split(np.arange(64), how.groups):
        out.append(common)
        for _ in range(how.references - 1):
            flips = stretch[rng.permutation(len(stretch))[: (len(stretch) + 1) // 2]]
            out.append(common ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64)))
    return np.array(out, np.uint64)


def tables(fps: np.ndarray, how: SimHash) -> np.ndarray:
    """Hamming distances to all references, one byte each."""
    return np.bitwise_count(fps[:, None] ^ pivots(how)[None, :])


def keys(table: np.ndarray, how: SimHash) -> np.ndarray:
    """For each fingerprint a key for every choice of groups that may agree.

    What a group's distances say beyond the common reference is the difference
    to it: that is what stays when only bits outside its stretch change.
    """
    by_group = table.reshape(len(table), how.groups, how.references).astype(np.int64)
    inside = by_group[:, :, 1:] - by_group[:, :, :1]
    mixed = np.zeros(inside.shape[:2], np.uint64)
    for i in range(inside.shape[2]):
        mixed = (mixed + (inside[:, :, i] + 64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    out = []
    for number, chosen in enumerate(combinations(range(how.groups), how.groups - how.bits)):
        key = np.full(len(table), number + 1, np.uint64)
        for g in chosen:
            key = (key * np.uint64(0xC2B2AE3D27D4EB4F)) ^ mixed[:, g]
            key ^= key >> np.uint64(31)
        out.append(key)
    return np.stack(out, axis=1).view(np.int64)


def entries(classes: DataFrame, how: SimHash) -> DataFrame:
    """(fp, distances, buckets) of the distinct fingerprints."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            table = tables(batch["fp"].to_numpy().view(np.uint64), how)
            yield pd.DataFrame({"fp": batch["fp"], "distances": [t.tobytes() for t in table], "buckets": list(keys(table, how))})

    return classes.select("fp").mapInPandas(run, "fp long, distances binary, buckets array<long>")


def spanning_links(fps: np.ndarray, table: np.ndarray, side: np.ndarray | None, bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected within ``bits``; with ``side``, by pairs of different sides alone.

    Fingerprints are reached one from another. A reached one is only compared
    with those not reached yet, so a dense group costs few comparisons; each
    place of the tables thins out what is left before fingerprints are compared.
    """
    links, away = [], np.arange(len(fps))
    while len(away):
        reached, away = [away[0]], away[1:]
        while reached and len(away):
            x = reached.pop()
            near = away if side is None else away[side[away] != side[x]]
            for place in range(table.shape[1]):
                if len(near) < 2:
                    break
                near = near[np.abs(table[near, place] - table[x, place]) <= bits]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= bits]
            if len(near):
                links += [(fps[x], fps[y]) for y in near]
                reached += near.tolist()
                away = away[~np.isin(away, near, assume_unique=True)]
    return links


def links(found: DataFrame, how: SimHash) -> DataFrame:
    """Links (a, b) between fingerprints at ``bits`` or fewer, enough to connect all that are connected.

    A bucket is cut into blocks of bounded size, and each two blocks meet in
    one task; only links leave it, fewer than fingerprints came in.
    """
    placed = found.select("fp", "distances", F.explode("buckets").alias("bucket"))
    busy = placed.groupBy(F.col("bucket").alias("k")).agg(F.count("*").alias("size")).filter("size > 1")
    busy = settle(busy.select("k", F.ceil(F.col("size") / how.block).alias("blocks")), "simhash-busy")
    placed = placed.join(busy, F.col("bucket") == F.col("k")).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    meeting = placed.select("fp", "distances", "bucket", "block", other).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "distances"
    )

    def compare(parts: list[pd.DataFrame]) -> list[tuple[int, int]]:
        rows = pd.concat(parts)
        table = np.frombuffer(b"".join(rows["distances"]), np.uint8).reshape(len(rows), -1).astype(np.int16)
        side = rows["block"].to_numpy() if rows["i"].iloc[0] != rows["j"].iloc[0] else None
        return spanning_links(rows["fp"].to_numpy().view(np.uint64), table, side, how.bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, held = ["bucket", "i", "j"], []
        for batch in batches:
            if not len(batch):
                continue
            place = batch[names].to_numpy()
            cuts = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            out = []
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(batch)]):
                if held and (held[-1][names].iloc[-1].to_numpy() != place[a]).any():
                    out += compare(held)
                    held = []
                held.append(batch.iloc[a:b])
            yield as_links(out)
        if held:
            yield as_links(compare(held))

    def as_links(found: list[tuple[int, int]]) -> pd.DataFrame:
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    dealt = meeting.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInPandas(run, "a long, b long").distinct()


def near_fingerprints(docs: DataFrame, how: SimHash = SimHash()) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``, ``fingerprint`` as 16 lowercase hex digits.

    Equal fingerprints are one class from the start, however many documents
    have it; NULL, empty and blank texts have the fingerprint zero. The
    component is the smallest ``doc_id`` that can be reached, NULL only if no
    other can.
    """
    rows = settle(fingerprints(docs, how), "simhash-rows")
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    found = settle(links(settle(entries(classes, how), "simhash-tables"), how), "simhash-links")
    parts = components(found).withColumnRenamed("component", "part")
    part = classes.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("part", "fp").alias("part"))
    part = settle(part, "simhash-parts")
    least = part.groupBy(F.col("part").alias("p")).agg(F.min("least_id").alias("component_id"))
    named = part.join(least, F.col("part") == F.col("p")).select(F.col("fp").alias("c_fp"), "component_id")
    return rows.join(named, F.col("fp") == F.col("c_fp")).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def as_hex(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 16, "0"))


def op13(docs: DataFrame) -> DataFrame:
    return near_fingerprints(docs)
