"""MinHash near-duplicates: universal hash minima, banding, signature verification, full sets, components.

Texts with equal shingle sets are one class from the start, so a thousand
copies are one row. Within a bucket a member is only compared while it is not
yet connected with the others: one pivot at a time first, then all pairs across
what is still apart. A group of near copies never becomes all of its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import passing, same, settle, spare
from tillstone.llm.components import components


@dataclass(frozen=True)
class MinHash:
    """Sets of ``shingle`` words; links at ``similar_pct`` of the union or more. With 48 bands of 6 rows a pair at 80 %
    shares no bucket in one of two million cases; ``slack`` is five standard deviations of the estimate from 288 minima."""

    shingle: int = 5
    similar_pct: int = 80
    bands: int = 48
    rows: int = 6
    slack: float = 0.12
    rounds: int = 2
    #: Members and shingles of a block when what pivots have left apart is compared block by block.
    block: int = 1024
    block_shingles: int = 400_000


class WordHashes(dict):
    """64-bit hashes of words; keeps those seen before and is emptied when it has grown."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the windows of ``size`` words, A-Z in lower case."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    mixed = np.full(n, len(words) if len(words) < size else size, np.uint64)
    for i in range(min(size, len(h))):
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def coefficients(count: int, kind: type = np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of universal hashes modulo 2 ** 32, or 2 ** 64."""
    rng = np.random.default_rng(20)
    return tuple(rng.integers(0, np.iinfo(kind).max, (2, count), kind, endpoint=True) | np.array([[1], [0]], kind))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest value of each hash over the set, in blocks of bounded size."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(least, (x[i : i + 256] * a + b).min(axis=0), out=least)
    return least


def digests(docs: DataFrame, how: MinHash) -> DataFrame:
    """(row, doc_id, text_hash, n, digest, marks, bands) of every document, ``marks`` one byte of each minimum."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = coefficients(how.bands * how.rows)
        fold = coefficients(how.rows, np.uint64)[0]
        known = WordHashes()
        for batch in batches:
            cache: dict[bytes, tuple] = {}  # exact copies in the batch
            out = []
            for text in batch["text"]:
                s = shingle_set(text, how.shingle, known)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                if digest is not None and digest not in cache:
                    sig = minima(s, a, b)
                    with np.errstate(over="ignore"):
                        keys = (sig.reshape(how.bands, how.rows).astype(np.uint64) * fold).sum(axis=1, dtype=np.uint64)
                        keys ^= np.arange(how.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    cache[digest] = ((sig & 0xFF).astype(np.uint8).tobytes(), keys.view(np.int64))
                out.append((len(s), digest, *cache.get(digest, (None, None))))
            names = ["n", "digest", "marks", "bands"]
            found = pd.DataFrame(out, columns=names, index=batch.index)
            yield pd.concat([batch[["row", "doc_id", "text_hash"]], found], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, text_hash long, n long, digest binary, marks binary, bands array<long>"
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )
    return rows.mapInPandas(run, schema)


def shingle_sets(docs: DataFrame, how: MinHash) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, how.shingle, known).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "shingles": sets})

    return docs.mapInPandas(run, "id long, shingles binary")


def estimate(pairs: DataFrame, how: MinHash) -> DataFrame:
    """``pairs`` with ``est``, the similarity by the share of equal marks; those surely below the limit go."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), -1) for c in ("marks_a", "marks_b"))
                equal = (x == y).mean(axis=1)
                batch = batch.assign(est=(equal - 1 / 256) / (1 - 1 / 256))
                batch = batch[batch["est"] >= how.similar_pct / 100 - how.slack]
                yield batch[["a", "b", "est"]]

    return pairs.mapInPandas(run, "a long, b long, est double")


def confirm(pairs: DataFrame, how: MinHash) -> DataFrame:
    """The pairs whose full sets reach the limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["set_a"], batch["set_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= how.similar_pct * (len(x) + len(y) - both))
            yield batch.loc[linked, ["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row of ``docs``.

    Texts with fewer words than a shingle are one shingle; NULL, empty and
    blank texts have the empty set and are linked with nothing. The component
    is the smallest ``doc_id`` that can be reached (NULL only if there is no
    other). Of rows that share that ``doc_id`` in a component, all are kept.
    """
    with passing(docs.sparkSession):
        signed = settle(digests(docs, how), "minhash-signed")
        classes = signed.filter("digest is not null").groupBy(F.col("digest").alias("c_digest")).agg(F.min("row").alias("id"), F.min("doc_id").alias("least_id"))
        classes = settle(classes, "minhash-classes", stays=True)
        sketch = signed.join(classes.select("id").hint("merge"), F.col("row") == F.col("id")).select("id", "doc_id", "text_hash", "n", "marks", "bands")
        sketch = settle(sketch, "minhash-sketches", stays=True)
        rows = settle(signed.select("doc_id", "text_hash", "n", "digest"), "minhash-rows", stays=True)
    with passing(docs.sparkSession):
        parts = linked_classes(docs, sketch, how)
        # Class -> component -> the smallest doc_id among the component's classes.
        part = classes.join(parts, F.col("id") == F.col("node"), "left").withColumn("part", F.coalesce("component", "id"))
        least = part.groupBy(F.col("part").alias("p")).agg(F.min("least_id").alias("component_id"))
        named = settle(part.join(least, F.col("part") == F.col("p")).select("c_digest", "component_id"), "minhash-named", stays=True)
    joined = rows.join(named, F.col("digest") == F.col("c_digest"), "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), same(F.col("doc_id"), component).alias("kept")
    )


def text_key() -> list[Column]:
    """What tells the texts of a table apart, never NULL: the doc_id as text and a hash of the text."""
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k_id"), F.xxhash64("text").alias("k_text")]


def linked_classes(docs: DataFrame, sketch: DataFrame, how: MinHash) -> DataFrame:
    """(node, component) of the classes that are linked with another one."""
    none = docs.sparkSession.range(0)
    members = sketch.select("id", "n", F.explode("bands").alias("bucket"))
    busy = members.groupBy(F.col("bucket").alias("k")).agg(F.count("*").alias("size")).filter("size > 1")
    members = members.join(settle(busy.select("k"), "minhash-busy").hint("merge"), F.col("bucket") == F.col("k")).drop("k")
    members = settle(members, "minhash-members")
    wanted = sketch.join(members.select(F.col("id").alias("w")).distinct(), F.col("id") == F.col("w"), "left_semi")
    wanted = wanted.select("id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("w_id"), F.col("text_hash").alias("w_text"))
    texts = docs.select(*text_key(), F.col("text").cast("binary").alias("text"))
    texts = texts.join(settle(wanted, "minhash-wanted").hint("merge"), (F.col("k_id") == F.col("w_id")) & (F.col("k_text") == F.col("w_text")))
    sets = settle(shingle_sets(texts.dropDuplicates(["k_id", "k_text"]).select("id", "text"), how), "minhash-sets")
    marks = sketch.select("id", "marks")
    parts = none.select(F.col("id").alias("node"), F.col("id").alias("component"))
    tested = none.select(F.col("id").alias("a"), F.col("id").alias("b"))
    for turn in range(how.rounds):
        pairs = candidates(members, parts, turn).join(tested, ["a", "b"], "left_anti")
        pairs = pairs.filter(100 * F.col("few") >= how.similar_pct * F.col("many")).select("a", "b", "id").distinct()
        likely = settle(estimate(with_both(pairs.select("a", "b").distinct(), marks, "marks"), how), "minhash-likely")
        # The best pair of each member will do: its other links are mostly within the part it joins by that.
        best = likely.join(pairs, ["a", "b"]).groupBy("id").agg(F.max_by(F.struct("a", "b"), F.struct("est", "a", "b")).alias("p"))
        likely = settle(best.select("p.a", "p.b").distinct(), "minhash-checked")
        found = settle(confirm(with_both(likely, sets.withColumnRenamed("shingles", "set"), "set"), how), "minhash-found")
        tested = tested.union(likely)
        if found.isEmpty():
            break
        parts = settle(joined_by(parts, found), "minhash-parts")
    # A bucket of two is one pair: whatever of these is still apart and untested is tested now, not only the best of a member.
    pairs = twos(members, parts).join(tested, ["a", "b"], "left_anti")
    pairs = pairs.filter(100 * F.col("few") >= how.similar_pct * F.col("many")).select("a", "b").distinct()
    likely = settle(estimate(with_both(pairs, marks, "marks"), how).select("a", "b"), "minhash-likely")
    found = settle(confirm(with_both(likely, sets.withColumnRenamed("shingles", "set"), "set"), how), "minhash-found")
    if not found.isEmpty():
        parts = settle(joined_by(parts, found), "minhash-parts")
    found = settle(across(members, parts, marks.join(sets.withColumnRenamed("id", "s"), F.col("id") == F.col("s")).drop("s"), how), "minhash-found")
    return parts if found.isEmpty() else settle(joined_by(parts, found), "minhash-parts")


def joined_by(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The parts after more links (a, b): what is joined already is a star, which takes few rounds."""
    return components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))


def with_parts(members: DataFrame, parts: DataFrame) -> DataFrame:
    return members.join(parts, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", "n", F.coalesce("component", "id").alias("part")
    )


def across(members: DataFrame, parts: DataFrame, sketches: DataFrame, how: MinHash) -> DataFrame:
    """Links (a, b) between parts that still share a bucket.

    Parts that share buckets are a family. A family is cut into blocks of
    bounded size, and each two blocks meet in a task, which returns no more
    links than it has parts to join. Buckets of two have been settled pair by pair.
    """
    apart = with_parts(members, parts)
    mixed = apart.groupBy(F.col("bucket").alias("k")).agg(F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"))
    mixed = settle(mixed.filter("size > 2 and low < high").select("k", "low"), "minhash-mixed")
    apart = settle(apart.join(mixed, F.col("bucket") == F.col("k")).select("id", "n", "part", "low").distinct(), "minhash-apart")
    families = settle(components(apart.select(F.col("part").alias("a"), F.col("low").alias("b"))), "minhash-families")
    placed = apart.select("id", "n", "part").distinct().join(families, F.col("part") == F.col("node")).drop("node")
    sizes = placed.groupBy(F.col("component").alias("family")).agg(
        F.greatest(F.ceil(F.count("*") / how.block), F.ceil(F.sum("n") / how.block_shingles)).alias("blocks")
    )
    placed = placed.join(settle(sizes, "minhash-family-sizes"), F.col("component") == F.col("family")).drop("component")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    full = placed.join(sketches.withColumnRenamed("id", "s"), F.col("id") == F.col("s")).drop("s")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    meeting = full.withColumn("other", other).select(
        "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "part", "marks", "shingles"
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        ids, block, part = (rows[c].to_numpy() for c in ("id", "block", "part"))
        marks = np.frombuffer(b"".join(rows["marks"]), np.uint8).reshape(len(rows), -1)
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        sizes = np.array([len(x) for x in sets])
        alone = rows["i"].iloc[0] == rows["j"].iloc[0]
        joined = {p: p for p in part}

        def root(p: int) -> int:
            while joined[p] != p:
                joined[p] = p = joined[joined[p]]
            return p

        links = []
        for x in range(len(ids)):
            rest = slice(x + 1, None)
            near = (100 * np.minimum(sizes[x], sizes[rest]) >= how.similar_pct * np.maximum(sizes[x], sizes[rest])) & (part[rest] != part[x])
            if not alone:
                near &= block[rest] != block[x]
            at = x + 1 + np.flatnonzero(near)
            if not len(at):
                continue
            est = ((marks[at] == marks[x]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
            for y in at[est >= how.similar_pct / 100 - how.slack]:
                if root(part[x]) != root(part[y]):
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * both >= how.similar_pct * (sizes[x] + sizes[y] - both):
                        joined[root(part[x])] = root(part[y])
                        links.append((ids[x], ids[y]))
        return pd.DataFrame(links, columns=["a", "b"])

    return meeting.groupBy("family", "i", "j").applyInPandas(compare, "a long, b long")


def candidates(members: DataFrame, parts: DataFrame, turn: int) -> DataFrame:
    """(a, b, few, many, id): each member with the pivot of its bucket, another one each turn, if it lies in another part."""
    apart = with_parts(members, parts)
    pivot = F.min_by(F.struct("id", "n", "part"), F.xxhash64("id", F.lit(turn)) if turn else F.col("id"))
    mixed = apart.groupBy(F.col("bucket").alias("k")).agg(
        F.min("part").alias("low"), F.max("part").alias("high"), pivot.alias("pivot")
    )
    mixed = settle(mixed.filter("low < high").select("k", "pivot.*"), "minhash-mixed")
    mixed = mixed.select("k", *[F.col(c).alias(f"o_{c}") for c in ("id", "n", "part")])
    return apart.join(mixed, F.col("bucket") == F.col("k")).filter("part <> o_part").select(
        F.least("id", "o_id").alias("a"), F.greatest("id", "o_id").alias("b"),
        F.least("n", "o_n").alias("few"), F.greatest("n", "o_n").alias("many"), "id",
    )


def twos(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, b, few, many): the members of each bucket of two, if they lie in different parts."""
    both = with_parts(members, parts).groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("part").alias("low"), F.max("part").alias("high"),
        F.min("id").alias("a"), F.max("id").alias("b"), F.min("n").alias("few"), F.max("n").alias("many"),
    )
    return both.filter("size = 2 and low < high").select("a", "b", "few", "many")


def with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) with the value of either side as ``<name>_a`` and ``<name>_b``."""
    for side in ("a", "b"):
        of = values.select(F.col("id").alias("v"), F.col(name).alias(f"{name}_{side}"))
        pairs = pairs.join(of, F.col(side) == F.col("v")).drop("v")
    return pairs


def keep_one(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest ``doc_id`` (NULL last).

    Of several rows with that ``doc_id`` one stays. Blank texts all stay.
    """
    return only(docs, survivors(docs, how))


def survivors(docs: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """(s_id, s_text): the ``text_key`` of the document of each group that stays, blank texts left out."""
    with passing(docs.sparkSession):
        found = near_duplicates(docs, how).filter("n_shingles > 0")
        first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("x")
        stay = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("text_hash"))).agg(first)
        stay = stay.select(F.coalesce(F.col("x.doc_id").cast("string"), F.lit("")).alias("s_id"), F.col("x.text_hash").alias("s_text"))
        return settle(stay, "minhash-stay", stays=True)


def only(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """One row for each of the ``survivors``, and all blank ones; of rows without ``text`` those with a survivor's ``doc_id`` and ``text_hash``."""
    if "text" not in docs.columns:
        own = (F.coalesce(F.col("doc_id").cast("string"), F.lit("")) == F.col("s_id")) & (F.col("text_hash") == F.col("s_text"))
        return docs.join(stay, own, "left_semi")
    k_id, k_text = (spare(docs.columns, n) for n in ("k_id", "k_text"))
    keyed = docs.filter(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).withColumns(dict(zip((k_id, k_text), text_key())))
    kept = keyed.join(stay, (F.col(k_id) == F.col("s_id")) & (F.col(k_text) == F.col("s_text")), "left_semi")
    blank = docs.filter(~F.coalesce(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False)))
    return kept.dropDuplicates([k_id, k_text]).drop(k_id, k_text).unionByName(blank)


def op7(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, MinHash(shingle=2)).select("doc_id", "n_shingles", "component_id", "kept")
