"""Fingerprints and components against their definition."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillstone.llm import simhash
from tillstone.llm.simhash import SimHash


def brute_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    """For (doc_id, fp) the smallest doc_id that is reached."""
    part = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits and part[i] != part[j]:
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    least = {}
    for (d, _), p in zip(fps, part):
        least[p] = min(least.get(p, d), d)
    return sorted((d, f"{f:016x}", least[p]) for (d, f), p in zip(fps, part))


def test_documents_as_their_definition(documents):
    rng = random.Random(2)
    words = [f"W{i}é" for i in range(300)]
    base = [[rng.choice(words) for _ in range(200)] for _ in range(4)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two\nthree"), (8, "a b a b a b"), (9, "x" * 30_000)]
    for i in range(60):
        text = list(base[i % 4])
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((500 - i, rng.choice([" ", "\n"]).join(text)))
    got = simhash.op13(documents(rows).withColumns({c: F.lit("x") for c in ("fp", "part", "node", "bucket", "fingerprint")})).collect()
    want = brute_components([(d, brute_fingerprint(t)) for d, t in rows])
    assert sorted(tuple(r) for r in got) == want
    assert len({w[2] for w in want}) < 60 and {w[2] for w in want if w[0] < 4} == {1}


@pytest.mark.parametrize("how", [SimHash(), SimHash(block=7), SimHash(references=3)])
def test_links_as_all_pairs(spark, how):
    """A dense group, chains of exactly three and of four bits, and strangers."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(80):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4))))
    for step in (3, 4):
        x = rng.getrandbits(64)
        bits = rng.sample(range(64), 60)
        for i in range(0, 36, step):
            x ^= sum(1 << b for b in bits[i : i + step])
            fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    ids = sorted(fps)
    rng.shuffle(ids)
    rows = list(enumerate(ids))
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in ids], "fp long").repartition(3)
    got = [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in simhash.links(simhash.entries(table, how), how).collect()]
    part = {f: {f} for f in ids}
    for a, b in got:
        assert (a ^ b).bit_count() <= 3
        if part[a] is not part[b]:
            part[a] |= part[b]
            for f in part[b]:
                part[f] = part[a]
    number = {f: i for i, f in rows}
    assert sorted((i, f"{f:016x}", min(number[g] for g in part[f])) for i, f in rows) == brute_components(rows)


def test_tables_bound_the_distance():
    how, rng = SimHash(), np.random.default_rng(0)
    fps = rng.integers(0, 2**64, 200, dtype=np.uint64)
    near = fps ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    apart = np.abs(simhash.tables(fps, how).astype(int) - simhash.tables(near, how))
    assert (apart.max(axis=1) <= np.bitwise_count(fps ^ near)).all()
    assert ((simhash.keys(simhash.tables(fps, how), how) == simhash.keys(simhash.tables(near, how), how)).sum(axis=1) >= 3).all()


def test_odd_rows_and_empty_table(odd, documents):
    got = simhash.op13(odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert simhash.op13(documents([])).collect() == []
