"""The prefix trie against its definition, and against its SQL on rows of the given kind."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from parity.compare import _bag
from tillstone.llm import prefix_trie
from tillstone.llm.prefix_trie import Trie

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    told = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            told[c].append(((turn is not None, turn or 0, said), (role, text)))
    told = {c: [t for _, t in sorted(x)] for c, x in told.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in told:
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c / 20) * 20
        path = (*told.get(base, [])[:h], *told[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        if node:
            children[node[:-1]] += 1
        for d in range(len(node) + 1):
            leaves[node[:d]] += not any(len(n) == len(node) + 1 and n[:-1] == node for n in members)
            saved[node[:d]] += (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1]) if node else [])
    return sorted(
        (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, convs in members.items()
    )


def conversations(seed, convs=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 200), convs):
        said = rng.choice(["a", "b b", "", None, "c\td e"]) if rng.random() < 0.8 else f"own {c}"
        rows += [(c, rng.choice([None, t, t, t]), rng.choice(["user", "user", None]), rng.choice([said, "x y", "x y"])) for t in range(rng.randrange(1, longest))]
    return rows + [(None, 1, "user", "nobody"), rows[0], rows[0]]


@pytest.mark.parametrize("height,longest,parts", [(16, 9, 3), (2, 6, 3), (3, 12, 7), (1, 40, 2)])
def test_nodes_as_their_definition(spark, height, longest, parts):
    rows = conversations(height, longest=longest)
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(parts), Trie(height=height, pack=2)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1])) == brute(rows)


def test_a_conversation_over_many_partitions_and_many_copies(spark):
    long = [(7, t, "user", f"turn {t % 5}") for t in range(300)]
    copies = [(c, t, "user", f"turn {t % 5}") for c in range(1000, 1300) for t in range(4)]
    rows = long + copies
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.op11(spark.createDataFrame(rows, TURNS).repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1])) == brute(rows)


def test_equal_to_its_sql(spark):
    import duckdb
    import pandas as pd

    rows = conversations(5)
    conversations_table = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    connection = duckdb.connect()
    connection.register("conversations", conversations_table)
    cursor = connection.execute(prefix_trie.OP11_SQL)
    got = prefix_trie.op11(spark.createDataFrame(rows, TURNS))
    assert _bag(got.columns, got.collect()) == _bag([d[0] for d in cursor.description], cursor.fetchall())


def test_empty_and_turnless(spark):
    assert prefix_trie.op11(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie.op11(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect() == []
    from pyspark.sql import functions as F

    rows = [(c, 1, "u", "w") for c in range(21, 40)]  # no conversation 20: some lose their only turn
    clash = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit("x") for n in ("at", "c", "k", "row", "said", "words", "length", "id", "part")})
    assert sorted((tuple(r) for r in prefix_trie.op11(clash).collect()), key=lambda r: (r[0], r[1])) == brute(rows)
