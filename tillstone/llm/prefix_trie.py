"""Prefix trie of rebuilt conversations with subtree totals by a depth-band rollup.

The trie is cut into bands of ``height`` levels. A node counts up only to its
ancestors inside its band and to the node that the band hangs on; the totals of
these hanging points are then completed over the bands and handed to the nodes
above them. So a node is written for at most ``height`` ancestors, and the
number of rounds does not depend on the depth: a band has at least the square
root of the deepest level, which bounds both the levels of a band and the bands
of a conversation.

No conversation is ever gathered: turns are numbered in a range-partitioned
order, and a prefix is named by the digests of its full bands and of its part of
the last one. Texts are reduced to their digest and word count where they are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.common import count_words, settle, whole

NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Trie:
    """``height``: least levels of a band. ``family``: the conversation that others take their first turns from is the one
    with the next multiple of it towards zero; ``most`` bounds these turns (exclusive). ``pack``: ids in one piece of a list of ids."""

    height: int = 16
    family: int = 20
    most: int = 4
    pack: int = 256


def root() -> Column:
    """The name of the node without a turn."""
    return F.lit(bytearray.fromhex(NO_ENDS))


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, said, words, row): ``said`` is the digest of role and text, a NULL as empty. Rows without a conv_id belong to no conversation."""
    role, text = whole("role"), whole("text")
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        digest(F.length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary")).alias("said"),
        count_words(F.col("text")).alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )


def numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with their position ``at`` from 1 in their conversation, and (conv_id, n) of every conversation.

    Equal turn numbers are ordered by the digest of role and text. A long
    conversation lies in several partitions; each numbers its own part.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("said"), F.col("row")]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not len(batch):
                continue
            conv = batch["conv_id"].to_numpy()
            i = np.arange(len(conv))
            start = np.maximum.accumulate(np.where(np.r_[True, conv[1:] != conv[:-1]], i, 0))
            at = i - start + 1
            if conv[0] == last:
                at[start == 0] += seen
            last, seen = conv[-1], at[-1]
            yield pd.DataFrame({"conv_id": conv, "part": part, "local": at, "said": batch["said"], "words": batch["words"]})

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "said", "words")
    local = settle(ranged.mapInPandas(number, "conv_id long, part int, local long, said binary, words long"), "trie-turns")
    spans = local.groupBy("conv_id", "part").agg(F.max("local").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = settle(spans.withColumn("earlier", earlier), "trie-spans")
    # Only the first conversation of a partition can have begun in an earlier one: at most one row a partition.
    carried = spans.filter("earlier > 0").select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "earlier")
    placed = local.join(F.broadcast(carried), (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("p")), "left")
    at = (F.col("local") + F.coalesce("earlier", F.lit(0))).alias("at")
    return placed.select("conv_id", at, "said", "words"), spans.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(rows: DataFrame, how: Trie) -> tuple[DataFrame, DataFrame]:
    """(c, depth, said, words, length) of the turns of the rebuilt conversations, and (c, length) of all of them, turnless ones too."""
    at, sizes = numbered(rows)
    heads = at.filter((F.col("conv_id") % how.family == 0) & (F.col("at") < how.most))
    heads = heads.groupBy(F.col("conv_id").alias("b")).agg(F.sort_array(F.collect_list(F.struct("at", "said", "words"))).alias("head"))
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % how.most
    plans = sizes.select(F.col("conv_id").alias("c"), "n", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % how.family).alias("base"))
    head = F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.array().cast("array<struct<at:bigint,said:binary,words:bigint>>"))
    plans = plans.join(heads, F.col("base") == F.col("b"), "left").select("c", "n", "h", head.alias("head"))
    length = F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    plans = settle(plans.withColumn("length", length.cast("long")), "trie-plans")
    tails = plans.filter(F.col("n") > F.col("h")).select("c", "h", F.size("head").alias("m"), "length")
    own = at.join(tails, F.col("conv_id") == F.col("c")).filter("at > h")
    own = own.select("c", (F.col("at") - F.col("h") + F.col("m")).alias("depth"), "said", "words", "length")
    taken = plans.select("c", F.explode("head").alias("x"), "length").select("c", F.col("x.at").alias("depth"), "x.said", "x.words", "length")
    return own.union(taken), plans.select("c", "length")


def banded(steps: DataFrame, height: int) -> DataFrame:
    """(c, k, top, ids, words, length): of each conversation its bands, the node each hangs on, and the nodes down it."""
    band = ((F.col("depth") - 1) / height).cast("long").alias("k")
    lists = steps.groupBy("c", band).agg(
        F.sort_array(F.collect_list(F.struct("depth", "said", "words"))).alias("x"), F.first("length").alias("length")
    )
    nothing = F.array().cast("array<binary>")
    chain = F.aggregate("x", nothing, lambda done, t: F.concat(done, F.array(digest(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(bytearray())), t.said))))
    lists = settle(lists.select("c", "k", "length", F.col("x.words").alias("words"), chain.alias("chain")), "trie-chains")
    # What the full bands before a band lead to; a conversation has no more bands than a band can have levels.
    full = lists.filter((F.size("chain") == height) & (F.col("length") > height)).select("c", "k", F.element_at("chain", -1).alias("q"))
    full = full.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("k", "q"))).alias("x"))
    tops = F.aggregate("x", F.array(root()), lambda done, t: F.concat(done, F.array(digest(F.element_at(done, -1), t.q))))
    tops = full.select(F.col("c").alias("t_c"), F.posexplode(tops).alias("t_k", "top"))
    lists = lists.join(tops, (F.col("c") == F.col("t_c")) & (F.col("k") == F.col("t_k")), "left").withColumn("top", F.coalesce("top", root()))
    ids = F.transform("chain", lambda q: digest(F.col("top"), q))
    return lists.select("c", "k", "top", ids.alias("ids"), "words", "length")


def trie_nodes(bands: DataFrame, lengths: DataFrame, height: int) -> DataFrame:
    """One row per node: ``id``, ``parent``, ``conv_id``, ``depth``, ``n_convs``, ``n_ends``, and its own ``leaf`` and ``saved``."""
    parents = F.concat(F.array("top"), F.slice("ids", 1, F.size("ids") - 1)).alias("parents")
    places = bands.select("c", "k", "length", "ids", "words", parents).select("c", "k", "length", F.posexplode(F.arrays_zip("ids", "parents", "words")).alias("i", "x"))
    steps = places.select(
        F.col("x.ids").alias("id"), F.col("x.parents").alias("parent"), (F.col("k") * height + F.col("i") + 1).alias("depth"), "c", "x.words", "length"
    )
    below = steps.groupBy("id").agg(
        F.first("parent").alias("parent"), F.min("c").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"),
        F.count_if(F.col("depth") == F.col("length")).alias("n_ends"), F.max("words").alias("words"),
    )
    top = lengths.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("length") == 0).alias("n_ends")).filter("n_convs > 0")
    top = top.select(
        root().alias("id"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", "n_ends",
        F.lit(0).cast("long").alias("words"),
    )
    return below.union(top).select(
        "id", "parent", "conv_id", "depth", "n_convs", (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )


def total(values: Column, name: str) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v[name])


def upwards(paths: DataFrame) -> DataFrame:
    """(id, leaf, saved): each node of ``path`` (from ``start``) with the sums of the values ``x`` (at, leaf, saved) at or below it."""

    def sums(node: Column, i: Column) -> Column:
        here = F.filter("x", lambda v: v.at >= F.col("start") + i)
        return F.struct(node.alias("id"), total(here, "leaf").alias("leaf"), total(here, "saved").alias("saved"))

    return paths.select(F.explode(F.transform("path", sums)).alias("s")).select("s.id", "s.leaf", "s.saved")


def rollup(bands: DataFrame, nodes: DataFrame, height: int, deepest: int) -> DataFrame:
    """(id, leaf, saved) to be summed over each node: its subtree, itself included.

    A node is counted along the path of its smallest member, on which it and
    its ancestors lie; the nodes of a path with that member are its lower end.
    """
    k = ((F.col("depth") - 1) / height).cast("long")
    values = F.sort_array(F.collect_list(F.struct(F.col("depth").alias("at"), "leaf", "saved"))).alias("x")
    values = nodes.filter("depth > 0").groupBy(F.col("conv_id").alias("v_c"), k.alias("v_k")).agg(values)
    paths = bands.join(values, (F.col("c") == F.col("v_c")) & (F.col("k") == F.col("v_k"))).withColumn("start", F.col("k") * height + 1)
    paths = settle(paths.select("c", "k", "top", "start", F.col("ids").alias("path"), "x"), "trie-paths")
    inside = upwards(paths)
    hung = paths.select(F.col("top").alias("id"), total(F.col("x"), "leaf").alias("leaf"), total(F.col("x"), "saved").alias("saved"))
    hung = hung.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    own = nodes.filter("depth = 0").select("id", "leaf", "saved")
    if deepest <= height:
        return inside.union(hung).union(own)
    # The hanging points make a trie of their own: one level for each band.
    hung = settle(hung.withColumnRenamed("id", "h_id"), "trie-hung")
    points = nodes.filter(F.col("depth") % height == 0).select("id", "conv_id", (F.col("depth") / height).cast("long").alias("at"))
    values = hung.join(points, F.col("h_id") == F.col("id"))
    values = values.groupBy(F.col("conv_id").alias("v_c")).agg(F.sort_array(F.collect_list(F.struct("at", "leaf", "saved"))).alias("x"))
    # A member may end where others go on, so the end of a full band is on its path as well.
    ends = F.when(F.size("ids") == height, F.element_at("ids", -1)).alias("end")
    chains = bands.select("c", F.struct("k", "top", ends).alias("b")).groupBy("c").agg(F.sort_array(F.collect_list("b")).alias("b"))
    end = F.element_at("b", -1).end
    chains = chains.select("c", F.concat(F.transform("b", lambda b: b.top), F.when(end.isNull(), F.array().cast("array<binary>")).otherwise(F.array(end))).alias("path"))
    across = upwards(chains.join(values, F.col("c") == F.col("v_c")).withColumn("start", F.lit(0)))
    across = settle(across.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")), "trie-across")
    # Completed totals go to the hanging point itself and to its ancestors in the band above.
    points = points.filter("at > 0").select(F.col("id").alias("p_id"), F.col("conv_id").alias("p_c"), (F.col("at") - 1).alias("p_k"))
    above = across.join(points, F.col("id") == F.col("p_id")).drop("id").join(bands, (F.col("p_c") == F.col("c")) & (F.col("p_k") == F.col("k")))
    above = above.select(F.explode("ids").alias("id"), "leaf", "saved")
    return inside.union(above).union(across.join(own.select(F.col("id").alias("r")), F.col("id") == F.col("r"), "left_semi")).union(own)


def end_digests(ends: DataFrame, how: Trie) -> DataFrame:
    """(e_id, ends_sha256) of the ids ``c`` at each node ``id``, ascending and comma-joined.

    SHA-256 can only be read from front to back. The lists are sorted and joined
    to pieces over all tasks; one task then reads the pieces of a node as a
    stream, and never holds more than a batch of them.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, convs = batch["id"].to_numpy(), batch["c"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.empty(0, int)
            out = []
            for a, b in zip(cuts, np.r_[cuts[1:], len(ids)]):
                out += [(ids[a], convs[i], ",".join(map(str, convs[i : min(b, i + how.pack)]))) for i in range(a, b, how.pack)]
            yield pd.DataFrame(out, columns=["id", "least", "piece"])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            out = []
            for node, piece in zip(batch["id"], batch["piece"]):
                if node != now:
                    if state:
                        out.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield pd.DataFrame(out, columns=["e_id", "ends_sha256"])
        if state:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["e_id", "ends_sha256"])

    ranged = settle(ends, "trie-ends").repartitionByRange("id", "c").sortWithinPartitions("id", "c")
    pieces = settle(ranged.mapInPandas(pack, "id binary, least long, piece string"), "trie-pieces")
    return pieces.repartition("id").sortWithinPartitions("id", "least").mapInPandas(fold, "e_id binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, how: Trie = Trie()) -> DataFrame:
    """One row per node of the trie: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by number, NULL first, equal numbers by the digest of role
    and text; repeated rows are turns of their own. NULL roles and texts are
    empty. Rows without a conv_id are in no conversation. No rows, no nodes.
    """
    steps, lengths = rebuilt(settle(turns(conversations), "trie-rows"), how)
    deepest = lengths.agg(F.max("length")).first()[0] or 0
    height = max(how.height, math.isqrt(max(0, deepest - 1)) + 1)
    bands = settle(banded(steps, height), "trie-bands")
    nodes = settle(trie_nodes(bands, lengths, height), "trie-nodes")
    none = F.lit(0).cast("long")
    parts = rollup(bands, nodes, height, deepest).withColumn("child", none)
    parts = parts.union(nodes.filter("depth > 0").select(F.col("parent").alias("id"), none.alias("leaf"), none.alias("saved"), F.lit(1).cast("long").alias("child")))
    sums = parts.groupBy(F.col("id").alias("s_id")).agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("child").alias("n_children")
    )
    last = bands.filter(F.col("k") * height + F.size("ids") == F.col("length")).select(F.element_at("ids", -1).alias("id"), "c")
    ends = end_digests(last.union(lengths.filter("length = 0").select(root().alias("id"), "c")), how)
    above = nodes.select(F.col("id").alias("p_id"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(sums, F.col("id") == F.col("s_id"))
        .join(ends, F.col("id") == F.col("e_id"), "left")
        .join(above, F.col("parent") == F.col("p_id"), "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def op11(conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations)


OP11_SQL = r"""
WITH told AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 20 AS base,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
               lambda crc, x: list_reduce(list_prepend(xor(crc, x), range(8)),
                   lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END)), 4294967295::BIGINT) % 4 AS h
    FROM told GROUP BY c
), parts AS (
    SELECT convs.c, 0 AS own, pos, role, text FROM convs JOIN told ON told.c = convs.base AND pos <= h
    UNION ALL SELECT convs.c, 1, pos, role, text FROM convs JOIN told ON told.c = convs.c AND pos > h
), steps AS (
    SELECT c, row_number() OVER w AS depth, text, list({'r': role, 't': text}) OVER w AS path
    FROM parts WINDOW w AS (PARTITION BY c ORDER BY own, pos)
    UNION ALL SELECT c, 0, '', [] FROM convs
), lengths AS (SELECT c, max(depth) AS length FROM steps GROUP BY c
), nodes AS (
    SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, count(*) = count(*) FILTER (depth = length) AS leaf,
           (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS saved,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = length), '')) AS ends_sha256
    FROM steps JOIN lengths USING (c) GROUP BY path, depth
), sums AS (
    SELECT up.path, sum(leaf::INT) AS n_leaves, sum(saved) AS saved_tokens, count(*) FILTER (nodes.depth = up.depth + 1) AS n_children
    FROM nodes JOIN steps up ON up.c = nodes.conv_id AND up.depth <= nodes.depth GROUP BY up.path
)
SELECT nodes.conv_id::BIGINT AS conv_id, nodes.depth::BIGINT AS depth, above.conv_id::BIGINT AS parent_conv_id, nodes.n_convs::BIGINT AS n_convs,
       n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums USING (path) LEFT JOIN nodes above ON above.path = nodes.path[:-2] AND nodes.depth > 0 AND above.depth = nodes.depth - 1
"""
