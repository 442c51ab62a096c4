"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources get whole blocks by highest quotients, and so do the shards of a
source; a shard takes its blocks from its documents in a seeded order. Shards
hold a bounded number of words, so a source with a third of all rows is many
shards. Everything is window functions over counts, then over one shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstone.llm.common import count_words, same, settle, spare


@dataclass(frozen=True)
class Mix:
    """``weights`` go round the sources in their order; ``share`` is the wanted part of all words, ``most`` the
    passes over a source at most, ``block`` the words of a block, ``shard_words`` the words of a shard about."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    block: int = 64
    shard_words: int = 2_000_000
    seed: str = "mix"


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights, cut at ``most`` sizes, the excess reshared.

    Ordered by capacity for each unit of weight, the sources that are cut come
    first, and the level of the others is what remains for each unit of weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(0))
    turn = (F.row_number().over(by_name) - 1) % len(mix.weights)
    return (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, mix.weights)), turn + 1))
        .withColumn("cap", mix.most * F.col("source_size"))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(all_rows) * mix.share - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("pull", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.col("pull"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "level"))).over(all_rows)["level"])
        .withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(float("inf")))))
        .select("source", "source_size", "target")
    )


def sainte_lague(parties: DataFrame, group: list[str], votes: str, seats: str, tie: list[str]) -> DataFrame:
    """``parties`` with ``quota``: the ``seats`` of each group given to the highest quotients votes / (2k - 1).

    Rounding votes to the nearest seat is right but for a few seats; these are
    given to the next quotients, or taken from the lowest. How many a party can
    gain or lose is bounded by its share, so the quotients listed stay in
    proportion to the number of parties. Parties without votes get nothing.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    v, total = F.col(votes).cast("double"), F.col("all_votes")
    gap = F.abs("gap")
    change = F.least(gap, F.ceil(v / total * (gap + F.col("n_parties"))) + 1)
    quotient = F.when(F.col("gap") > 0, -v / (2 * (F.col("first_quota") + F.col("k")) - 1)).otherwise(
        v / (2 * (F.col("first_quota") - F.col("k") + 1) - 1)
    )
    # Of equal quotients the first in order wins a seat, and so the last one loses it.
    order = [F.col("k") == 0, F.col("quotient"), F.when(F.col("gap") < 0, -F.col("place")).otherwise(F.col("place")), F.col("k")]
    return (
        parties.withColumn("place", F.row_number().over(whole.orderBy(*[F.col(t).asc_nulls_last() for t in tie])))
        .withColumn("all_votes", F.sum(v).over(whole))
        .withColumn("n_parties", F.count("*").over(whole))
        .withColumn("first_quota", F.when(total > 0, F.floor(v * F.col(seats) / total + 0.5)).otherwise(0).cast("long"))
        .withColumn("gap", F.when(total > 0, F.col(seats) - F.sum("first_quota").over(whole)).otherwise(0))
        .withColumn("change", F.when(v > 0, F.when(F.col("gap") < 0, F.least(change, "first_quota")).otherwise(change)).otherwise(0))
        .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("change").cast("long"))))
        .withColumn("quotient", F.when(F.col("k") > 0, quotient))
        .withColumn("rank", F.row_number().over(whole.orderBy(*order)))
        .withColumn("won", F.when((F.col("k") > 0) & (F.col("rank") <= gap), F.signum("gap")).otherwise(0).cast("long"))
        .groupBy(*parties.columns, "first_quota")
        .agg((F.col("first_quota") + F.sum("won")).alias("quota"))
        .drop("first_quota")
    )


def mix(docs: DataFrame, plan: Mix = Mix()) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``, the words that the mix takes of the document.

    NULL sources are one source, the last. NULL, empty and blank texts have
    size 0 and nothing is taken. Repeated rows count one by one. Columns of
    these four names are replaced. No documents give no rows.
    """
    pick, of, shard = (spare([*docs.columns, "size", "source_size", "target", "taken"], n) for n in ("pick", "of_source", "shard"))
    key = F.md5(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))) 
    sized = docs.drop("source_size", "target", "taken").withColumn("size", count_words(F.col("text"))).withColumn(pick, key)
    narrow = settle(sized.select("source", "size", F.col(pick).alias("pick")), "mix-sizes")
    sources = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), plan)
    sources = sources.withColumn("seats", F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / plan.block).cast("long"))
    sources = sainte_lague(sources, [], "target", "seats", ["source"]).withColumnRenamed("quota", "blocks")
    sources = settle(
        sources.select(
            F.col("source").alias("of_source"), "source_size", "target", "blocks",
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / plan.shard_words)).cast("long").alias("n_shards"),
        ),
        "mix-sources",
    )

    def sharded(df: DataFrame, pick: str, of: str, shard: str) -> DataFrame:
        """Each row with its source's figures and its shard."""
        found = df.join(sources.withColumnRenamed("of_source", of), same(F.col("source"), F.col(of)))
        number = F.conv(F.substring(pick, 1, 8), 16, 10).cast("long")
        return found.withColumn(shard, F.pmod(number, F.col("n_shards")))

    shards = sharded(narrow, "pick", "of_source", "shard").groupBy("source", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    quotas = sainte_lague(shards, ["source"], "shard_size", "blocks", ["shard"])
    room = F.least(F.col("quota") * plan.block, F.col("shard_size") * plan.most)
    quotas = settle(
        quotas.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "shard_size", room.alias("room")),
        "mix-quotas",
    )
    own = ["n_shards", "blocks", "q_source", "q_shard", "shard_size", "room", "start"]
    clash = {c: spare([*docs.columns, *own], f"own_{c}") for c in docs.columns if c in own}
    rows = sharded(sized.withColumnsRenamed(clash), pick, of, shard)
    rows = rows.join(quotas, same(F.col("source"), F.col("q_source")) & (F.col(shard) == F.col("q_shard")))
    order = Window.partitionBy("q_source", "q_shard").orderBy(pick)
    start = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    passes = F.floor(F.col("room") / F.col("shard_size"))
    rest = F.col("room") - passes * F.col("shard_size") - F.col("start")
    taken = F.when(F.col("size") > 0, passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).otherwise(0)
    back = {v: k for k, v in clash.items()}
    return (
        rows.withColumn("start", start)
        .withColumn("taken", taken.cast("long"))
        .drop(pick, of, shard, *own)
        .withColumnsRenamed(back)
        .select(*[f"`{c}`" for c in docs.columns if c not in ("size", "source_size", "target", "taken")], "size", "source_size", "target", "taken")
    )


def op9(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
with n as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as pick
  from documents
),
s0 as (select source, sum(size)::bigint as source_size from n group by source),
s1 as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from s0),
s2 as (select *, 2 * source_size as cap, (2 * source_size) / weight as room from s1),
s3 as (
  select *, (sum(source_size) over () * cast(1.5 as double)
             - coalesce(sum(cap) over (order by room, source nulls last rows between unbounded preceding and 1 preceding), 0))
          / (sum(weight) over ()
             - coalesce(sum(weight) over (order by room, source nulls last rows between unbounded preceding and 1 preceding), 0)) as level
  from s2
),
s4 as (select *, (min(case when level <= room then {'room': room, 'level': level} end) over ()).level as lv from s3),
s5 as (select source, source_size, least(cap::double, coalesce(lv * weight, 'infinity'::double)) as target from s4),
s6 as (select *, round(sum(target) over () / 64)::bigint as seats, sum(target) over () as votes from s5),
-- blocks of a source: seats go to the highest of the quotients target / (2k - 1)
s7 as (
  select source, k, row_number() over (order by target / (2 * k - 1) desc, source nulls last, k) as rank, seats
  from (select source, target, seats, unnest(range(1, (target / 64)::bigint + seats // 50 + 20)) as k from s6)
),
s8 as (select source, count(*) as blocks from s7 where rank <= seats group by source),
s9 as (
  select s6.source, s6.source_size, s6.target, coalesce(s8.blocks, 0) as blocks,
         greatest(1, ceil(s6.source_size / 2000000))::bigint as n_shards
  from s6 left join s8 on s6.source is not distinct from s8.source
),
d as (
  select n.doc_id, n.size, n.pick, s9.source, s9.source_size, s9.target, s9.blocks,
         ('0x' || substr(n.pick, 1, 8))::bigint % s9.n_shards as shard
  from n join s9 on n.source is not distinct from s9.source
),
q0 as (select source, shard, blocks, sum(size)::bigint as shard_size from d group by all),
q1 as (
  select source, shard, blocks, row_number() over (partition by source order by shard_size / (2 * k - 1) desc, shard, k) as rank
  from (select *, unnest(range(1, (shard_size * 2 // 64)::bigint + 20)) as k from q0)
),
q2 as (select source, shard, count(*) as quota from q1 where rank <= blocks group by source, shard),
q as (
  select q0.source, q0.shard, shard_size, least(coalesce(quota, 0) * 64, 2 * shard_size) as room
  from q0 left join q2 on q0.source is not distinct from q2.source and q0.shard = q2.shard
),
t as (
  select d.doc_id, d.size, d.source_size, d.target, q.room, q.shard_size,
         sum(d.size) over (partition by d.source, d.shard order by d.pick rows between unbounded preceding and current row) - d.size as start
  from d join q on d.source is not distinct from q.source and d.shard = q.shard
)
select doc_id, size, source_size, target,
       (case when size > 0 then (room // shard_size) * size
             + greatest(0, least(size, room - (room // shard_size) * shard_size - start)) else 0 end)::bigint as taken
from t
"""
