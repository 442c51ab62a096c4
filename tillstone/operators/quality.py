"""Row-level quality operators: survivors, rejects, audits and reference checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def total_order(columns, keys, latest_by=()) -> list[Column]:
    """Newest first by the ``latest_by`` columns, then by all columns that are left: no two different rows tie."""
    rest = [c for c in columns if c not in keys and c not in latest_by]
    return [_named(c).desc_nulls_last() for c in latest_by] + [_named(c).asc_nulls_last() for c in rest]


def keep_one(df: DataFrame, keys, latest_by=(), prefer: Sequence[Column] = ()) -> DataFrame:
    """One row per key (NULL keys group together), chosen by a total order.

    The largest values of ``prefer`` come first, then the newest by the
    ``latest_by`` columns; all remaining columns break ties, so the survivor
    is the same on every run. The ``rn = 1`` filter lets Spark keep one row
    per key *before* the shuffle, so a key with a huge number of copies
    reaches its reducer as one row per map task.
    """
    order = [c.desc_nulls_last() for c in prefer] + total_order(df.columns, keys, latest_by)
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*[_named(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def losers(df: DataFrame, survivors: DataFrame) -> DataFrame:
    """The rows of ``df`` that are not in ``survivors``, with the number of ``copies`` lost.

    A multiset difference by counting: equal rows are added up before the
    shuffle, so neither a hot key nor a mass of equal rows meets in one task.
    """
    counted = df.withColumn("_n", F.lit(1)).unionByName(survivors.withColumn("_n", F.lit(-1)))
    return (
        counted.groupBy(*[_named(c) for c in df.columns])
        .agg(F.sum("_n").alias("copies"))
        .filter("copies > 0")
    )


def all_present(columns) -> Column:
    return reduce(lambda a, b: a & b, [_named(c).isNotNull() for c in columns])


def require_not_null(df: DataFrame, columns) -> DataFrame:
    return df.filter(all_present(columns))


def keep_complete(df: DataFrame, mandatory, keys, latest_by=()) -> DataFrame:
    """One row per key among the rows that have all mandatory columns.

    Complete rows are preferred and the check comes after the window: below
    it, the filter would be pushed through the projection that parses the
    columns and every one of them would be parsed twice.
    """
    return require_not_null(keep_one(df, keys, latest_by, [all_present(mandatory)]), mandatory)


def failed_columns(columns) -> Column:
    """Comma-separated names of the mandatory columns that are NULL."""
    return F.concat_ws(",", *[F.when(_named(c).isNull(), F.lit(c)) for c in columns])


RULE = "rule"
#: Writes a table of repeated keys; the table read back, and its number of rows.
Keep = Callable[[DataFrame], tuple[DataFrame, int]]
#: So many repeated keys are sent to every task, and from so many copies on a key is dealt out.
FEW_KEYS, MANY_COPIES = 500_000, 10_000


def triage(
    df: DataFrame,
    mandatory,
    keys,
    latest_by=(),
    prefer: Sequence[Column] = (),
    refuse: dict[str, Column] | None = None,
    order_columns=None,
    salts: int = 8,
    keep: Keep | None = None,
    cluster: Column | None = None,
    cells: int = 16,
) -> DataFrame:
    """``df`` with ``rule``: what a row fails, NULL for the one row of each key that stays.

    ``refuse`` names conditions that rule a row out before the mandatory columns
    are looked at. The survivor is that of ``keep_one`` (of the rows that
    fail nothing), by a total order over ``order_columns`` (default: all).
    One window over salted keys ranks copies where they are dealt, a second one
    ranks the winners of the salts; a row that is out goes on under a number of its
    own. So neither a hot key nor a mass of rows without a key meets in one task.

    With ``keep`` the hashes of repeated keys are found and kept first, and ``df`` is read again for
    what they tell: where they are few, only rows of such keys are ranked and moved. Else a window over
    the keys moves each row once, and only keys of very many copies go through the two salted ones.
    ``cluster``, which follows from the keys, then brings rows of one value into at most ``cells`` tasks.
    """
    missing = failed_columns(mandatory)
    failed = F.when(missing != "", F.concat(F.lit("null:"), missing))
    for rule, bad in reversed((refuse or {}).items()):
        failed = F.when(bad, F.lit(rule)).otherwise(failed)
    ranks = {f"_prefer{i}": c for i, c in enumerate(prefer)}
    order = [F.col(c).desc_nulls_last() for c in ranks] + total_order(order_columns or df.columns, keys, latest_by) + [F.col("_row")]
    columns = df.columns

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.withColumns(ranks | {RULE: failed, "_row": F.monotonically_increasing_id()})

    if keep is None:
        return _ranked_by_salts(numbered(df), columns, keys, order, salts)
    # Rows that lack a column are out whatever else they have; their keys need no count.
    key = F.when(all_present(mandatory), F.xxhash64(*[_named(k) for k in keys]))
    # Rows without a key share one group, counted as none: a filter of them would spell the key out a second time.
    counted = df.select(key.alias("_key")).groupBy("_key").agg(F.count("_key").alias("_copies"))
    repeated, n = keep(counted.filter("_copies > 1"))
    if n == 0:
        return df.select(*[_named(c) for c in columns], failed.alias(RULE))
    # Rules and ranks are read off the rows after they are chosen by their keys: not for each row of both reads.
    # Bound to the row it is read off (the numbers are never below zero), a key is no expression that joins and
    # filters could be pushed below the reading of its columns with: there it would be spelled out once more for each.
    rows = df.withColumn("_key", F.when(F.monotonically_increasing_id() >= 0, key))
    if n <= FEW_KEYS:
        few = F.broadcast(repeated.select("_key"))
        alone = rows.join(few, "_key", "left_anti").select(*[_named(c) for c in columns], failed.alias(RULE))
        return alone.unionByName(_ranked_by_salts(numbered(rows.join(few, "_key", "left_semi")), columns, keys, order, salts))
    hot = F.broadcast(repeated.filter(F.col("_copies") > MANY_COPIES).select("_key"))
    usual = numbered(rows.join(hot, "_key", "left_anti"))
    # A row that is out goes on under a number of its own, so that such rows do not meet either.
    stays = F.col(RULE).isNull()
    groups = [*map(_named, keys), F.col("_own")]
    usual = usual.withColumn("_own", F.when(~stays, F.col("_row")))
    if cluster is not None:
        cell = F.when(stays, F.pmod("_key", F.lit(cells))).otherwise(F.col("_row"))
        usual = usual.withColumns({"_cluster": F.when(stays, cluster), "_cell": cell}).repartition("_cluster", "_cell")
        groups = [F.col("_cluster"), F.col("_cell"), *groups]
    usual = usual.withColumn("_rank", F.row_number().over(_within(groups, order)))
    usual = _with_copies(usual, columns, keys, F.col("_rank") > 1)
    return usual.unionByName(_ranked_by_salts(numbered(rows.join(hot, "_key", "left_semi")), columns, keys, order, salts))


def _within(groups: list[Column], order: list[Column]):
    return Window.partitionBy(*groups).orderBy(*order)


def _with_copies(rows: DataFrame, columns, keys, beaten: Column) -> DataFrame:
    copy = F.when(beaten, F.lit("duplicate:" + ",".join(keys)))
    return rows.select(*[_named(c) for c in columns], F.coalesce(F.col(RULE), copy).alias(RULE))


def _ranked_by_salts(rows: DataFrame, columns, keys, order: list[Column], salts: int) -> DataFrame:
    named = [_named(k) for k in keys]
    rows = rows.withColumn("_salt", F.when(F.col(RULE).isNull(), F.pmod("_row", F.lit(salts))).otherwise(F.col("_row") + salts))
    rows = rows.withColumn("_rank", F.row_number().over(_within([*named, F.col("_salt")], order)))
    stays = F.col(RULE).isNull() & (F.col("_rank") == 1)
    rows = rows.withColumn("_salt", F.when(~stays, F.col("_row")))
    rows = rows.withColumn("_last", F.row_number().over(_within([*named, F.col("_salt")], order)))
    return _with_copies(rows, columns, keys, (F.col("_rank") > 1) | (F.col("_last") > 1))


def split_rejects(df: DataFrame, mandatory, keys, latest_by=()) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and a log of every other row with the rule it failed and its copies."""
    valid = keep_complete(df, mandatory, keys, latest_by)
    missing = failed_columns(mandatory)
    rule = F.when(missing != "", F.concat(F.lit("null:"), missing)).otherwise(F.lit("duplicate:" + ",".join(keys)))
    return valid, losers(df, valid).withColumn("rule", rule)


def dq_audit(df: DataFrame, dataset: str, mandatory, keys) -> DataFrame:
    """Rows in, out and dropped per rule, from one scan and one pre-aggregated shuffle."""
    complete = all_present(mandatory)
    per_key = df.groupBy(*[_named(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(complete).alias("n_complete")
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("read"),
        F.coalesce(F.sum("n_complete"), F.lit(0)).alias("complete"),
        F.count_if(F.col("n_complete") > 0).alias("unique"),
    )
    steps = F.array(
        F.struct(F.lit("not_null").alias("rule"), F.col("read").alias("rows_in"), F.col("complete").alias("rows_out")),
        F.struct(F.lit("dedup").alias("rule"), F.col("complete").alias("rows_in"), F.col("unique").alias("rows_out")),
    )
    return totals.select(F.inline(steps)).select(
        F.lit(dataset).alias("dataset"), "rule", "rows_in", "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("dropped"),
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose (non-NULL) key is missing in the parent."""
    known = parent.select(_named(parent_key).alias("_parent")).filter("_parent is not null")
    with_key = child.filter(_named(child_key).isNotNull())
    return with_key.join(known, with_key[f"`{child_key}`"] == known["_parent"], "left_anti")


def with_parent(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key exists in the parent."""
    known = parent.select(_named(parent_key).alias("_parent"))
    return child.join(known, child[f"`{child_key}`"] == known["_parent"], "left_semi")


def orphan_keys(child: DataFrame, references) -> DataFrame:
    """Keys missing in their parents, with row counts, for all references of a child in one scan.

    ``references`` are ``(child_key, parent, parent_key, label)``. Counting
    comes first: a hot key is one row by the time it meets its parent. They meet in an aggregate, so no side
    is held in memory, however many keys the parents have and however small their files are.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("relation"), _named(key).cast("string").alias("orphan_key"))
            for key, _, _, label in references
        ]
    )
    counted = child.select(F.inline(pairs)).filter("orphan_key is not null").withColumn("_known", F.lit(0))
    known = [
        parent.select(F.lit(label).alias("relation"), _named(parent_key).cast("string").alias("orphan_key"), F.lit(1).alias("_known"))
        for _, parent, parent_key, label in references
    ]
    met = reduce(DataFrame.unionByName, known, counted).groupBy("relation", "orphan_key")
    rows = met.agg(F.count(F.lit(1)).alias("n_rows"), F.max("_known").alias("_known"))
    return rows.filter("_known = 0").drop("_known")


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that identify more than one row."""
    return df.groupBy(*[_named(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
