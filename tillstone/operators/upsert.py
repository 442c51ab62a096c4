"""Keyed upserts: update the rows that match, insert the others, delete nothing.

An upsert is one full outer join on the key, the same plan for a batch of any
size. Marker columns keep "no source row" and "source value is NULL" apart. A NULL key matches nothing: require the key
first if reruns must not insert it again.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.operators.quality import all_present, keep_one

ACTION = "_action"
_MATCHED = "source._in_source IS NOT NULL AND target._in_target IS NOT NULL"
_NEW = "source._in_source IS NOT NULL AND target._in_target IS NULL"
#: What becomes of a joined row: 1 is a new one, 2 a changed one, 0 one that stays.
MET, _INSERT, _UPDATE = "_met", 1, 2


class Upsert:
    """Fluent form: ``Upsert(target).using(source).on("id").when_matched_update(...).when_not_matched_insert(...)``.

    Assignments map a target column to an expression over ``source.x`` and
    ``target.x``, as text or as a Column. Without a map, a clause assigns all
    columns of the target from the source columns of the same name.
    """

    def __init__(self, target: DataFrame):
        self._target = target
        self._source: DataFrame | None = None
        self._keys: tuple[str, ...] = ()
        self._updates: dict[str, str | Column] | None = None
        self._condition: str | None = None
        self._inserts: dict[str, str | Column] | None = None
        self._duplicates = "error"
        self._latest_by: tuple[str, ...] = ()

    def using(self, source: DataFrame) -> Upsert:
        self._source = source
        return self

    def on(self, *keys: str) -> Upsert:
        self._keys = keys
        return self

    def duplicates(self, policy: str, latest_by=()) -> Upsert:
        """What to do with several source rows for one key.

        ``error`` (default) fails the job, ``latest`` takes the newest row,
        ``unique`` trusts the caller that keys are unique and not NULL.
        """
        if policy not in ("error", "latest", "unique"):
            raise ValueError(f"unknown duplicate policy {policy!r}")
        self._duplicates, self._latest_by = policy, tuple(latest_by)
        return self

    def when_matched_update(
        self, assignments: dict[str, str | Column] | None = None, condition: str | None = None
    ) -> Upsert:
        """Update matched rows, or of these only the ones for which ``condition`` (over ``source.x`` and ``target.x``) is true."""
        self._updates = self._all_from_source(self._non_keys()) if assignments is None else dict(assignments)
        self._condition = condition
        return self

    def when_not_matched_insert(self, assignments: dict[str, str | Column] | None = None) -> Upsert:
        self._inserts = self._all_from_source(self._target.columns) if assignments is None else dict(assignments)
        return self

    def _non_keys(self) -> list[str]:
        return [c for c in self._target.columns if c not in self._keys]

    def _all_from_source(self, columns) -> dict[str, str]:
        available = set(self._source.columns)
        return {c: _from_source(c) for c in columns if c in available}

    def _marked_source(self) -> DataFrame:
        """Source rows with the marker column, at most one per key."""
        if self._duplicates == "unique":
            return self._source.withColumn("_in_source", F.lit(True))
        keyed = self._source.filter(all_present(self._keys))
        if self._duplicates == "latest":
            return keep_one(keyed, self._keys, self._latest_by).withColumn("_in_source", F.lit(True))
        return keyed.withColumn("_in_source", _true_unless_repeated(self._keys))

    def with_actions(self) -> DataFrame:
        """The merged rows with ``_action``: insert, update or keep."""
        if self._source is None or not self._keys:
            raise ValueError("an upsert needs using(source) and on(keys)")
        source = self._marked_source()
        merged = self._joined(source)
        if self._inserts is None or self._duplicates == "unique":
            return merged
        nulls = self._as_inserts(self._source.filter(~all_present(self._keys)))
        return merged.unionByName(nulls)

    def _joined(self, source: DataFrame) -> DataFrame:
        """One pass over both sides; rows of the source alone are the inserts."""
        how = "full_outer" if self._inserts is not None else "left_outer"
        joined = self._marked_target().join(source.alias("source"), self._same_key(), how)
        # Told once for each row: spelled out in every column it makes methods too large to be compiled.
        told = joined.withColumn(MET, F.expr(f"CASE WHEN {_NEW} THEN {_INSERT} WHEN {self._matched()} THEN {_UPDATE} ELSE 0 END"))
        return told.select(*[self._assigned(f) for f in self._target.schema], self._action())

    def _marked_target(self) -> DataFrame:
        return self._target.withColumn("_in_target", F.lit(True)).alias("target")

    def _matched(self) -> str:
        return _MATCHED if self._condition is None else f"{_MATCHED} AND ({self._condition})"

    def _same_key(self) -> Column:
        return F.expr(" AND ".join(f"target.`{k}` = source.`{k}`" for k in self._keys))

    def _assigned(self, field: T.StructField) -> Column:
        """The column after the merge: the assigned value in a new or matched row, else what the target has."""
        branches = []
        if self._inserts is not None:
            branches.append((f"{MET} = {_INSERT}", self._inserts.get(field.name, "null")))
        if field.name in (self._updates or {}):
            branches.append((f"{MET} = {_UPDATE}", self._updates[field.name]))
        if len(branches) == 2 and isinstance(branches[0][1], str) and branches[0][1] == branches[1][1]:
            branches = [(f"{MET} > 0", branches[0][1])]
        kept = f"target.`{field.name}`"
        if all(isinstance(value, str) for _, value in branches):
            # One text instead of many small calls: building wide merges is noticeably faster.
            kind = field.dataType.simpleString()
            cases = "".join(f" WHEN {when} THEN CAST({value} AS {kind})" for when, value in branches)
            return F.expr(f"CASE{cases} ELSE {kept} END" if cases else kept).alias(field.name)
        out = F.col(kept)
        for when, value in reversed(branches):
            out = F.when(F.expr(when), _typed(value, field)).otherwise(out)
        return out.alias(field.name)

    def _action(self) -> Column:
        on_match = "keep" if self._updates is None else "update"
        return F.expr(f"CASE WHEN {MET} = {_INSERT} THEN 'insert' WHEN {MET} = {_UPDATE} THEN '{on_match}' ELSE 'keep' END AS {ACTION}")

    def _as_inserts(self, rows: DataFrame) -> DataFrame:
        """Source rows that are known to match nothing, as inserted rows."""
        no_target = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._target.schema]
        paired = rows.select(
            F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("source"), F.struct(*no_target).alias("target")
        )
        values = [_typed(self._inserts.get(f.name, "null"), f).alias(f.name) for f in self._target.schema]
        return paired.select(*values, F.lit("insert").alias(ACTION))

    def to_df(self) -> DataFrame:
        return self.with_actions().drop(ACTION)

    def into_catalog_table(self, table: str) -> None:
        """The same merge on a table of a catalog with row-level operations, which rewrites only the files it must."""
        source = self._marked_source().filter("_in_source").drop("_in_source").alias("source")
        pairs = [F.col(f"{table}.`{k}`") == F.col(f"source.`{k}`") for k in self._keys]
        writer = source.mergeInto(table, reduce(lambda a, b: a & b, pairs))
        if self._updates is not None:
            condition = None if self._condition is None else F.expr(in_catalog(self._condition, table))
            writer = writer.whenMatched(condition).update(self._catalog_assignments(self._updates, table))
        if self._inserts is not None:
            writer = writer.whenNotMatched().insert(self._catalog_assignments(self._inserts, table))
        writer.merge()


    @staticmethod
    def _catalog_assignments(values: dict[str, str | Column], table: str) -> dict[str, Column]:
        return {c: F.expr(in_catalog(v, table)) if isinstance(v, str) else v for c, v in values.items()}


def in_catalog(text: str, table: str) -> str:
    """An expression over ``target.x`` as a catalog knows it, by the name of the table; quoted text stays."""
    pieces = re.split(r"('(?:[^'\\]|\\.)*')", text)
    known = re.compile(r"(?<![\w.`])`?target`?\s*\.\s*(?=[\w`])", re.IGNORECASE)
    return "".join(p if p.startswith("'") else known.sub(lambda _: f"{table}.", p) for p in pieces)


def _expression(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _typed(value: str | Column, field: T.StructField) -> Column:
    return _expression(value).cast(field.dataType)


def _from_source(column: str) -> str:
    return f"source.`{column}`"


def _true_unless_repeated(keys) -> Column:
    """True, or a failure of the job where several rows share the key.

    The window needs the partitioning and order the join asks for anyway, so
    the check adds no shuffle and no second pass.
    """
    named = [F.col(f"`{k}`") for k in keys]
    copies = F.count(F.lit(1)).over(Window.partitionBy(*named))
    message = F.concat(F.lit("several source rows for one key: "), F.to_json(F.struct(*named)))
    return F.when(copies > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys,
    update_cols=None,
    overrides: dict[str, Column] | None = None,
    duplicates: str = "error",
    latest_by=(),
    with_actions: bool = False,
    condition: str | None = None,
) -> DataFrame:
    """``target`` after merging ``source`` on ``keys``.

    ``update_cols`` limits what a match changes, ``condition`` which matches
    change anything; ``overrides`` sets columns (such as ``processing_date``)
    of every inserted or updated row.
    """
    overrides = overrides or {}
    available = set(source.columns)
    changed = [c for c in target.columns if c not in keys] if update_cols is None else list(update_cols)
    updates = {c: _from_source(c) for c in changed if c in available} | overrides
    inserts = {c: _from_source(c) for c in target.columns if c in available} | overrides
    merge = (
        Upsert(target)
        .using(source)
        .on(*keys)
        .duplicates(duplicates, latest_by)
        .when_matched_update(updates, condition)
        .when_not_matched_insert(inserts)
    )
    return merge.with_actions() if with_actions else merge.to_df()


def merge_metrics(merged: DataFrame) -> DataFrame:
    """Inserted, updated, deleted, affected and total rows of a merge that kept its ``_action``."""
    inserted, updated = F.count_if(F.col(ACTION) == "insert"), F.count_if(F.col(ACTION) == "update")
    deleted = F.lit(0).cast("bigint")
    return merged.agg(
        inserted.alias("rows_inserted"),
        updated.alias("rows_updated"),
        deleted.alias("rows_deleted"),
        (inserted + updated).alias("rows_affected"),
        F.count(F.lit(1)).alias("total_rows"),
    )
