"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.session import new_workspace

#: The characters that part words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The folders written within each open ``passing`` block, innermost last.
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def settle(df: DataFrame, purpose: str, stays: bool = False) -> DataFrame:
    """``df`` written to the folder that the whole cluster shares, and read back.

    Cuts the lineage: what follows reads files, whichever executors are lost.
    Within ``passing`` the files go with the block, unless what is returned
    from it reads them and ``stays`` says so.
    """
    path = new_workspace(df.sparkSession, purpose)
    blocks = _passing.get()
    if blocks and not stays:
        blocks[-1].append(path)
    elif len(blocks) > 1:
        blocks[-2].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that are settled inside once their results are written."""
    own: list[str] = []
    token = _passing.set((*_passing.get(), own))
    try:
        yield
    finally:
        _passing.reset(token)
        for path in own:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that refers to a computed column may get its expression pasted in
    and evaluated for every element; the variable of an outer lambda does not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: str | Column) -> Column:
    """The text, a NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for NULL or blank text."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)),
    )


def count_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def spare(names: Iterable[str], wanted: str) -> str:
    """A column name that is not among ``names`` (in either case)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def strip_lines(docs: DataFrame, hits: DataFrame, counted: str | None = None, key_of: Column | None = None) -> DataFrame:
    """``docs`` without the lines that ``hits`` names; ``counted`` adds a column with their number.

    ``hits`` has one row for each (``doc_id``, ``text_hash``) with the numbers
    of its lines, from 0, in ``lines``; ``text_hash`` is a hash of the text, or
    ``key_of`` where the caller's rows have that. Documents without a hit pass unchanged.
    ``n_chars`` follows the text where the table has it.
    """
    key, hit, gone, found = (spare(docs.columns, n) for n in ("text_hash", "hit_hash", "gone_lines", "found_id"))
    hits = hits.select(F.col("doc_id").alias(found), F.col("text_hash").alias(hit), F.col("lines").alias(gone))
    joined = docs.withColumn(key, F.xxhash64("text") if key_of is None else key_of).join(
        hits, same(F.col("doc_id"), F.col(found)) & (F.col(key) == F.col(hit)), "left"
    )
    kept = let(
        F.split("text", "\n"),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)), lambda i: F.get(lines, i)
            ),
            "\n",
        ),
    )
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias("text"))
        elif name == "n_chars":
            length = F.length(text).cast(docs.schema["n_chars"].dataType)
            columns.append(F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(length).alias("n_chars"))
        else:
            columns.append(F.col(f"`{name}`"))
    if counted:
        columns.append(F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(counted))
    return joined.select(*columns)
