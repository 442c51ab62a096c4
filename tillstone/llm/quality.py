"""Quality rules: word statistics of each text and line frequency across the documents of a host.

All of it is column expressions. Repeated windows are found by sorting one
packed number per window inside the row; lines are counted by their hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import GAP, let, passing, same, settle, spare, strip_lines, whole, words_of

SYMBOLS = "#*$%&|<>"
#: Low bits of a packed window hold its position, the rest a part of its hash.
POSITION_BITS = 28


@dataclass(frozen=True)
class Limits:
    """``min_words`` and ``max_repeat_pct`` fail a text by itself. A line is above the limit of its host if more
    than ``host_share`` of the host's distinct documents have it, and at least ``min_documents``; a text that loses
    more than ``max_lost_pct`` of its words with such lines is depleted."""

    min_words: int = 50
    max_repeat_pct: int = 50
    host_share: float = 0.1
    min_documents: int = 5
    max_lost_pct: int = 50


def repeat_words(words: Column) -> Column:
    """How many words lie in a window of three words that occurs twice or more in the text."""

    def window(w: Column, i: Column) -> Column:
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def packed(w: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.shiftleft(window(w, i), POSITION_BITS).bitwiseOR(i.cast("long")),
            )
        )

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")

    def equal(w: Column, a: Column, b: Column) -> Column:
        """Whether two neighbours in the sorted list are the same words, not only the same part of a hash."""
        close = F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)
        alike = [F.get(w, place(a) + k) == F.get(w, place(b) + k) for k in range(3)]
        return F.coalesce(close & alike[0] & alike[1] & alike[2], F.lit(False))

    def starts(w: Column, p: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.filter(p, lambda x, k: equal(w, x, F.get(p, k - 1)) | equal(w, x, F.get(p, k + 1))), place
            )
        )

    def covered(s: Column) -> Column:
        steps = F.transform(s, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x)

    return let(
        words,
        lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
            let(packed(w), lambda p: let(starts(w, p), covered))
        ),
    )


def normal_line(line: Column) -> Column:
    """Lower case, digits as 0, white space as one blank."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), GAP, " "))


def measure(docs: DataFrame) -> DataFrame:
    """One narrow row per document: statistics, and for each line its hash and number of words (no text)."""
    text, host = whole("text"), F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    lines = F.split(text, "\n")
    worded = F.filter(lines, lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    facts = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    per_line = F.transform(
        lines, lambda x: let(normal_line(x), lambda n: F.struct(F.xxhash64(n).alias("h"), _words_in(n).alias("w")))
    )
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        host.alias("host"),
        F.xxhash64(whole("text")).alias("text_hash"),
        place_hash(docs).alias("place_hash"),
        facts.alias("facts"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(worded, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        per_line.alias("lines"),
    ).select("row", "doc_id", "host", "text_hash", "place_hash", "facts.*", "n_symbols", "n_dup_lines", "lines")


def place_hash(docs: DataFrame) -> Column:
    """Tells the texts of one ``doc_id`` apart, also equal ones of different hosts, which are judged by different limits."""
    return F.xxhash64("text", F.lit(1), "source") if "source" in docs.columns else F.xxhash64("text")


def _words_in(normal: Column) -> Column:
    return F.when(normal == "", 0).otherwise(F.length(normal) - F.length(F.translate(normal, " ", "")) + 1)


def frequent_lines(rows: DataFrame, limits: Limits) -> DataFrame:
    """(host, h) of the lines above the limit. Exact copies within a host count as one document."""
    texts = rows.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    sizes = texts.groupBy("host").agg(F.count("*").alias("documents"))
    lines = texts.select(
        "host", F.explode(F.array_distinct(F.transform(F.filter("lines", lambda x: x.w > 0), lambda x: x.h))).alias("h")
    )
    counts = lines.groupBy("host", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= limits.min_documents)
    sizes = sizes.withColumnRenamed("host", "of_host")
    return (
        counts.join(sizes, same(F.col("host"), F.col("of_host")))
        .filter(F.col("n") > F.col("documents") * F.lit(limits.host_share))
        .select("host", "h")
    )


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: statistics, ``base_failed``, ``kept``, and ``gone``, the numbers of its lines above the limit.

    A NULL or empty text has no words and fails; NULL hosts are one host.
    Repeated rows are judged row by row, other columns are not looked at.
    """
    rows = settle(measure(docs), "quality-lines")
    above = settle(frequent_lines(rows, limits), "quality-above").withColumnsRenamed({"host": "a_host", "h": "a_h"})
    lost = (
        rows.select("row", "host", F.posexplode("lines").alias("i", "line"))
        .select("row", "host", "i", "line.h", "line.w")
        .filter("w > 0")
        .join(above, same(F.col("host"), F.col("a_host")) & (F.col("h") == F.col("a_h")))
        .groupBy(F.col("row").alias("l_row"))
        .agg(F.sum("w").alias("lost"), F.collect_list("i").alias("gone"))
    )
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_pct * F.col("n_words")
    )
    depleted = 100 * F.coalesce("lost", F.lit(0)) > limits.max_lost_pct * F.col("n_words")
    return (
        rows.drop("lines", "host")
        .join(lost, F.col("row") == F.col("l_row"), "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .drop("l_row", "row")
    )


def screen(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` without rejected documents and, in the others, without the lines above the limit.

    Lines are only taken from documents that stay, and all columns are kept.
    """
    with passing(docs.sparkSession):
        verdicts = settle(judge(docs, limits).select("doc_id", F.col("place_hash").alias("text_hash"), "kept", "gone"), "quality-verdicts", stays=True)
    bad = verdicts.filter(~F.col("kept")).select("doc_id", "text_hash").distinct()
    hits = verdicts.filter("kept and gone is not null").dropDuplicates(["doc_id", "text_hash"])
    key, bad_id = spare(docs.columns, "text_hash"), spare(docs.columns, "bad_id")
    bad = bad.select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(key + "_bad"))
    good = docs.withColumn(key, place_hash(docs)).join(
        bad, same(F.col("doc_id"), F.col(bad_id)) & (F.col(key) == F.col(key + "_bad")), "left_anti"
    )
    return strip_lines(good.drop(key), hits.select("doc_id", "text_hash", F.col("gone").alias("lines")), key_of=place_hash(docs))


def op5(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP5_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, string_split(coalesce(text, ''), chr(10)) as ls
  from documents
),
g as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)
),
s as (select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
rep as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from s) group by r),
raw as (select r, source, t, unnest(ls) as l from d),
dup as (
  select r, count(*) - count(distinct l) as n from raw where regexp_matches(l, '[^\x20\x09-\x0D]') group by r
),
ln as (
  select r, source, t, n, len(string_split(n, ' ')) as w
  from (select r, source, t,
               trim(regexp_replace(regexp_replace(lower(l), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) as n from raw)
  where n <> ''
),
hosts as (select source, count(distinct t) as documents from d group by source),
hot as (
  select c.source, c.n from (select source, n, count(distinct t) as k from ln group by source, n) c
  join hosts h on c.source is not distinct from h.source
  where c.k >= 5 and c.k > h.documents * cast(0.1 as double)
),
lost as (
  select ln.r, sum(ln.w) as w from ln join hot on ln.source is not distinct from hot.source and ln.n = hot.n group by ln.r
),
f as (
  select d.doc_id, len(d.w)::bigint as n_words, length(array_to_string(d.w, ''))::bigint as word_chars,
         (length(d.t) - length(translate(d.t, '#*$%&|<>', '')))::bigint as n_symbols,
         coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words, coalesce(lost.w, 0) as lost
  from d left join rep using (r) left join dup using (r) left join lost using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not (100 * lost > 50 * n_words) as kept
from f
"""
