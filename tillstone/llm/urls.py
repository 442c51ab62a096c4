"""URL filters: rules first, then naive Bayes over words segmented from host and path.

Host and path names run words together. A unigram model counted over the pages'
own text splits them by Viterbi; the words of all their parts are looked up by a
join, so the model may be of any size. Multinomial naive Bayes learns from the pages that
a rule decides and judges the others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import same, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PARTS = r"\p{L}+|[0-9]+"

#: (verdict, host, path): the rules of the filter.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Words:
    """``longest`` letters of a word at most; a word never seen is one of ``unseen`` added to the words counted, ten times rarer for each letter."""

    longest: int = 24
    unseen: float = 10.0


def parsed(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, rule_verdict). The longest rule that fits wins, then the first in order."""
    url = F.coalesce("url", F.lit(""))
    rows = pages.select(
        "page_id",
        F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, URL, 2).alias("path"),
    )
    rule = verdict = F
    for v, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule, verdict = rule.when(fits, F.lit(host + path)), verdict.when(fits, F.lit(v))
    none = F.lit(None).cast("string")
    return rows.select("*", (rule if rules else none).alias("rule"), (verdict if rules else none).alias("rule_verdict"))


def unigrams(pages: DataFrame, how: Words) -> DataFrame:
    """(word, n): how often each word occurs in the pages' text, outside tags."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<[^>]*>", " "))
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return words.filter(F.length("word") <= how.longest).groupBy("word").agg(F.count("*").alias("n"))


def segmented(parts: DataFrame, known: DataFrame, how: Words) -> DataFrame:
    """(part, words): each distinct run of letters, split into its likeliest words."""
    total = known.agg(F.sum("n")).first()[0] or 0
    spots = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length("part")),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(how.longest), F.length("part") - i + 1)),
                lambda n: F.struct(i.alias("at"), F.substring(F.col("part"), i, n).alias("word")),
            ),
        )
    )
    found = (
        parts.select("part", F.explode(spots).alias("x"))
        .select("part", "x.at", F.col("x.word").alias("w"))
        .join(known, F.col("w") == F.col("word"))
        .groupBy(F.col("part").alias("f_part"))
        .agg(F.collect_list(F.struct((F.col("at") - 1).alias("at"), F.length("w").alias("size"), "n")).alias("known"))
    )
    whole = parts.join(found, F.col("part") == F.col("f_part"), "left").select("part", "known")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [
                viterbi(p, {(k["at"], k["size"]): k["n"] for k in ks} if ks is not None else {}, total, how)
                for p, ks in zip(batch["part"], batch["known"])
            ]
            yield pd.DataFrame({"part": batch["part"], "words": words})

    return whole.mapInPandas(run, "part string, words array<string>")


def viterbi(part: str, known: dict[tuple[int, int], int], total: int, how: Words) -> list[str]:
    """The split with the highest product of word probabilities; the one with the longer last word of equals."""
    best, back = [0.0], [0]
    for end in range(1, len(part) + 1):
        choices = []
        for size in range(1, min(how.longest, end) + 1):
            n = known.get((end - size, size))
            log = math.log((n or how.unseen) / (total + how.unseen)) - (0 if n else size * math.log(10))
            choices.append((best[end - size] + log, size))
        score, size = max(choices)
        best.append(score)
        back.append(size)
    words, end = [], len(part)
    while end:
        words.append(part[end - back[end] : end])
        end -= back[end]
    return words[::-1]


def tokens_of(side: str, words: Column) -> Column:
    """Words of the host or the path; a number counts as its length."""
    return F.transform(words, lambda w: F.concat(F.lit(f"{side}:"), F.regexp_replace(w, "[0-9]", "0")))


def spelled(names: DataFrame, split: DataFrame) -> DataFrame:
    """(name, words): the parts of each distinct name in order, each as the words ``split`` has for it, else as it is."""
    return (
        names.select("name", F.posexplode("parts").alias("i", "part"))
        .join(split, F.col("part") == F.col("s_part"), "left")
        .groupBy(F.col("name").alias("w_name"))
        .agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("words", F.array("part")).alias("words")))).alias("x"))
        .select("w_name", F.flatten(F.transform("x", lambda x: x.words)).alias("words"))
    )


def tokenized(urls: DataFrame, pages: DataFrame, how: Words) -> DataFrame:
    """``urls`` (distinct host, path) with ``tokens``, in order: the words of the host, then of the path."""
    names = urls.select(F.explode(F.array("host", "path")).alias("name")).distinct()
    names = settle(names.select("name", F.regexp_extract_all(F.lower("name"), F.lit(PARTS), F.lit(0)).alias("parts")), "url-names")
    parts = names.select(F.explode("parts").alias("part")).distinct()
    split = segmented(parts.filter(F.rlike("part", F.lit("[^0-9]"))), settle(unigrams(pages, how), "url-words"), how)
    words = settle(spelled(names, settle(split, "url-parts").withColumnRenamed("part", "s_part")), "url-name-words")
    none, tokens = F.array().cast("array<string>"), []
    for side in ("host", "path"):
        own = words.select(F.col("w_name").alias(f"{side}_name"), F.col("words").alias(f"{side}_words"))
        urls = urls.join(own, F.col(side) == F.col(f"{side}_name"), "left")
        tokens.append(tokens_of(side[0], F.coalesce(f"{side}_words", none)))
    return urls.select("host", "path", "label", "n", F.concat(*tokens).alias("tokens"))


def judge(pages: DataFrame, rules: tuple = RULES, how: Words = Words()) -> DataFrame:
    """(page_id, host, path, rule, verdict, words, score) for every row of ``pages``.

    A NULL url, or one without ``://``, has an empty host and path and no words.
    ``score`` is the log odds for block by naive Bayes, rounded; above 0 it
    blocks. Without any page that a rule decides, all scores are 0. Words the
    model has not seen count for neither side. Repeated rows are judged alike.
    """
    rows = settle(parsed(pages, rules), "url-rows")
    urls = rows.groupBy("host", "path").agg(F.first("rule_verdict").alias("label"), F.count("*").alias("n"))
    urls = settle(tokenized(urls, pages, how), "url-tokens")
    learned = urls.filter("label is not null").select("label", "n", F.explode("tokens").alias("token"))
    side = {v: F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)) for v in ("allow", "block")}
    counts = settle(learned.groupBy("token").agg(side["allow"].alias("allow"), side["block"].alias("block")), "url-counts")
    sums = counts.agg(F.count("*"), F.sum("allow"), F.sum("block")).first()
    size, allow, block = (x or 0 for x in sums)
    seen = dict(urls.filter("label is not null").groupBy("label").agg(F.sum("n")).collect())
    prior = math.log((seen.get("block", 0) + 1) / (seen.get("allow", 0) + 1))
    weight = F.log((F.col("block") + 1) / (block + size)) - F.log((F.col("allow") + 1) / (allow + size)) if size else F.lit(0.0)
    weights = counts.select(F.col("token").alias("t"), weight.alias("weight"))
    scores = (
        urls.select("host", "path", F.explode("tokens").alias("token"))
        .join(weights, F.col("token") == F.col("t"))
        .groupBy(F.col("host").alias("s_host"), F.col("path").alias("s_path"))
        .agg(F.sum("weight").alias("sum"))
    )
    known = urls.select(F.col("host").alias("u_host"), F.col("path").alias("u_path"), "tokens")
    known = known.join(scores, (F.col("u_host") == F.col("s_host")) & (F.col("u_path") == F.col("s_path")), "left")
    known = settle(
        known.select("u_host", "u_path", F.array_join("tokens", " ").alias("words"), F.round(F.coalesce("sum", F.lit(0.0)) + prior, 6).alias("score")),
        "url-scores",
    )
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return rows.join(known, same(F.col("host"), F.col("u_host")) & same(F.col("path"), F.col("u_path"))).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "words", "score"
    )


def op3(pages: DataFrame) -> DataFrame:
    return judge(pages)
