"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its leading tokens;
tokens with a digit are variable fields from the start. In a leaf that enough
documents share, a token that is rare at its place is a variable field too, and
a line that is mostly fixed tokens becomes a template. What no template fits is
split further by the tokens that many documents have, until nothing is left to
split. Lines of a template that recurs across documents are dropped, but for the
first document that has it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import let, passing, same, settle, spare, strip_lines, whole, words_of

FIELD = "<*>"
SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Tree:
    """``depth`` leading tokens below the token count. A token is fixed at its place if more than ``limit`` documents
    and at least ``token_share`` of the lines of the leaf, or of a part split off from it, have it there; a line needs
    ``similarity`` of its tokens fixed in one of these to be generalised, else it stands for itself, digits and all. A template in more
    than ``limit`` documents recurs; a line of ``long_words`` words or more, which no chance repeats, as it is spelled in
    ``long_limit`` documents or more (None: such lines are left to ``drop_passages``)."""

    depth: int = 3
    limit: int = 6
    token_share: float = 0.1
    similarity: float = 0.7
    long_words: int = 8
    long_limit: int | None = 2


def masked(line: Column) -> Column:
    """The tokens of a line, those with a digit as a variable field."""
    fields = F.regexp_replace(line, rf"(?<![^{SPACE}])[^{SPACE}0-9]*+[0-9][^{SPACE}]*+", FIELD)
    return words_of(F.when(F.rlike(line, F.lit("[0-9]")), fields).otherwise(line))


def parsed(docs: DataFrame, tree: Tree) -> DataFrame:
    """One row per distinct document: for each line with a token its number, leaf and the hashes of its tokens, masked and as they are."""
    lines = F.transform(
        F.split(whole("text"), "\n"),
        lambda x, i: let(
            masked(x),
            lambda t: F.struct(
                i.alias("i"),
                F.size(t).alias("n"),
                F.xxhash64(F.size(t), F.slice(t, 1, tree.depth)).alias("leaf"),
                F.xxhash64(t).alias("literal"),
                F.when(F.rlike(x, F.lit("[0-9]")), F.xxhash64(words_of(x))).otherwise(F.xxhash64(t)).alias("exact"),
            ),
        ),
    )
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.filter(lines, lambda x: x.n > 0).alias("lines"))


def busy_leaves(rows: DataFrame, tree: Tree) -> DataFrame:
    """Leaves that more than ``limit`` documents share; only there can a template recur."""
    leaves = rows.select(F.explode(F.array_distinct(F.transform("lines", lambda x: x.leaf))).alias("leaf"))
    return leaves.groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") > tree.limit).select("leaf")


def templates(docs: DataFrame, rows: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(doc_id, text_hash, i, template) of every line in a busy leaf; ``rows`` are the ``parsed`` lines of ``docs``."""
    busy = settle(busy_leaves(rows, tree), "template-leaves").withColumnRenamed("leaf", "b_leaf")
    found = (
        rows.select("doc_id", "text_hash", F.explode("lines").alias("x"))
        .select("doc_id", "text_hash", "x.i", "x.leaf", "x.literal", "x.exact")
        .join(busy, F.col("leaf") == F.col("b_leaf"))
        .drop("b_leaf")
    )
    found = settle(found, "template-found")
    # A leaf's distinct lines, each with the number of documents that have it, and one place where it stands.
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "i")
    distinct = found.groupBy("leaf", "literal").agg(
        F.count("*").alias("n_lines"), F.count_distinct("doc_id", "text_hash").alias("n_documents"), F.min(place).alias("place")
    )
    distinct = settle(distinct, "template-distinct")
    tokens = literals(docs, distinct.select("place.doc_id", "place.text_hash", "place.i", "leaf", "literal"))
    counted = distinct.select(F.col("leaf").alias("f_leaf"), F.col("literal").alias("f_literal"), "n_lines", "n_documents")
    known = tokens.join(counted, (F.col("leaf") == F.col("f_leaf")) & (F.col("literal") == F.col("f_literal"))).drop("f_leaf", "f_literal")
    known = settle(known, "template-known")
    named = settle(general_forms(known, tree), "template-general")
    return found.join(named, (F.col("leaf") == F.col("k_leaf")) & (F.col("literal") == F.col("k_literal")), "left").select(
        "doc_id", "text_hash", "i", F.coalesce("template", "exact").alias("template")
    )


def general_forms(known: DataFrame, tree: Tree) -> DataFrame:
    """(k_leaf, k_literal, template) of the lines that are similar enough to others of their leaf, or of a part of it.

    A part that is split off has less than ``token_share`` of the lines it comes
    from, and more than ``limit`` documents, so there are few rounds.
    """
    named, rest = None, known.withColumns({"part": F.col("leaf"), "weight": F.lit(0).cast("long")})
    while True:
        lines = settle(shaped(rest, tree), "template-shaped")
        # A line in several parts takes the form with the most fields, and goes on in the largest part if it has none.
        best = lines.filter("template is not null").groupBy(F.col("leaf").alias("k_leaf"), F.col("literal").alias("k_literal")).agg(
            F.min_by("template", F.struct("n_fixed", -F.col("weight"), "part")).alias("template")
        )
        named = best if named is None else named.union(best)
        left = lines.filter("template is null and tokens is not null").join(
            best, (F.col("leaf") == F.col("k_leaf")) & (F.col("literal") == F.col("k_literal")), "left_anti"
        )
        columns = F.struct("weight", "part", "tokens", "open", "n_lines", "n_documents")
        left = settle(left.groupBy("leaf", "literal").agg(F.max_by(columns, F.struct("weight", "part")).alias("x")), "template-left")
        rest = settle(split(left.select("leaf", "literal", "x.*"), tree), "template-parts")
        if rest.isEmpty():
            return named


def shaped(lines: DataFrame, tree: Tree) -> DataFrame:
    """``lines`` with ``template``, NULL where too few tokens are fixed in their part, and ``n_fixed``.

    ``tokens`` and those of them that are ``open`` (not fixed, else NULL) stay
    only for a line without a template in a part that is worth splitting.
    """
    places = lines.select("part", "n_lines", "n_documents", F.posexplode("tokens").alias("p", "token"))
    sizes = lines.groupBy(F.col("part").alias("s_part")).agg(F.sum("n_lines").alias("part_lines"))
    often = (F.col("documents") > tree.limit) & (F.col("n") >= F.col("part_lines") * F.lit(tree.token_share))
    fixed = (
        places.groupBy("part", "p", "token")
        .agg(F.sum("n_lines").alias("n"), F.sum("n_documents").alias("documents"))
        .join(sizes, F.col("part") == F.col("s_part"))
        # At most 1 / token_share tokens for each place; every place of the part has an entry.
        .groupBy("part", "p")
        .agg(F.collect_set(F.when(often, F.col("token"))).alias("fixed"), F.first("part_lines").alias("part_lines"))
        .groupBy(F.col("part").alias("x_part"))
        .agg(F.sort_array(F.collect_list(F.struct("p", "fixed"))).alias("places"), F.first("part_lines").alias("part_lines"))
    )
    fixed = settle(fixed, "template-fixed")
    general = F.transform(
        "tokens", lambda t, p: F.when(F.array_contains(F.get("places", p)["fixed"], t), t).otherwise(FIELD)
    )
    n_fixed = F.size(F.filter("general", lambda t: t != FIELD))
    wide = lines.join(fixed, F.col("part") == F.col("x_part")).withColumn("general", general).withColumn("n_fixed", n_fixed)
    like = F.col("n_fixed") >= F.lit(tree.similarity) * F.size("tokens")
    # Up to this size, all tokens in more than ``limit`` documents are fixed.
    worth = ~like & (F.col("part_lines") * F.lit(tree.token_share) > tree.limit)
    is_open = F.transform("tokens", lambda t, p: F.when(t != F.get("general", p), t))
    return wide.select(
        "part", "weight", "leaf", "literal", "n_lines", "n_documents", "n_fixed",
        F.when(like, F.xxhash64("leaf", "general")).alias("template"),
        F.when(worth, F.col("tokens")).alias("tokens"),
        F.when(worth, is_open).alias("open"),
    )


def split(lines: DataFrame, tree: Tree) -> DataFrame:
    """Each line once for each of its open tokens that more than ``limit`` documents of its part have at that place."""
    at = lines.select("part", "leaf", "literal", "n_documents", F.posexplode("open").alias("p", "token")).filter("token is not null")
    busy = at.groupBy(F.col("part").alias("b_part"), F.col("p").alias("b_p"), F.col("token").alias("b_token"))
    busy = settle(busy.agg(F.sum("n_documents").alias("weight")).filter(F.col("weight") > tree.limit), "template-splits")
    here = (F.col("part") == F.col("b_part")) & (F.col("p") == F.col("b_p")) & (F.col("token") == F.col("b_token"))
    parts = at.join(busy, here).select(
        F.col("leaf").alias("p_leaf"), F.col("literal").alias("p_literal"), F.xxhash64("part", "p", "token").alias("part"), "weight"
    )
    whole_lines = lines.select("leaf", "literal", "tokens", "n_lines", "n_documents")
    return whole_lines.join(parts, (F.col("leaf") == F.col("p_leaf")) & (F.col("literal") == F.col("p_literal"))).drop("p_leaf", "p_literal")


def literals(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The tokens of the lines at ``places`` (doc_id, text_hash, i), with their ``leaf`` and ``literal``; no other line is looked at."""
    here = places.groupBy(F.col("doc_id").alias("p_id"), F.col("text_hash").alias("p_hash")).agg(
        F.collect_list(F.struct("i", "leaf", "literal")).alias("places")
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    # One plan at every size: places are as many as there are distinct lines.
    texts = texts.join(here.hint("merge"), same(F.col("doc_id"), F.col("p_id")) & (F.col("text_hash") == F.col("p_hash")))
    lines = let(
        F.split(whole("text"), "\n"),
        lambda lines: F.transform("places", lambda p: F.struct(p.leaf.alias("leaf"), p.literal.alias("literal"), masked(F.get(lines, p.i)).alias("tokens"))),
    )
    # A repeated row brings its lines again.
    return texts.select(F.inline(lines)).groupBy("leaf", "literal").agg(F.first("tokens").alias("tokens"))


def recurring(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(doc_id, text_hash, lines): the numbers of the lines to drop, from 0, for each document that has some.

    NULL and empty texts and blank lines have no template. The first document
    of a template or a long line is the one with the smallest doc_id (NULL
    last), then hash; it keeps all its lines of it. Repeated rows are one document.
    """
    with passing(docs.sparkSession):
        rows = settle(parsed(docs, tree).dropDuplicates(["doc_id", "text_hash"]), "template-lines")
        gone = repeated(settle(templates(docs, rows, tree), "template-named"), tree.limit + 1)
        if tree.long_limit is not None:
            gone = gone.union(passages(rows, tree))
        return settle(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("i").alias("lines")), "template-hits", stays=True)


def passages(rows: DataFrame, tree: Tree) -> DataFrame:
    """(doc_id, text_hash, i) of the long lines to drop, as they are spelled."""
    long = rows.select("doc_id", "text_hash", F.explode(F.filter("lines", lambda x: x.n >= tree.long_words)).alias("x"))
    return repeated(long.select("doc_id", "text_hash", "x.i", F.col("x.exact").alias("template")), tree.long_limit)


def repeated(lines: DataFrame, least: int) -> DataFrame:
    """(doc_id, text_hash, i) of the lines whose template is in ``least`` documents or more, but for the first of these."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    if least == 2:  # two documents: the first is not the last
        last = F.max(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
        often = lines.groupBy(F.col("template").alias("t")).agg(first.alias("first"), last.alias("last"))
        often = often.filter(~F.col("first").eqNullSafe(F.col("last"))).select("t", "first")
    else:
        often = lines.groupBy(F.col("template").alias("t")).agg(
            F.count_distinct(F.struct("doc_id", "text_hash")).alias("documents"), first.alias("first")
        ).filter(F.col("documents") >= least)
    own = (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("text_hash") == F.col("first.text_hash"))
    gone = lines.join(settle(often, "template-often"), F.col("template") == F.col("t")).filter(~own)
    return gone.select("doc_id", "text_hash", "i")


def drop_recurring(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """``docs`` without recurring lines. A document that this leaves without a word goes; blank ones from before stay."""
    return without(docs, recurring(docs, tree))


def drop_passages(docs: DataFrame, tree: Tree = Tree(), among: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``docs`` without the long lines that an earlier document has as well; else as ``drop_recurring``.

    ``among`` picks the documents from all ``docs``, or from rows with their ``doc_id`` and ``text_hash``: lines are taken
    before, so the texts that stay are not written in between.
    """
    kept = docs if among is None else among(docs)
    with passing(docs.sparkSession):
        rows = parsed(docs, tree).dropDuplicates(["doc_id", "text_hash"])
        rows = settle(rows if among is None else among(rows), "template-lines")
        hits = passages(rows, tree).groupBy("doc_id", "text_hash").agg(F.collect_list("i").alias("lines"))
        hits = settle(hits, "template-hits", stays=True)
    return without(kept, hits)


def without(docs: DataFrame, hits: DataFrame) -> DataFrame:
    gone = spare(docs.columns, "n_dropped")
    rest = strip_lines(docs, hits, gone)
    return rest.filter((F.col(gone) == 0) | F.rlike("text", F.lit(rf"[^{SPACE}]"))).drop(gone)


def op4(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """One row per document: lines, dropped lines, and the digest of the text that stays (NULL for a NULL text)."""
    docs = docs.select("doc_id", "text")
    hits = recurring(docs, tree)
    lines = docs.withColumn("n_lines", F.size(F.split(whole("text"), "\n")).cast("long"))
    return strip_lines(lines, hits, "n_dropped").select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256")
    )
