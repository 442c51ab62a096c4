"""The queries of this subpackage and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstone.llm import archives, langid, minhash, mixing, prefix_trie, quality, secrets, simhash, templates, tiling, tokens, urls, whitening
from tillstone.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def over(name: str, operator: Callable[..., DataFrame], *others: str) -> Query:
    """The query that applies ``operator`` to the whole table ``name`` (and to ``others``)."""
    return lambda spark, sf_dir: operator(*(table(spark, sf_dir, t) for t in (name, *others)))


QUERIES: dict[str, Query] = {
    "op1_secrets": over("documents", secrets.op1),
    "op2_token_counts": over("documents", tokens.op2),
    "op3_url_filter": over("pages", urls.op3),
    "op4_line_dedup": over("documents", templates.op4),
    "op5_quality_rules": over("documents", quality.op5),
    "op6_archives": over("pages", archives.op6),
    "op7_minhash": over("documents", minhash.op7),
    "op8_language": over("documents", langid.op8),
    "op9_mixing": over("documents", mixing.op9),
    "op10_decontamination": over("documents", tiling.op10, "benchmark"),
    "op11_prefix_trie": over("conversations", prefix_trie.op11),
    "op12_whitening": over("embeddings", whitening.op12),
    "op13_simhash": over("documents", simhash.op13),
}

STATEMENTS: dict[str, str] = {
    "op5_quality_rules": quality.OP5_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
}
