"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from holdcast.llm import (bpe, chat, clustering, exactdedup, mixing, quality, sharding, simhash, spelling, substrings, suffixes,
                          topk, warc)
from holdcast.llm.common import table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": lambda s, d: simhash.op1_simhash(table(s, d, "documents")),
        "op2_warc": lambda s, d: warc.op2_warc(table(s, d, "pages")),
        "op3_sharding": lambda s, d: sharding.op3_sharding(table(s, d, "documents")),
        "op4_quality": lambda s, d: quality.op4_quality(table(s, d, "documents"), table(s, d, "labels")),
        "op5_substrings": lambda s, d: substrings.op5_substrings(table(s, d, "documents")),
        "op6_exact_dedup": lambda s, d: exactdedup.op6_exact_dedup(table(s, d, "documents")),
        "op7_bpe": lambda s, d: bpe.op7_bpe(table(s, d, "documents")),
        "op8_chat": lambda s, d: chat.op8_chat(table(s, d, "conversations")),
        "op9_topk": lambda s, d: topk.op9_topk(table(s, d, "embeddings")),
        "op10_mixing": lambda s, d: mixing.op10_mixing(table(s, d, "documents")),
        "op11_centroids": lambda s, d: clustering.op11_centroids(table(s, d, "embeddings")),
        "op12_spelling": lambda s, d: spelling.op12_spelling(table(s, d, "documents")),
        "op13_suffixes": lambda s, d: suffixes.op13_suffixes(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": warc.OP2_SQL,
        "op5_substrings": substrings.OP5_SQL,
        "op6_exact_dedup": exactdedup.OP6_SQL,
        "op9_topk": topk.OP9_SQL,
        "op11_centroids": clustering.OP11_SQL,
        "op12_spelling": spelling.OP12_SQL,
        "op13_suffixes": suffixes.OP13_SQL,
    }
