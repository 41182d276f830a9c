"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from steprisk.llm.ann import op1_ann
from steprisk.llm.bpe import op11_bpe
from steprisk.llm.chat import op5_chat_format
from steprisk.llm.codes import op13_codes
from steprisk.llm.common import table
from steprisk.llm.langid import op9_language_id
from steprisk.llm.minhash import op6_minhash
from steprisk.llm.mixing import op3_mixing
from steprisk.llm.oracles import ORACLES
from steprisk.llm.packing import op2_packing
from steprisk.llm.passages import op7_passages
from steprisk.llm.pii import op10_pii
from steprisk.llm.quality_rules import op4_quality_rules
from steprisk.llm.shards import op8_training_order
from steprisk.llm.trie import op12_prefix_trie

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(table(spark, folder, name))


QUERIES: dict[str, Query] = {
    "op1_ann": _over("embeddings", op1_ann),
    "op2_packing": _over("documents", op2_packing),
    "op3_mixing": _over("documents", op3_mixing),
    "op4_quality_rules": _over("documents", op4_quality_rules),
    "op5_chat_format": _over("conversations", op5_chat_format),
    "op6_minhash": _over("documents", op6_minhash),
    "op7_passages": _over("documents", op7_passages),
    "op8_training_order": _over("documents", op8_training_order),
    "op9_language_id": _over("documents", op9_language_id),
    "op10_pii": _over("documents", op10_pii),
    "op11_bpe": _over("documents", op11_bpe),
    "op12_prefix_trie": _over("conversations", op12_prefix_trie),
    "op13_codes": _over("embeddings", op13_codes),
}

__all__ = ["ORACLES", "QUERIES"]
