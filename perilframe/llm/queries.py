"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from perilframe.llm import bpe, chat, fingerprints, lexical, media, mixing, negatives, secret_scan, setjoin, sharding, simhash, toxicity, urls
from perilframe.llm.common import table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def docs(s, d):
        return table(s, d, "documents")

    return {
        "op1_temperature_mixing": lambda s, d: mixing.digest(docs(s, d)),
        "op2_progressive_jpeg": lambda s, d: media.stored_texts(docs(s, d)),
        "op3_oph_fingerprints": lambda s, d: fingerprints.fingerprinted(docs(s, d)),
        "op4_secret_scan": lambda s, d: secret_scan.scanned(docs(s, d), secret_scan.fit(docs(s, d))),
        "op5_url_filter": lambda s, d: urls.judged(table(s, d, "pages")),
        "op6_bpe_trie": lambda s, d: bpe.encoded(docs(s, d)),
        "op7_simhash_dedup": lambda s, d: simhash.digest(docs(s, d)),
        "op8_toxicity": lambda s, d: toxicity.scored(docs(s, d), table(s, d, "labels")),
        "op9_chat_perspectives": lambda s, d: chat.rotated(table(s, d, "conversations")),
        "op10_slot_sharding": lambda s, d: sharding.digest(docs(s, d)),
        "op11_partition_join": lambda s, d: setjoin.joined(docs(s, d)),
        "op12_hard_negatives": lambda s, d: negatives.mined(table(s, d, "embeddings")),
        "op13_reversed_search": lambda s, d: lexical.ranked(docs(s, d), table(s, d, "benchmark")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_temperature_mixing": mixing.SQL, "op9_chat_perspectives": chat.SQL, "op11_partition_join": setjoin.SQL, "op12_hard_negatives": negatives.SQL, "op13_reversed_search": lexical.SQL}
