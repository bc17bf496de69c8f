"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import corpus_pipeline

from . import chat, decontaminate, embeddings, minhash, packing, repair, sharding, spelling, substring, suffixes, toxicity, urls, warc


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_urls": urls.op2_urls,
        "op3_substring": substring.op3_substring,
        "op4_minhash": minhash.op4_minhash,
        "op5_sharding": sharding.op5_sharding,
        "op6_packing": packing.op6_packing,
        "op7_warc": warc.op7_warc,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_embeddings": embeddings.op9_embeddings,
        "op10_chat": chat.op10_chat,
        "op11_suffixes": suffixes.op11_suffixes,
        "op12_repair": repair.op12_repair,
        "op13_spelling": spelling.op13_spelling,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_substring": substring.ORACLE,
        "op4_minhash": minhash.ORACLE,
        "op7_warc": warc.ORACLE,
        "op9_embeddings": embeddings.ORACLE,
        "op11_suffixes": suffixes.ORACLE,
        "op13_spelling": spelling.ORACLE,
    }
