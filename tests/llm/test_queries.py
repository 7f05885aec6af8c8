"""The contract columns of every query, over whole tables."""

import duckdb
import pytest
from llm.cases import rows

from trendlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LONG, TEXT, FLAG = "bigint", "string", "boolean"

CONTRACTS = {
    "op1_chat_format": {"conv_id": LONG, "n_turns": LONG, "turns_sha256": TEXT, "loss_chars": LONG, "loss_sha256": TEXT, "formatted_chars": LONG},
    "op2_quality_classifier": {"doc_id": LONG, "kept": FLAG},
    "op3_simhash_dedup": {"doc_id": LONG, "fingerprint": TEXT, "component_id": LONG},
    "op4_bpe_codec": {"doc_id": LONG, "n_tokens": LONG, "ids_sha256": TEXT, "decoded_sha256": TEXT},
    "op5_topk_search": {"query_id": LONG, "rank": "int", "vec_id": LONG, "score": LONG},
    "op6_sharding": {"doc_id": LONG, "size": LONG, "text_crc32": LONG, "law": TEXT, "shard": "int", "slot": LONG, "grown_shard": "int"},
    "op7_mixing": {"doc_id": LONG, "size": LONG, "source_size": LONG, "target": "double", "taken": LONG},
    "op8_quality_rules": {"doc_id": LONG, "n_words": LONG, "word_chars": LONG, "n_symbols": LONG, "n_dup_lines": LONG, "n_repeat_words": LONG, "base_failed": FLAG, "kept": FLAG},
    "op9_license_scans": {"doc_id": LONG, "license": TEXT, "n_matches": LONG},
    "op10_token_counts": {"doc_id": LONG, "n_bytes": LONG, "n_tokens": LONG, "over_limit": FLAG},
    "op11_lexical_search": {"item_id": LONG, "rank": "int", "doc_id": LONG, "score": LONG},
    "op12_line_dedup": {"doc_id": LONG, "n_lines": LONG, "n_dropped": LONG, "kept_sha256": TEXT},
    "op13_conversation_repair": {"conv_id": LONG, **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), LONG), "audit": TEXT, "repaired_sha256": TEXT},
}


def test_every_operator_has_a_query():
    assert set(QUERIES) == set(CONTRACTS)


@pytest.mark.parametrize("name", CONTRACTS)
def test_contract(spark, name):
    got = QUERIES[name](spark, SF)
    types = dict(got.dtypes)
    assert {c: types.get(c) for c in CONTRACTS[name]} == CONTRACTS[name]
    found = rows(got, *sorted(got.columns))
    if "doc_id" in CONTRACTS[name] and "rank" not in CONTRACTS[name]:
        assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    if name in ORACLES:
        db = duckdb.connect()
        for table in ("documents", "embeddings", "conversations", "benchmark"):
            db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        want = db.sql(ORACLES[name])
        order = [want.columns.index(c) for c in sorted(want.columns)]
        assert sorted(got.columns) == sorted(want.columns)
        assert found == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
