"""The numbered queries that SQL can express match DuckDB at sf0.001, types included."""

import pytest

from oracle.compare import digest, duck, rows_of

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
SQL = {k: v for k, v in E.oracle_sql().items() if k.startswith("op")}


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, key):
    con = duck(SF)
    df = E.queries()[key](spark, SF)
    types = {f.name: KINDS[f.dataType.simpleString()] for f in df.schema}
    assert types == {r[0]: r[1] for r in con.execute(f"DESCRIBE ({SQL[key]})").fetchall()}
    c1, r1 = rows_of(df.toPandas())
    c2, r2 = rows_of(con.sql(SQL[key]).df())
    assert c1 == c2 and len(r1) == len(r2) and digest(r1) == digest(r2)


def test_digest_columns_of_each_contract(spark):
    want = {
        "op1_": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op2_": "doc_id n_bytes n_tokens over_limit",
        "op3_": "doc_id n_bytes n_removed n_spans kept_sha256", "op4_": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op5_": "query_id rank vec_id score", "op7_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op8_": "doc_id size source_size target taken", "op9_": "doc_id n_shingles component_id kept",
        "op11_": "doc_id start n_tokens ids_crc32", "op12_": "doc_id leaf subroot root proof_sha256 folded_root verified",
        "op13_": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256"}
    longs = {"start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_bytes", "n_tokens", "n_removed", "n_spans", "n_turns", "loss_chars",
             "formatted_chars", "query_id", "vec_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "size", "source_size", "taken",
             "n_shingles", "component_id", "doc_id", "conv_id", "n", "prefix_chars", "middle_chars"}
    for name, query in E.queries().items():
        for prefix, columns in want.items():
            if name.startswith(prefix):
                kinds = dict(query(spark, SF).dtypes)
                assert set(columns.split()) <= set(kinds), name
                assert all(kinds[c] == "bigint" for c in columns.split() if c in longs), (name, kinds)
