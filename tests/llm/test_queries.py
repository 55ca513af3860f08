"""The registered queries of this folder on the smallest given tables: columns, types, and SQL where there is some."""

import duckdb
import pytest

from pactframe.llm import queries
from tools.check import TABLES, key, plain

# The columns each query has to return, with their types.
COLUMNS = {
    1: "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    2: "doc_id bigint, held_out boolean, score double, predicted int",
    3: "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    4: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    5: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    6: "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    7: "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    8: "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    9: "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    10: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    11: "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    12: "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    13: "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
}
# Rows that each query has to return, where these are not those of documents.
ROWS = {
    6: "SELECT count(*) FROM pages",
    11: "SELECT count(*) * 32 FROM embeddings",
    12: "SELECT count(DISTINCT conv_id) + 1 FROM conversations",
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_rows_and_types(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    number = int(name[2:].split("_")[0])
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes).startswith(COLUMNS[number])
    rows = df.collect()
    with duckdb.connect() as db:
        for t in TABLES.split():
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        n = db.execute(ROWS.get(number, "SELECT count(*) FROM documents")).fetchall()[0][0]
        assert len(rows) == n or (number == 5 and len({r.doc_id for r in rows}) == n)
        if name not in queries.ORACLE:
            return
        rel = db.execute(queries.ORACLE[name])
        at = [[d[0] for d in rel.description].index(c) for c in df.columns]
        want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=key)
    assert sorted((tuple(plain(v) for v in r) for r in rows), key=key) == want
