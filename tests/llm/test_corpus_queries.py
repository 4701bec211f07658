"""The registered corpus queries: contracts, SQL where there is one, and the pipeline."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from faregrid.llm import mixing, pii, quality, queries  # noqa: E402
from tests.llm.test_nearcopies import plain_groups  # noqa: E402
from tools.check import connect, difference  # noqa: E402

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id held_out lang_pred score",
    "op2": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3": "query_id rank vec_id score",
    "op4": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5": "doc_id start n_tokens ids_crc32",
    "op6": "doc_id size text_crc32 law shard slot grown_shard",
    "op7": "page_id url text n_chars",
    "op8": "doc_id fingerprint component_id",
    "op9": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10": "doc_id size source_size target taken",
    "op11": "lang rank phrase a l r n score",
    "op12": "doc_id held_out score predicted",
    "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


def test_all_and_the_pipeline_are_registered():
    names = {re.match(r"op\d+", n)[0]: n for n in queries.QUERIES}
    assert set(names) == set(COLUMNS)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_contract_columns_and_whole_tables(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    key = re.match(r"op\d+", name)[0]
    assert set(COLUMNS[key].split()) <= set(df.columns)
    rows = df.collect()
    if key == "op3":
        asked = spark.read.parquet(f"{SMALL}/embeddings.parquet").filter("vec_id % 100 = 0").count()
        assert len(rows) == 10 * asked
    elif key == "op13":
        assert sum(r["n_convs"] for r in rows if not r["depth"]) == (
            spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
        )
    elif key != "op11":
        table = "pages" if key == "op7" else "documents"
        assert len(rows) == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    tables = "/root/testdata/sf0.01" if name.startswith("op11") else SMALL  # enough repeats
    problem, rows = difference(spark, connect(tables), name, tables)
    assert not problem and rows > 0


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql_agrees_on_edge_rows(spark, edge_docs, tmp_path, name):
    """Nulls, blanks, repeated rows, long texts and clashing columns, as a table."""
    edge_docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    have = queries.QUERIES[name](spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = db.execute(queries.ORACLES[name])
    names = [c[0] for c in result.description]
    want = sorted(map(str, (tuple(row) for row in result.fetchall())))
    assert sorted(str(tuple(r)) for r in have.select(*names).collect()) == want


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kinds = [name for name, _ in corpus_pipeline.STAGES]
    assert len(kinds) == 5
    by_name = dict(corpus_pipeline.STAGES)
    good = by_name["quality rules"](spark, docs, SMALL)
    assert good.schema.names == docs.schema.names
    kept = {r["doc_id"] for r in quality.quality(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept

    single = by_name["near-duplicates"](spark, good, SMALL)
    groups = plain_groups([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(groups.values()))

    clean = by_name["personal data"](spark, single, SMALL)
    assert clean.columns == docs.columns
    spans = {r["doc_id"]: r["spans"] for r in pii.personal_data(single).collect()}
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        text, at, out = before[r["doc_id"]], 0, ""
        for span in filter(None, spans[r["doc_id"]].split(",")):
            kind, begin, end = span.split(":")
            if int(begin) >= at:
                out += text[at : int(begin)] + f"[{kind.upper()}]"
            at = max(at, int(end))
        assert r["text"] == out + text[at:] and r["n_chars"] == len(r["text"])

    mix = by_name["source mix"](spark, clean, SMALL)
    assert mix.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(clean).collect() if r["taken"]}
    words: dict[int, int] = {}
    for r in mix.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert words == taken

    out = by_name["token ids"](spark, mix, SMALL)
    rows = out.collect()
    assert len(rows) == mix.count() and all(r["round_trip"] for r in rows)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in rows) == sorted(
        (r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SMALL).collect()
    )


def test_pipeline_stages_take_edge_rows(spark, edge_docs, no_docs):
    for start in (edge_docs, no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "unused")
        docs.collect()
