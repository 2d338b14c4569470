"""The registered queries on the smallest tables: against SQL, and against plain Python where SQL cannot say it."""

import html
import re

import duckdb
import plain
import pytest
import sentencepiece
from conftest import SMALLEST
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from checks.compare import connect, rows_of
from tallywire.llm import decontaminate, exact, quality, subwords
from tallywire.llm.common import table
from tallywire.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SMALLEST)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALLEST}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="module")
def items():
    return duckdb.sql(f"SELECT item_id, text FROM '{SMALLEST}/benchmark.parquet'").fetchall()


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, connection, name):
    found = QUERIES[name](spark, SMALLEST)
    relation = connection.execute(ORACLE[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, relation.fetchall())


def test_near_duplicates(spark, documents):
    found = QUERIES["op3_minhash_near_dedup"](spark, SMALLEST).collect()
    expected = plain.near(documents)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {i: (n, c, i == c) for i, (n, c) in expected.items()}


def leaked(documents, items):
    """Pairs whose item stands in the document without any change; the tables hold no others."""
    shorts = [(k, decontaminate.normalised(t)) for k, t in items]
    return {(i, k) for i, t in documents for k, s in shorts if f" {s} " in f" {decontaminate.normalised(t)} "}


def test_leaks(spark, documents, items):
    found = QUERIES["op1_decontamination"](spark, SMALLEST).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.distance == 0} == leaked(documents, items)
    for r in found:
        text = decontaminate.normalised(dict(documents)[r.doc_id])
        item = decontaminate.normalised(dict(items)[r.item_id])
        assert plain.part_distance(f" {item} ", f" {text} ") == r.distance


def test_licences(spark, documents):
    found = QUERIES["op6_licence_scan"](spark, SMALLEST).collect()
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "All rights reserved.": "Proprietary",
    }
    for r in found:
        text = dict(documents)[r.doc_id] or ""
        places = sorted((m.start(), name) for line, name in lines.items() for m in re.finditer(re.escape(line), text))
        assert [x.split(":")[0] for x in r.licences.split(",") if x] == [name for _, name in places]


def test_extraction(spark):
    found = {r.page_id: r.text for r in QUERIES["op5_html_extraction"](spark, SMALLEST).collect()}
    for i, page in duckdb.sql(f"SELECT page_id, html FROM '{SMALLEST}/pages.parquet'").fetchall():
        article = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]).replace("<br>", " ")
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"<[^>]*>", article)]
        assert found[i] == "\n".join(b for b in blocks if b)


def test_quality_held_out(spark):
    sf_dir = SMALLEST.replace("sf0.001", "sf0.1")
    found = QUERIES["op8_quality_classifier"](spark, sf_dir).where("held_out").join(table(spark, sf_dir, "labels"), "doc_id")
    right = [r.quality == r.predicted for r in found.collect()]
    assert sum(right) / len(right) > 0.97


def test_tokens(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    found = {r.id: r for r in subwords.encode(table(spark, SMALLEST, "documents")).collect()}
    for i, text in documents:
        assert found[i].ids == library.encode(text)
        assert found[i].round_trip
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op9_sentencepiece"](spark, SMALLEST).collect()}
    assert counts == {i: len(r.ids) for i, r in found.items()}


def test_pipeline(spark, documents, items):
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SMALLEST).collect()}
    docs, labels = table(spark, SMALLEST, "documents"), table(spark, SMALLEST, "labels")
    model = quality.train(docs, labels, allowed=~quality.held_out(F.col("doc_id")))
    scores = model.scores([t for _, t in documents])
    kept = [d for d, s in zip(documents, scores) if s >= quality.THRESHOLD]
    first = {}
    for i, t in kept:
        first.setdefault(exact.normalised(t), i)
    kept = [(i, t) for i, t in kept if first[exact.normalised(t)] == i]
    parts = plain.near(kept)
    kept = [(i, t) for i, t in kept if parts[i][1] == i]
    bad = {i for i, _ in leaked(kept, items)}
    library = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    assert found == {i: library.encode(t) for i, t in kept if i not in bad}


def test_toxicity_held_out(spark):
    """A third of the toxic rows of this table hold no toxic word, so that no model of words can find them."""
    sf_dir = SMALLEST.replace("sf0.001", "sf0.1")
    labels = table(spark, sf_dir, "labels")
    found = QUERIES["op11_toxicity"](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    assert len(found) > 700 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert sum(r.predicted for r in found if not r.toxic) < 0.01 * len(found)
    assert sum(r.predicted == r.toxic for r in found) / len(found) > 0.95
