"""The pipeline and the registered queries against brute force on small tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import make_prose, shared_code  # noqa: F401
from test_dedup import copies, kept_lines, near_groups, repeats, shingles
from test_tokens import check_layout, tokenizer  # noqa: F401

import __spark_entry__ as spark_entry
import corpus_pipeline
from check import connect, spark_rows, sql_rows
from tillwright.llm import langid, lines, registry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def corpus(spark, tmp_path, make_prose):
    rng = random.Random(11)
    rows = copies(rng, make_prose)
    rows += [(500, "12 34 !?"), (501, None), (502, ""), (503, rows[0][1]), (504, "x"), (None, "no id here\nbut text\nin lines")]
    shared = make_prose(rng, 60)
    rows += [(600 + i, make_prose(rng, 50) + "\n" + shared + "\n" + make_prose(rng, 50)) for i in range(6)]
    rows = [(i, t, "en" if i is None or i % 3 else None, "s", -1) for i, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path), [(r[0], r[1]) for r in rows]


def plain_lines(rows):
    out = []
    for (doc_id, text, n, gone), k in kept_lines(rows, lines.WIDTH).items():
        out += [(doc_id, text)] * k if not n or gone < n else []
    return out


def plain_groups(rows):
    least = {c for _, n, c in near_groups(rows) if n}
    return [r for r in rows if not shingles(r[1]) or r[0] in least]


def plain_repeats(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        if not b or sum(gone) < len(b):
            out.append((doc_id, bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")))
    return out


def test_stages_equal_brute_force(spark, corpus, tokenizer, tmp_path):
    root, rows = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, want = docs.columns, [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    for (name, stage), plain in zip(corpus_pipeline.STAGES, [lambda r: want, plain_lines, plain_groups, plain_repeats]):
        path = str(tmp_path / name.replace(" ", "-"))
        stage(spark, docs, root).write.parquet(path)
        docs = spark.read.parquet(path)
        got = docs.collect()
        assert docs.columns == columns
        want = plain(want)
        assert Counter((r.doc_id, r.text) for r in got) == Counter(want), name
        assert name == "language ID" or all(r.n_chars == len(r.text) for r in got if r.n_chars != -1)
    packed = corpus_pipeline.STAGES[4][1](spark, docs, root).collect()
    check_layout(packed, 1024)
    ids = Counter((r.doc_id, zlib.crc32(np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
                  for r in got)
    assert Counter((r.doc_id, r.ids_crc32) for r in packed) == ids


def test_run_gives_the_last_stage(spark, corpus):
    root, _ = corpus
    found = corpus_pipeline.run(spark, root)
    assert {"doc_id", "piece", "sequence_id", "offset", "ids"} <= set(found.columns) and found.count() > 10


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_each_dealt_operator_has_its_query():
    names = list(registry.queries())
    assert [int(n[2:].split("_")[0]) for n in names if n.startswith("op")] == list(range(1, 14))
    assert len(names) == 14 and set(names) <= set(spark_entry.queries())
    assert langid.UNKNOWN == "und" and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    assert spark_rows(registry.queries()[name](spark, SMALL)) == sql_rows(connect(SMALL), registry.oracle_sql()[name])


def test_queries_equal_brute_force_on_whole_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in registry.op3_suffix(spark, SMALL).collect())
    assert got == repeats(rows, 200)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in registry.op6_jaccard(spark, SMALL).collect())
    assert got == near_groups(rows)
