import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer
from llm_fixtures import docs, make_prose, odd, shared_code  # noqa: F401

from tillwright.llm import bpe, packing, registry

PATH = registry.tokenizer_path()
ODD_TEXT = "a <|endoftext|>x<|endoftext|>  \n\n y's it'S 'll  　\u0085 é日本語 \x1c\x1d x\x00y 123٣٤ ½ 😀 ॐ क् ​  end  "


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_round_trip_equals_the_library(spark, docs, odd, make_prose, tokenizer):
    rng = random.Random(3)
    rows = odd + [(1, ODD_TEXT), (2, "word " * 5000)] + [(10 + i, make_prose(rng, 60)) for i in range(20)]
    found = bpe.decode(bpe.encode(docs(rows), PATH), PATH).collect()
    got = Counter((r.doc_id, tuple(r.ids), r.text) for r in found)
    want = Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[(i, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False))] += 1
    assert got == want


def test_words_keep_the_cuts(tokenizer):
    splitter = bpe.Splitter(PATH)

    def cuts(text):
        return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    rng = random.Random(1)
    letters = ["a", "B", "'s", "1", "!", " ", " ", "\n", "\t", "\u00a0", "\0", "é", "\x1c", "\u2003", "\u0558"]
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 9)))
        assert [p for w in splitter.split(text) for p in cuts(w)] == cuts(text), repr(text)


def test_bytes_that_are_no_text_are_replaced_and_unknown_ids_refused(spark, docs, tokenizer):
    ids = tokenizer.encode("é", add_special_tokens=False).ids
    assert len(bpe.byte_letters()) == 256
    half = ids[:1] if len(ids) > 1 else [tokenizer.token_to_id("Ã")]
    frame = spark.createDataFrame([(1, half), (2, None), (3, ids)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(frame, PATH).collect()}
    assert got == {1: tokenizer.decode(half), 2: "", 3: "é"}
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [99999999])], "doc_id long, ids array<int>"), PATH).collect()


def test_no_documents(spark, docs):
    assert bpe.decode(bpe.encode(docs([]), PATH), PATH).count() == 0
    assert packing.pack_documents(docs([]), PATH).count() == 0


def test_pieces_cover_each_document():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


def check_layout(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_ids_are_the_documents(spark, docs, odd, make_prose, tokenizer):
    rng = random.Random(5)
    rows = odd + [(i, make_prose(rng, rng.randrange(1, 900))) for i in range(40)]
    found = packing.pack_documents(docs(rows), PATH, capacity=128).collect()
    assert check_layout(found, 128) <= 1.05 * sum(r.length for r in found) / 128 + 1
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.row, r.piece)):
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        assert r.start == sum(x.length for x in got[r.row])
        got[r.row].append(r)
    texts = Counter((parts[0].doc_id, b"".join(p.ids for p in parts)) for parts in got.values())
    want = Counter((i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, t in rows)
    assert texts == want


def test_rounds_merge_underfull_bins(spark):
    rng = random.Random(7)
    sizes = [rng.randrange(1, 101) for _ in range(3000)]
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, length int").repartition(40)
    found = packing.pack(items, capacity=100, group_items=60).collect()
    assert sorted(r.doc_id for r in found) == list(range(3000))
    assert check_layout(found, 100) <= 1.08 * sum(sizes) / 100


def test_items_that_share_no_bin_end_the_rounds(spark):
    items = spark.range(500).selectExpr("id doc_id", "60 length").repartition(20)
    assert check_layout(packing.pack(items, capacity=100, group_items=30).collect(), 100) == 500


def test_best_fit_prefers_the_fullest_bin():
    assert packing.best_fit(np.array([6, 4, 5, 5]), 10).tolist() == [0, 0, 1, 1]


def test_query_digests(spark, tokenizer):
    root = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    for r in registry.op1_bpe(spark, root).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_whole_texts_equal_the_library(tokenizer):
    encoder = bpe.Encoder(PATH)
    assert encoder.ranked is not None
    rng = random.Random(6)
    letters = [chr(p) for p in range(0x30000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"a{c}1{c}{c} {c}. " for c in letters[i:i + 512]) for i in range(0, len(letters), 512)]
    texts += ["", ODD_TEXT, " " * 5000, "\n \n" * 900 + "x", "ab" * 4000, "<|endoftext|", "".join(rng.sample(letters, 3000))]
    for text in texts:
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
