import base64
import random
import re
from collections import Counter

import zstandard
from llm_fixtures import docs, make_prose, odd, shared_code  # noqa: F401

from tillwright.llm import quality, registry

WORD = re.compile("[^\x20\x09-\x0D]+")


def base(text):
    """Words, letters in them, symbols, repeated lines, words in repeated windows: the plain way."""
    text = text or ""
    words = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_counts_equal_brute_force(docs, odd, make_prose):
    rng = random.Random(1)
    rows = odd + [(i, make_prose(rng, rng.randrange(1, 300), 12)) for i in range(60)]
    rows += [(100, "a b c d e " * 2), (101, "é# <b>\n\né# <b>\n x\r\n x\r"), (102, "l\nl\n\n\nl"), (103, "\x1ca\x1db c d")]
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.measure(docs(rows)).collect())
    assert got == Counter((i, *base(t)) for i, t in rows)


def test_bands_reject_repetition_and_noise(docs, make_prose):
    rng = random.Random(2)
    noise = " ".join("".join(chr(rng.randrange(0x21, 0x2FFF)) for _ in range(9)) for _ in range(400))
    mantra = " ".join(f"{a} {b}" for a, b in zip(["again"] * 900, [str(i % 7) for i in range(900)]))
    fair = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 9))) for _ in range(900))
    half = fair[:6000] + " " + mantra
    got = {r.doc_id: r for r in quality.measure(docs([(1, noise), (2, mantra), (3, fair), (4, half), (5, None)])).collect()}
    assert [got[i].kept for i in (1, 2, 3, 5)] == [False, False, True, False]
    assert got[4].bad_chunk_share > 0.3 and got[5].ratio is None


def junk(rng, size):
    """Random base64, random letters of many scripts, and few words again and again."""
    letters = "".join(chr(rng.randrange(0x800, 0x2FFF)) for _ in range(size // 3))
    return {
        "base64": " ".join(base64.b64encode(rng.randbytes(30)).decode() for _ in range(size))[:size],
        "scripts": " ".join(letters[i:i + 7] for i in range(0, len(letters), 7)),
        "mantra": " ".join(f"again {i % 7}" for i in range(size))[:size],
    }


def test_junk_of_any_length_is_outside_the_bands(docs):
    rng, codec = random.Random(5), zstandard.ZstdCompressor(level=3)
    for size in (1000, 5000, 20000):
        for kind, text in junk(rng, size).items():
            # A thousand bytes of random letters cannot be told from prose in a wide script.
            assert (kind, quality._verdict(text.encode(), quality.Bands(), codec)[2]) == (kind, (kind, size) == ("scripts", 1000))
    hexes = " ".join(rng.randbytes(8).hex() for _ in range(2000))
    assert not quality._verdict(hexes[:20000].encode(), quality.Bands(), codec)[2]


def test_bands_by_length_and_width():
    bands = quality.Bands()
    assert bands.of(10) == bands.limits[0][0][1:] and bands.of(1 << 40, 2) == bands.limits[2][-1][1:]
    assert [quality._width(t.encode()) for t in ("plain é", "Привет мир", "漢字", "")] == [0, 1, 2, 0]


def test_bands_are_fitted_to_good_texts(docs, make_prose, odd):
    rng = random.Random(9)
    rows = [(i, make_prose(rng, rng.randrange(20, 900), 300)) for i in range(150)]
    frame, ids = docs(rows + odd + [(500, "x" * 5000)]), docs([(i, None) for i, _ in rows + odd] * 2)
    bands = quality.fit(frame, ids)
    codec = zstandard.ZstdCompressor(level=3)
    assert all(quality._verdict(t.encode(), bands, codec)[2] for _, t in rows)
    assert bands.limits[0] != quality.PROSE[0] and bands.limits[1:] == quality.PROSE[1:]
    assert [upto for upto, _, _ in bands.limits[0]] == sorted(upto for upto, _, _ in bands.limits[0])
    assert quality.fit(docs([]), ids) == quality.fit(frame, docs([])) == quality.Bands()


def test_other_columns_and_empty_table(docs):
    frame = docs([(1, "a b", 5, True)], "doc_id long, text string, n_words long, kept boolean")
    assert quality.measure(frame).first().n_words == 2
    assert quality.measure(docs([])).count() == 0


def test_labelled_good_documents_are_kept_and_others_rejected(spark):
    root = "/root/testdata/sf0.01"
    found = registry.op2_quality(spark, root).filter("not base_failed")
    labels = spark.read.parquet(f"{root}/labels.parquet")
    joined = found.join(labels.filter("quality = 1 and toxic = 0"), "doc_id")
    assert joined.count() > 100 and joined.filter("not kept").count() == 0
    assert found.filter("not kept").count() > 0
