import hashlib
import itertools
import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import docs, make_prose, odd, shared_code  # noqa: F401

from tillwright.llm import jaccard, lines, passages, suffix
from tillwright.llm.components import components
from tillwright.session import FREE_SHUFFLES

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def near_groups(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        members[find(i)].append(doc_id)
    least = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return Counter((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows)))


def copies(rng, make_prose):
    """Groups of edited copies, chains of edits, shared passages, exact copies."""
    rows, passage = [], make_prose(rng, 40)
    for g in range(8):
        words = make_prose(rng, 80).split(" ")
        for c in range(12):
            edited = list(words)
            for _ in range(rng.randrange(0, 5)):
                edited[rng.randrange(len(edited))] = f"edit{rng.randrange(10_000)}"
            if rng.random() < 0.3:
                words = edited
            rows.append((len(rows), " ".join(edited)))
    for _ in range(20):
        rows.append((len(rows), passage + " " + make_prose(rng, 12)))
    rows += [(len(rows) + i, rows[0][1].upper()) for i in range(5)]
    return rows


def near_rows(frame):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(frame).collect())


@pytest.mark.parametrize("rounds, block", [(4, 4 << 20), (0, 2000), (1, 700)])
def test_near_duplicates_equal_all_pairs(docs, odd, make_prose, monkeypatch, rounds, block):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", block)
    rows = copies(random.Random(4), make_prose) + odd
    want = near_groups(rows)
    assert near_rows(docs(rows)) == want
    assert any(c > 3 for c in Counter(k[2] for k in want).values())


def test_near_duplicates_ignore_other_columns(docs, odd):
    rows = [(*r, 7, "m", [1]) for r in odd + [(90, "one two three four five six"), (91, "One two three four five six")]]
    clash = docs(rows, "doc_id long, text string, node long, mark string, tokens array<long>")
    assert near_rows(clash) == near_groups([r[:2] for r in rows])


def test_near_duplicates_at_the_limit(docs):
    # 8 of 10 n-grams in common link, 7 of 9 do not.
    base = [f"t{i}" for i in range(30)]
    rows = [(1, " ".join(base[:13])), (2, " ".join(base[:12] + ["z"])), (3, " ".join(base[:14]))]
    assert near_rows(docs(rows)) == near_groups(rows)
    assert near_rows(docs([])) == Counter()


def test_sketches_rule_out_no_link(spark):
    rng = random.Random(8)
    sets = {0: set(range(300))}
    for i in range(1, 30):
        kept = set(rng.sample(sorted(sets[0]), 300 - 4 * i))
        sets[i] = kept | {rng.randrange(1 << 48) for _ in range(3 * i)}
    rows = spark.createDataFrame([(i, len(s), sorted(s)) for i, s in sets.items()], "node long, n long, tokens array<long>")
    rows = rows.join(jaccard.sketches(rows), "node").select("node", "n", "sketch")
    a, b = rows.alias("a"), rows.alias("b")
    sides = [jaccard.F.col(f"{t}.{c}") for t in "ab" for c in ("n", "n", "sketch")]
    may = {(r[0], r[1]) for r in a.join(b, jaccard._may_share(*sides, 80)).select("a.node", "b.node").collect()}
    like = {(i, j) for i in sets for j in sets if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert like <= may and len(may) < 2 * len(like) < len(sets) ** 2


def test_one_of_each_group_stays(docs, odd, make_prose):
    rows = copies(random.Random(6), make_prose) + odd
    frame = docs([(*r, "s") for r in rows], "doc_id long, text string, doc_mark string")
    kept = jaccard.keep_one(frame).collect()
    worded = [r for r in rows if shingles(r[1])]
    groups = {c for (_, n, c), _ in near_groups(rows).items() if n}
    assert sum(1 for r in kept if shingles(r.text)) == len(groups)
    assert sum(1 for r in kept if not shingles(r.text)) == len(rows) - len(worded)
    assert {r.doc_id for r in kept if shingles(r.text)} == groups


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    rng.shuffle(edges)
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(i, 100) for i in range(101, 140)} | {(301, 300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = Counter()
    for (doc_id, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len([s for s in bytes(gone).split(b"\0") if s])
        left = bytes(c for c, g in zip(b, gone) if not g)
        out[doc_id, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()] += 1
    return out


@pytest.mark.parametrize("block, crowd", [(2 << 20, 2), (900, 0), (3000, 1)])
def test_repeated_strings_equal_brute_force(docs, odd, make_prose, monkeypatch, block, crowd):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rng = random.Random(8)
    rows = copies(rng, make_prose) + odd + [(900, "ab" * 200), (901, "z" * 199), (902, "q" * 200), (903, "r" * 201)]
    line = make_prose(rng, 30)[:230]
    rows += [(1000 + i, make_prose(rng, i % 9) + line[i % 4:] + make_prose(rng, 20)) for i in range(25)]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept or b"").hexdigest())
                  for r in suffix.remove_repeats(docs(rows)).collect())
    assert got == repeats(rows, 200)


def test_ranks_are_dealt_out_evenly(docs, make_prose):
    """Anchors have the least rank of many places; that must not send them to the first fragments alone."""
    rng = random.Random(7)
    frame = docs([(i, make_prose(rng, 400)) for i in range(60)])
    dealt = frame.mapInArrow(lambda b: suffix._ranks(b, 40, suffix.LENGTH, suffix.FIRST), "fragment int, block string, payload binary")
    sizes = {}
    for r in dealt.collect():
        sizes[r.fragment] = sizes.get(r.fragment, 0) + len(suffix.unpack_numbers(bytes(r.payload), 5)[0])
    own = [sizes.get(f, 0) for f in range(40)]
    assert sum(own) > 800 and max(own) < 4 * sum(own) / 40


def test_spelled_repeats_equal_kept_texts(docs, odd):
    rows = odd + [(900 + i, "é" * 150 + "x" * i + "common end " * 40) for i in range(3)]
    kept = suffix.kept_text(suffix.remove_repeats(docs(rows)))
    told = suffix.remove_repeats(docs(rows), spelled=True)
    assert "kept" not in told.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in told.collect()) == sorted((str(r.doc_id), str(r.text)) for r in kept.collect())


def test_repeats_keep_columns_and_texts(docs):
    frame = docs([(1, "é" * 200, 7, "a"), (2, "b" + "é" * 200, 8, "b"), (3, None, None, None)],
                 "doc_id long, text string, n_bytes long, source string")
    got = {r.doc_id: r for r in suffix.kept_text(suffix.remove_repeats(frame)).collect()}
    assert (got[1].text, got[2].text, got[3].text, got[2].source) == ("", "b", None, "b")
    assert got[3].n_bytes == 0 and got[2].spans[0].start == 1
    assert suffix.remove_repeats(docs([])).count() == 0


def kept_lines(rows, width):
    """The plain way: walk all lines in order, remember windows."""
    first, windows = {}, {}
    key = {}
    for i, (doc_id, text) in enumerate(rows):
        worded = [(n, x) for n, x in enumerate((text or "").split("\n")) if text is not None and re.search(r"[^ \t-\r]", x)]
        key[i] = worded
        for s in range(len(worded) - width + 1):
            w = tuple(x for _, x in worded[s:s + width])
            windows[i, s] = w
    order = sorted(windows, key=lambda p: (rows[p[0]][0] is None, rows[p[0]][0] or 0, p[1]))
    gone = defaultdict(set)
    for p in order:
        w = windows[p]
        if w in first and (rows[first[w][0]], first[w][1]) != (rows[p[0]], p[1]):
            gone[p[0]].update(n for n, _ in key[p[0]][p[1]:p[1] + width])
        first.setdefault(w, p)
    out = Counter()
    for i, (doc_id, text) in enumerate(rows):
        left = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[i])
        out[doc_id, left, len(key[i]), len(gone[i])] += 1
    return out


def test_lines_equal_plain_walk(docs, odd):
    rng = random.Random(9)
    rows = list(odd)
    for i in range(120):
        text = "\n".join(rng.choice(["alpha", "beta", "gamma", "delta", "", "  ", "one two"]) for _ in range(rng.randrange(1, 14)))
        rows.append((i, text))
    rows += [(500, "a\n\nb\nc\nx"), (501, "q\na\nb\n\n\nc\n"), (502, "a\nb"), (503, "\n".join("abc" * 300)), (500, "a\n\nb\nc\nx")]
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in lines.drop_repeated_lines(docs(rows)).collect())
    assert got == kept_lines(rows, lines.WIDTH)


def test_lines_keep_other_columns(docs):
    frame = docs([("u", "a\nb\nc", 1, 5), ("v", "a\nb\nc\nd", 2, 6)], "source string, text string, doc_id long, runs long")
    got = {r.doc_id: r for r in lines.drop_repeated_lines(frame).collect()}
    assert got[2].text == "d" and got[2].source == "v" and got[2].n_deleted == 3 and got[1].runs == []
    assert lines.drop_repeated_lines(docs([])).count() == 0


def test_line_plan_is_native(docs):
    frame = lines.drop_repeated_lines(docs([(1, "a\nb\nc")]))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def best_chain(segments, cost):
    """The best chain's score, by trying every predecessor."""
    scores = []
    for x, y, n in sorted(segments):
        ends = [s - cost * (x + y - px - py) for (px, py), s in scores if px <= x and py <= y]
        scores.append(((x + n, y + n), n + max([0, *ends])))
    return max(s for _, s in scores)


def test_chains_have_the_best_score():
    rng = random.Random(2)
    for _ in range(60):
        segments = list({(rng.randrange(60), rng.randrange(60)): None for _ in range(15)})
        segments = [(x, y, rng.randrange(1, 6)) for x, y in segments]
        chain = passages.chains(segments, 0.15)[0]
        held = [segments[i] for i in chain]
        score = sum(n for _, _, n in held)
        for (x, y, n), (u, v, _) in zip(held, held[1:]):
            assert x + n <= u and y + n <= v
            score -= 0.15 * (u + v - x - y - 2 * n)
        assert abs(score - best_chain(segments, 0.15)) < 1e-9


@pytest.mark.parametrize("block", [2 << 20, 1500])
def test_planted_passages_are_found_with_edits(docs, odd, monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK_BYTES", block)
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(vocabulary) for _ in range(55)]
    rows = []
    for i in range(60):
        text = [rng.choice(vocabulary) for _ in range(150)]
        if i < 30:
            copy = list(passage)
            for _ in range(i % 4):
                copy[rng.randrange(10, 45)] = f"edit{i}"
            if i % 7 == 3:
                del copy[30]
            text[70:70] = copy
        rows.append((i, " ".join(text)))
    found = passages.repeated_passages(docs(rows + odd)).collect()
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r)
        assert (r.source_doc_id if r.source_doc_id is not None else 1 << 62) <= (r.doc_id if r.doc_id is not None else 1 << 62)
    assert set(by_id) == set(range(1, 30))
    for i in range(1, 30):
        assert any(r.start_word <= 72 and r.end_word >= 118 for r in by_id[i])


def test_a_text_that_repeats_itself_gives_few_passages(docs):
    found = passages.repeated_passages(docs([(1, "again " * 3000), (2, " ".join(f"w{i % 70}" for i in range(4000)))])).collect()
    assert 2 <= len(found) <= 40
    for doc_id, n in ((1, 3000), (2, 4000)):
        spans = sorted((r.start_word, r.end_word) for r in found if r.doc_id == doc_id)
        assert sum(b - a for a, b in spans) >= 0.9 * n


def test_no_passages(docs):
    assert passages.repeated_passages(docs([])).count() == 0
    assert passages.repeated_passages(docs([(1, "a b c d e f g h"), (2, "a b c d e f g h")])).count() == 0


@pytest.mark.parametrize("block", [2 << 20, 500])
def test_a_passage_is_found_whole_though_pieces_of_it_come_first(docs, monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK_BYTES", block)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(50_000)]

    def noise(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    rows = []
    for trial in range(20):
        passage, n = noise(55), 30 + trial % 9
        # Pieces that are too short alone, also between the two places that hold it whole.
        pieces = [passage[:n], passage[-n:]] if trial % 2 else [passage[:n], passage[-n:], passage, passage[:n], passage[-n:]]
        for i, held in enumerate([*pieces, passage, passage]):
            rows.append((100 * trial + i, " ".join(noise(60) + held + noise(60))))
    found = {(r.doc_id, r.start_word <= 60 and r.end_word >= 115) for r in passages.repeated_passages(docs(rows)).collect()}
    for trial in range(20):
        whole = [i for i, (doc_id, _) in enumerate(rows) if doc_id // 100 == trial]
        last = rows[whole[-1]][0]
        assert (last, True) in found
        assert trial % 2 or (last - 1, True) in found


@pytest.mark.parametrize("rate, least", [(0.15, 0.99), (0.20, 0.97), (0.25, 0.9)])
def test_passages_with_many_edits_are_found(docs, rate, least):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(50_000)]

    def noise(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    rows, certain = [], set()
    for trial in range(200):
        passage = noise(55)
        changed = set(rng.sample(range(55), int(55 * rate)))
        copy = [f"edit{rng.random()}" if i in changed else w for i, w in enumerate(passage)]
        rows += [(2 * trial, " ".join(noise(60) + passage + noise(60))), (2 * trial + 1, " ".join(noise(60) + copy + noise(60)))]
        if any(not changed & set(range(i, i + 6)) for i in range(50)):
            certain.add(2 * trial + 1)
    found = {r.doc_id for r in passages.repeated_passages(docs(rows)).collect() if r.source_doc_id == r.doc_id - 1}
    assert found >= certain and len(certain) >= 200 * least


def test_passages_leave_no_shuffled_blocks_behind(spark, docs, make_prose):
    rng = random.Random(3)
    shared = make_prose(rng, 80, 5000)
    rows = docs([(i, make_prose(rng, 100, 5000) + " " + shared) for i in range(40)])

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {os.path.basename(f) for f in files.split("\n") if "shuffle_" in f}

    before, setting = shuffled(), spark.conf.get(FREE_SHUFFLES)
    found = passages.repeated_passages(rows)
    # What is left is a sum of sizes; the jobs that ran before the last shuffle blocks, keys and chains.
    least = time.time() + 10
    while len(left := {f.split("_")[1] for f in shuffled() - before}) > 1 and time.time() < least:
        time.sleep(0.2)
    assert len(left) <= 1
    assert spark.conf.get(FREE_SHUFFLES) == setting
    assert found.select("doc_id").distinct().count() == 39


@pytest.mark.parametrize("words", [40, 4000])
def test_chains_that_are_sifted_out_hold_no_passage(words):
    rng, settings = np.random.default_rng(words), passages.Settings()
    own, other, found, low = [], [], [], []
    for _ in range(150):
        a, b = (rng.integers(0, words, rng.integers(60, 500)).astype(np.uint16) * np.uint16(17) for _ in range(2))
        n = int(rng.integers(6, 55))
        x, y = int(rng.integers(0, len(a) - n)), int(rng.integers(0, len(b) - n))
        b[y:y + n] = a[x:x + n]
        changed = y + rng.integers(0, n, int(rng.integers(0, 1 + n // 4)))
        b[changed] = 0
        begin, here = max(0, x - 300), int(rng.integers(0, n - 5))
        own.append(a[begin:])
        low.append(begin)
        other.append(b)
        found.append([[x + here, y + here, 6], [x, y, n]])
    chains = pa.array(found, pa.list_(pa.list_(pa.int32())))
    pairs = passages.Pairs(own, np.array(low), other, chains, settings, np.int32, (-1, -2))
    bytes_only = [[np.minimum((w & 255).astype(np.uint8), 253) for w in side] for side in (own, other)]
    may = passages.Pairs(bytes_only[0], np.array(low), bytes_only[1], chains, settings, np.uint8, (254, 255)).may_pass()
    nearly, growth = pairs.nearly(np.arange(len(pairs.pair)))
    passed = 0
    for i, pair in enumerate(pairs.pair.tolist()):
        pieces = pairs.chain(i)
        args = own[pair], low[pair], other[pair]
        alone = list(passages.passages_of(*args, [pieces], settings))
        assert alone == list(passages.passages_of(*args, [pieces], settings, [growth[i].tolist()]))
        assert not alone or (may[i] and nearly[i])
        passed += bool(alone)
    assert 20 < passed < 250 and nearly.sum() < 300


def chance_phrases(docs):
    """Texts of few words that share runs of six of them, each with many others, and copies of a passage."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(40)]

    def noise(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    phrases, passage, rows = [noise(6) for _ in range(400)], noise(60), []
    for i in range(100):
        text = [w for p in rng.sample(phrases, 25) for w in noise(40) + p]
        rows.append((i, " ".join(text + (passage if i % 10 == 3 else []) + noise(40))))
    return docs(rows)


def test_pairs_by_chance_go_before_whole_words_are_sent(docs, monkeypatch):
    counts, stored = Counter(), passages._stored

    def counted(rows, schema, path):
        out = stored(rows, schema, path)
        if "chains" in schema:
            counts["chains" if path.endswith("/chains") else "likely"] += out.filter("chains IS NOT NULL").count()
        return out

    monkeypatch.setattr(passages, "_stored", counted)
    assert passages.repeated_passages(chance_phrases(docs)).count() >= 9
    assert counts["chains"] > 2000 and counts["likely"] < 0.04 * counts["chains"]


def test_rounds_give_the_same_passages(docs, monkeypatch):
    rows, written, stored, rounds = chance_phrases(docs), [], passages._stored, passages._rounds
    monkeypatch.setattr(passages, "_stored", lambda r, s, path: written.append(path) or stored(r, s, path))
    once = sorted(passages.repeated_passages(rows).collect())
    assert not any("/found/" in path or path.endswith("/likely/1") for path in written)
    monkeypatch.setattr(passages, "_rounds", lambda pairs, size, limit: rounds(pairs, size, 1 << 18 if "near" in size else 1 << 13))
    monkeypatch.setattr(passages, "BLOCK_BYTES", 20_000)
    assert sorted(passages.repeated_passages(rows).collect()) == once and len(once) >= 9
    for step in ("likely", "found"):
        assert any(f"/{step}/1" in path for path in written)


@pytest.mark.parametrize("words", [40, 4000])
def test_words_next_to_chains_are_enough_to_sift(words):
    rng, settings = np.random.default_rng(words + 1), passages.Settings()
    most = settings.known + 3
    own, other, found, near, low = [], [], [], [], []
    for trial in range(400):
        a, b = (rng.integers(1, words, rng.integers(300, 900)).astype(np.uint16) * np.uint16(17) for _ in range(2))
        n = int(rng.integers(20, 300))
        x, y = int(rng.integers(0, len(a) - n)), int(rng.integers(0, len(b) - n))
        copy = a[x:x + n].copy()
        copy[rng.random(n) < rng.choice([0.05, 0.2, 0.3])] = 0
        if trial % 3 == 0:
            copy = np.delete(copy, rng.integers(0, n, 2))
        if trial % 4 == 0:
            copy[:n // 3] = 0  # agreement begins far from the chain only
        here = int(rng.integers(0, len(copy) - 6))
        copy[here:here + 6] = a[x + here:x + here + 6]
        b[y:y + len(copy)] = copy[:len(b) - y]
        own.append(a)
        other.append(b)
        found.append([[x + here, y + here, 6]])
        low.append(max(0, x + here - most))
        near.append(a[low[-1]:x + here + 6 + most])
    chains = pa.array(found, pa.list_(pa.list_(pa.int32())))
    sketches = [[np.minimum((w & 255).astype(np.uint8), 253) for w in side] for side in (near, other)]
    may = passages.Pairs(sketches[0], np.array(low), sketches[1], chains, settings, np.uint8, (254, 255), settings.known).may_pass()
    passed = 0
    for i, pieces in enumerate(found):
        begin = max(0, pieces[0][0] - settings.reach)
        alone = list(passages.passages_of(own[i][begin:pieces[0][0] + 6 + settings.reach].astype(np.int32), begin, other[i].astype(np.int32), [pieces[0]], settings))
        assert may[i] or not alone
        passed += bool(alone)
    assert 50 < passed < 350 and (words < 100 or may.sum() < 1.3 * passed + 40)


@pytest.mark.parametrize("high", [1 << 63, 50])
def test_numbers_are_ranked_in_full(high):
    rng = np.random.default_rng(4)
    values = rng.integers(0, high, 5000).astype(np.uint64) + rng.integers(0, 3, 5000).astype(np.uint64) * np.uint64(1 << 9)
    values[:100] = values[100:200] ^ np.uint64(1)  # these differ in bits that give way to their places
    for part in (values, values[:1], values[:0]):
        order, new = passages._ranked(part)
        assert order.tolist() == np.argsort(part, kind="stable").tolist()
        assert new.sum() == len(set(part.tolist()))
