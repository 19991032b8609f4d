import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_fixtures import docs, make_prose, odd, shared_code  # noqa: F401

from tillwright.llm import ordermin
from tillwright.llm.textbatch import Texts, Words, combine, mix


def plain_marks(text, settings):
    """Order MinHash of one text, element by element."""
    words = Words.of(Texts.of(pa.array([text.encode()], pa.binary()))).hashes
    if not len(words):
        return [0] * settings.sketches
    k = settings.k if len(words) >= settings.k else len(words)
    seen, elements = Counter(), []
    for i in range(len(words) - k + 1):
        run = combine([words[i + j:i + j + 1] for j in range(k)])
        elements.append(combine([run, np.array([seen[int(run[0])]], np.uint64)])[0])
        seen[int(run[0])] += 1
    marks = []
    for salt in mix(np.arange(1, settings.sketches + 1, dtype=np.uint64)):
        order = sorted(range(len(elements)), key=lambda i: int((elements[i] ^ salt) * (salt | np.uint64(1))))
        picked = sorted(order[:settings.ell])
        value = np.full(1, salt, np.uint64)
        for p in [*picked, *[None] * (settings.ell - len(picked))]:
            value = mix(value * np.uint64(3) + (elements[p] if p is not None else np.uint64(0)))
        marks.append(max(1, int(value[0]) >> 32))
    return marks


def test_marks_equal_plain_selection(make_prose):
    rng = random.Random(3)
    settings = ordermin.Settings(sketches=5)
    texts = ["", "a", "a b", "a a a a a a", "a b c", *[make_prose(rng, n, 6) for n in (4, 9, 80)], " "]
    found = ordermin.marks_of(Words.of(Texts.of(pa.array([t.encode() for t in texts], pa.binary()))), settings)
    assert found.tolist() == [plain_marks(t, settings) for t in texts]


def test_order_matters_where_overlap_does_not():
    rng = random.Random(1)
    parts = [" ".join(f"p{i}w{rng.randrange(99)}" for _ in range(30)) for i in range(6)]
    swapped = list(reversed(parts))
    texts = [" ".join(parts), " ".join(swapped)]
    marks = ordermin._marks([t.encode() for t in texts], ordermin.Settings(sketches=200))
    assert ordermin.likeness(marks[0], marks[1]) < 0.75
    assert ordermin.likeness(marks[0], marks[0]) == 1.0


def test_edit_study_equals_plain(docs, odd, make_prose):
    rng = random.Random(2)
    rows = [r for r in odd if r[0] is not None] + [(i, make_prose(rng, rng.randrange(1, 60))) for i in range(50)]
    rows = [r for r in rows if r[0] != -5] + [(-5, "A")]
    got = {r.doc_id: r for r in ordermin.edit_study(docs(rows), partitions=5).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following, r = text or "", following or "", got[i]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        own, changed, other = ordermin._marks([x.encode() for x in (text, edited, following)], ordermin.Settings())
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (ordermin._text(own), ordermin._text(changed))
        assert (r.near_edited, r.near_next) == (ordermin.likeness(own, changed), ordermin.likeness(own, other))


def test_repeated_and_missing_ids(docs, odd):
    assert ordermin.edit_study(docs(odd), partitions=3).count() == len(odd)
    assert ordermin.edit_study(docs([(1, "only one")]), partitions=3).first().near_next == 1.0
    assert ordermin.edit_study(docs([]), partitions=3).count() == 0
    same = {r.fingerprint for r in ordermin.fingerprints(docs(odd)).filter("doc_id in (-6, -7)").collect()}
    assert len(same) == 1


def test_parts_grow_with_the_text(docs, monkeypatch):
    frame = docs([(i, "some words of text " * 50) for i in range(40)])
    least = ordermin.parts_for(frame)
    monkeypatch.setattr(ordermin, "PART_BYTES", 100)
    assert ordermin.parts_for(frame) == 380 > least
    assert ordermin.parts_for(docs([])) == least
    assert ordermin.edit_study(frame).count() == 40


def test_other_columns_are_ignored(docs):
    rows = [(1, "a b c d", "x", 5, True), (2, None, None, None, None), (3, "a b c e", "y", 7, False)]
    clash = docs(rows, "doc_id long, text string, head string, part int, guest boolean")
    plain = docs([r[:2] for r in rows])
    assert sorted(ordermin.edit_study(clash, partitions=2).collect()) == sorted(ordermin.edit_study(plain, partitions=2).collect())
