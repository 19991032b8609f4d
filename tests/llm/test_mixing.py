import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

from llm_fixtures import docs, odd, shared_code  # noqa: F401

from tillwright.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in stopped)
        open_weight = sum(weight[s] for s in order if s not in stopped)
        share = {s: left * weight[s] / open_weight for s in order if s not in stopped} if open_weight else {}
        above = {s for s, t in share.items() if t > 2 * sizes[s]}
        if not above:
            return {s: float(share.get(s, 2 * sizes[s])) for s in order}
        stopped |= above


def plain_rates(sizes, target):
    """Rates of documents by bisection of the tilt."""
    mean = sum(sizes) / len(sizes)
    low, high = -1e5, 1e5
    for _ in range(300):
        tilt = (low + high) / 2
        rates = [2 / (1 + math.exp(min(700, -tilt * s / mean))) for s in sizes]
        low, high = (tilt, high) if sum(r * s for r, s in zip(rates, sizes)) < target else (low, tilt)
    return rates


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(frame, rows):
    got = frame.collect()
    by_source = defaultdict(list)
    for _, source, text in rows:
        by_source[source].append(size_of(text))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, size_of(t)) for d, s, t in rows)
    target = plain_targets({s: sum(v) for s, v in by_source.items()})
    for source, sizes in by_source.items():
        mine = [r for r in got if r.source == source]
        assert {r.source_size for r in mine} == {sum(sizes)}
        assert all(math.isclose(r.target, target[source], rel_tol=1e-12, abs_tol=1e-9) for r in mine)
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 for r in mine)
        taken = sum(r.taken for r in mine)
        left = min((r.size for r in mine if r.size and r.copies < 2), default=None)
        assert taken <= target[source] + 1e-6 * taken and (left is None or target[source] - taken < left)
        if 0 < target[source] < 2 * sum(sizes):
            rates = dict(zip([s for s in sizes if s], plain_rates([s for s in sizes if s], target[source])))
            for r in mine:
                if r.size:
                    assert math.isclose(r.rate, rates[r.size], rel_tol=1e-4, abs_tol=1e-6)
    return got


def texts(rng, n, source, longest):
    return [(rng.randrange(10**9), source, " ".join(["w"] * max(1, int(longest * rng.random() ** 6)))) for _ in range(n)]


def test_mix_meets_targets_with_tilted_rates(docs):
    rng = random.Random(4)
    rows = []
    for source, n in (("a", 40), ("b", 90), ("c", 900), ("d", 5), ("é", 30), (None, 60), ("Z", 1)):
        rows += texts(rng, n, source, 4000)
    rows += [(7, "c", "one two three")] * 300  # a large cell of equal rows
    got = check(mixing.mix(docs(rows, SCHEMA)), rows)
    again = mixing.mix(docs(rows, SCHEMA, parts=5)).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
    cells = defaultdict(list)
    for r in got:
        cells[r.source, r.size].append(r)
    for members in cells.values():
        assert max(r.copies for r in members) - min(r.copies for r in members) <= 1
        assert abs(sum(r.copies for r in members) - members[0].rate * len(members)) <= 3


def test_odd_rows_long_texts_and_clashing_columns(docs, odd):
    rows = [(d, "a" if i % 2 else None, t) for i, (d, t) in enumerate(odd)] + [(50, "b", "w\x0b" * 400000), (51, "b", "é é　"), (52, "nil", None)]
    frame = docs([(*r, 1, "x", 2.0) for r in rows], SCHEMA + ", size long, tilt string, target double")
    check(mixing.mix(frame), rows)


def test_nothing_to_mix(docs):
    assert mixing.mix(docs([], SCHEMA)).collect() == []
    got = mixing.mix(docs([(1, "a", None), (2, "b", " \n")], SCHEMA)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_plan_has_no_python_worker(docs, spark):
    frame = mixing.mix(docs([(i, "ab"[i % 2], "w " * i) for i in range(50)], SCHEMA))
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
