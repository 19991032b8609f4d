import hashlib
import random
import re
import zlib
from collections import defaultdict

from llm_fixtures import shared_code  # noqa: F401

from tillwright.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = VISIBLE.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else None if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def every_script(rows, faults):
    """All edit scripts with at most two insertions in a row, as (cost, audit, repaired), by plain enumeration."""
    found = []

    def walk(i, initials, cost, audit, lines, inserted):
        if not re.match(r"(s?(ua)*u?)?\Z", initials):
            return
        if inserted < 2:
            for role in ("user", "assistant"):
                walk(i, initials + role[0], cost + 2, audit + "I", [*lines, f"{role}:"], inserted + 1)
        if i == len(rows):
            if PATTERN.match(initials):
                found.append((cost, audit, "\n".join(lines)))
            return
        _, _, role, text = rows[i]
        walk(i + 1, initials, cost + 3, audit + "D", lines, 0)
        if faults[i] not in ("blank", "duplicate"):
            more = faults[i] == "truncated"
            if role:
                walk(i + 1, initials + role[0], cost + more, audit + "K", [*lines, f"{role}:{text}"], 0)
            for other in ("user", "assistant"):
                walk(i + 1, initials + other[0], cost + 2 + more, audit + "R", [*lines, f"{other}:{text}"], 0)

    walk(0, "", 0, "", [], 0)
    return min(found)


def walked(rows, faults):
    """The same by a plain search that keeps whole audits, for long conversations."""
    after = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def insert(best):
        for _ in range(2):
            new = dict(best)
            for place, (cost, audit) in best.items():
                for c in "ua":
                    if place in after[c]:
                        to = after[c][place]
                        new[to] = min(new.get(to, (10**9, "")), (cost + 2, audit + "I"))
            best = new
        return best

    best = {0: (0, "")}
    for (_, _, role, _), fault in zip(rows, faults):
        new = {}
        for place, (cost, audit) in insert(best).items():
            options = [(place, 3, "D")]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                options += [(after[c][place], base + more, e) for c, base, e in ((role[:1], 0, "K"), ("u", 2, "R"), ("a", 2, "R"))
                            if place in after.get(c, {})]
            for to, more, edit in options:
                new[to] = min(new.get(to, (10**9, "")), (cost + more, audit + edit))
        best = new
    best = insert(best)
    return min(best[p] for p in (0, 3) if p in best)


def plain_report(rows, damage=True):
    convs = defaultdict(list)
    ids = {r[0] for r in rows}
    for row in plain_damage(rows) if damage else rows:
        convs[row[0]].append(row)
    out = {}
    for conv in ids:
        mine = ordered(convs[conv])
        faults = plain_faults(mine)
        turns = [t for _, t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, text = every_script(mine, faults)
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def shown(frame):
    rows = frame.collect()
    got = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


ROLES = ["user", "assistant", "system", "tool", "ua", "", None]


def some_rows(rng, conv, n):
    rows = []
    for turn in range(n):
        role = rng.choices(ROLES, [6, 6, 3, 1, 1, .3, .3])[0]
        text = rng.choice(["Yes.", "No!", "cut off", "", " \n", "a.b", "Why?\t\n", None, f"t{turn}.", f"é{turn}"])
        rows.append((conv, rng.choice([turn, turn, turn, turn * 2, None]), role, text))
    return rows


def test_reports_equal_all_scripts(spark):
    rng = random.Random(3)
    rows = [r for conv in range(260) for r in some_rows(rng, conv, rng.randrange(1, 5))] + some_rows(rng, None, 3)
    rows += [(-1, 0, "user", "."), (-1, 0, "user", "."), (-2, 0, None, None)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA + ", row long, edit string")
    assert shown(repair.report(frame, repair.damaged(frame))) == plain_report(rows)


def test_long_conversations_settle(spark):
    rng = random.Random(8)
    rows = []
    for conv, weights in enumerate([(5, 5, 1), (9, 1, 0), (1, 0, 0), (0, 1, 1), (1, 1, 8)]):
        rows += [(conv, t, rng.choices(["user", "assistant", "system"], weights)[0], rng.choice(["Yes.", "No", "", f"t{t}.", f"u{t}"])) for t in range(1500)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = shown(repair.report(frame, frame))
    for conv in range(5):
        mine = ordered([r for r in rows if r[0] == conv])
        assert got[conv][5:7] == walked(mine, plain_faults(mine))


def test_search_gives_letters_out_early():
    search, given = repair.Search(), 0
    for i in range(20 * repair.SETTLE):
        search.row("us"[i % 7 == 3], i % 5 == 0, i % 3 == 0)
        if search.rows % repair.SETTLE == 0:
            given += len(search.settle())
            assert search.width < 3 * (repair.SETTLE + repair.BEHIND) + repair.SETTLE
    assert given > 19 * repair.SETTLE


def test_script_holds_the_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "cut"), (1, 3, "user", "Still here?"), (1, 4, "user", " ")]
    got = repair.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("step").collect()
    kept = [(r.role, r.text) for r in got if r.edit != "D"]
    assert PATTERN.match("".join(role[0] for role, _ in kept)) and ("system", "Be kind.") in kept
    mine = ordered(rows)
    assert "".join(r.edit for r in got) == every_script(mine, plain_faults(mine))[1]


def test_empty_table_and_one_exchange(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(none, repair.damaged(none)).collect() == []
    frame = spark.createDataFrame([(1, 0, "user", "a." * 300000)], SCHEMA)
    assert repair.repair(frame).count() >= 2
    plan = repair.diagnose(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
