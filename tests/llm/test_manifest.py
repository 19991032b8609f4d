import hashlib
import random
import zlib

import pytest
from llm_fixtures import docs, shared_code  # noqa: F401

from tillwright.llm import merkle, ranks

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain(rows):
    """Every row's proof, from levels built in plain lists."""

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def siblings(built, at):
        path = []
        for level in built[:-1]:
            run = level[at - at % 3:at - at % 3 + 3]
            path.append((run, at % 3))
            at //= 3
        return path

    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for source in order:
        trees[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[source] = levels([leaf(r) for r in trees[source]])
    top = levels([built[s][-1][0] for s in order])
    out = []
    for t, source in enumerate(order):
        for i, row in enumerate(trees[source]):
            path = siblings(built[source], i) + siblings(top, t)
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf((*row[:4], text))
            proof = []
            for run, slot in path:
                proof += [d for j, d in enumerate(run) if j != slot]
                folded = sha(*run[:slot], folded, *run[slot + 1:])
            out.append((row[0], leaf(row), built[source][-1][0], top[-1][0], sha(*proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def shown(frame):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in frame.collect()), key=str)


def rows_of(rng, n, sources):
    return [(i, rng.choice(sources), rng.choice(["en", None, "dé"]), rng.randrange(99), "a\nb" * rng.randrange(3) + f"é{i}") for i in range(n)]


@pytest.mark.parametrize("n,sources", [
    (1, ["a"]), (28, ["a"]), (130, ["a"] * 9 + ["b", "é", None, "Z", "~", "\U0001f600", "￮", "", "c", "d", "e"])])
def test_proofs_equal_plain_levels(docs, n, sources):
    rows = rows_of(random.Random(n), n, sources)
    random.Random(1).shuffle(rows)
    assert shown(merkle.document_manifest(docs(rows, SCHEMA))) == plain(rows)


def test_nulls_ties_long_texts_and_clashing_columns(docs):
    rows = [(None, None, None, None, None), (None, "a", "en", 1, "x\ny"), (None, "a", "en", 1, "x\ny"), (1, "a", None, None, ""),
            (1, "a", None, None, "z\n"), (1, "a", "en", 3, None), (2, "", "en", 0, "\n" * 50000), (4, "a", "en", 3, "word\n" * 400000)]
    rows += [(7, "same", "en", 2, "t\n")] * 30
    wide = docs([(*r, 1, "x", b"y") for r in rows], SCHEMA + ", row_id long, tree string, leaf binary")
    got = shown(merkle.document_manifest(wide))
    assert got == plain(rows)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_tampering_is_found_and_no_rows_give_none(docs):
    rows = [(i, "a", "en", 3, f"l\n{i}") for i in range(40)]
    got = {r.doc_id: r.verified for r in merkle.document_manifest(docs(rows, SCHEMA)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 2 == 1 for i in range(40)}
    assert merkle.document_manifest(docs([], SCHEMA)).collect() == []


def test_stored_levels_link_to_parents(docs):
    stored = docs(rows_of(random.Random(5), 50, ["a", "b"]), SCHEMA)
    rows = stored.select("doc_id", "source", merkle.leaf([stored.doc_id]).alias("leaf"))
    manifest = merkle.build(rows, "source", ["doc_id"])
    nodes = {(r.tree, r.level, r.idx): r for r in manifest.nodes.collect()}
    roots = [k for k, r in nodes.items() if r.up_tree is None]
    assert len(roots) == 1
    for node in nodes.values():
        if node.up_tree is not None:
            assert nodes[node.up_tree, node.up_level, node.up_idx].children[node.slot] == node.digest


def test_numbers_span_lots(spark, docs):
    rows = [(i % 3 if i % 7 else None, str(i % 50)) for i in range(2000)]
    frame = docs(rows, "doc_id long, text string")
    got = ranks.numbered(frame, ["doc_id"], ["text"], lot_rows=130).collect()
    assert len({r.row_id for r in got}) == 2000
    for key in (None, 0, 1, 2):
        mine = sorted((r.position, r.text) for r in got if r.doc_id == key)
        assert [p for p, _ in mine] == list(range(len(mine))) and [t for _, t in mine] == sorted(t for _, t in mine)
        assert {r.members for r in got if r.doc_id == key} == {len(mine)}
    whole = ranks.numbered(frame, [], ["text"], lot_rows=300).collect()
    assert sorted(r.position for r in whole) == list(range(2000))
