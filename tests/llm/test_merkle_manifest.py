"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from saleslens.llm import merkle_manifest as mm


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tag(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves):
    """Root, and for each leaf its (side, sibling) path."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            path.append((i % 2, level[i ^ 1] if i ^ 1 < len(level) else ""))
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for doc, source, lang, n, text in rows:
        leaf = h(tag(doc), tag(source), tag(lang), tag(n), tag(text))
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
        changed = h(tag(doc), tag(source), tag(lang), tag(n + 1), tag(text)) if hit else leaf
        groups[lang].append((doc is not None, doc or 0, leaf, doc, changed))
    langs = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for lang in langs:
        groups[lang].sort(key=lambda r: r[:3])
        trees.append(plain_tree([r[2] for r in groups[lang]]))
    root, tops = plain_tree([t[0] for t in trees])
    out = []
    for lang, (subroot, paths), top in zip(langs, trees, tops):
        for (_, _, leaf, doc, changed), path in zip(groups[lang], paths):
            got = changed
            for right, sibling in path + top:
                got = h(sibling, got) if right else h(got, sibling)
            out.append((doc, leaf, subroot, root, h(*[s for _, s in path + top]), got, got == root))
    return sorted(out, key=str)


def found(spark, rows):
    names = "doc_id long, source string, lang string, n_chars long, text string, grp int, pos int, leaf int, root int, path int, id int, row int"
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows], names)
    return sorted((tuple(r) for r in mm.audited(docs).collect()), key=str)


ODD = [(None, None, None, None, None), (None, "s", None, 3, "abc"), (1, "", "", 0, ""), (2, "s", "", None, None), (3, "-", "é", 1, "é"),
       (7, "x", "z", 9, "long " * 200_000), (7, "x", "z", 9, "again"), (7, "x", "z", 9, "again"), (7, "x", "z", 9, "again"), (-4, "x", "z", -1, "\x00")]


@pytest.mark.parametrize("bits", [1, 2, 3, 8])
def test_trees_of_all_sizes(spark, monkeypatch, bits):
    monkeypatch.setattr(mm, "BLOCK_BITS", bits)
    rows = list(ODD)
    # Groups of 1 to 9, 31 to 33 and one hot group; many rounds with small blocks.
    for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 31, 32, 33, 150):
        rows += [(1000 * n + i, f"s{i % 3}", f"lang{n}", i, f"text {i} of {n}") for i in range(n)]
    random.Random(bits).shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_tampered_rows_are_found(spark):
    rows = [(i, "s", f"l{i % 3}", i, "t") for i in range(200)] + [(i, "s", "l1", None, "t") for i in range(200, 300)]
    got = found(spark, rows)
    hit = {i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert hit and {r[0] for r in got if not r[-1]} == hit


def test_small_tables(spark):
    assert found(spark, []) == []
    (row,) = found(spark, [(5, "s", "en", 1, "t")])
    assert row[1] == row[2] == row[3] and row[4] == h() and row == brute([(5, "s", "en", 1, "t")])[0]
