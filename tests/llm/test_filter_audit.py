"""The filter audit against filters that are run one after the other."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa

from saleslens.llm import filter_audit as fa


def fails(rows):
    """The set of failed filters of each row."""
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    out = []
    for doc, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {"A"} if len(words) < 200 else set()
        own |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        own |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        own |= {"E"} if doc is not None and doc > first[t] else set()
        out.append(own)
    return out


def brute(rows, labels):
    good, toxic = ({d for d, *v in labels if v[k] == 1 and d is not None} for k in (0, 1))
    failed = fails(rows)
    parts = sorted({s or "" for *_, s in rows})
    out, shapley = [], defaultdict(int)
    for part in parts:
        own = [(doc, f) for (doc, _, s), f in zip(rows, failed) if (s or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left, gone = own, []
            for step, letter in enumerate(order, 1):
                removed = [r for r in left if letter in r[1]]
                redundant = sum(letter in f for _, f in gone)
                left, gone = [r for r in left if letter not in r[1]], gone + removed
                shapley[part, letter] += len(removed)
                out.append([part, order, step, len(left), len(removed), redundant, sum(f == {letter} for _, f in own),
                            sum(d in good for d, _ in removed), sum(d in toxic for d, _ in removed)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def found(spark, rows, labels):
    docs = spark.createDataFrame([(d, t, s, 1, "m", 2) for d, t, s in rows], "doc_id long, text string, source string, mask int, part string, n int")
    known = spark.createDataFrame([(*v, "p") for v in labels], "doc_id long, quality int, toxic int, part string")
    return sorted(tuple(r) for r in fa.filter_audit(docs, known).collect())


def documents(rng):
    filler = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        words = rng.sample(filler, rng.choice((3, 199, 200, 201, 250)))
        words += [rng.choice(filler[:3])] * rng.choice((0, 0, 199, 200, 201, 300))
        text = rng.choice((" ", "\t", "\x0b", " \r\n", "  ")).join(words)
        text += rng.choice(("", "", " a|b", " 5%", " end")) + rng.choice(("", "", "CAPS" * 40, "É" * 90, "Z" * round(len(text) * 0.02)))
        rows.append((i, text, rng.choice(("hot", "hot", "b", None, ""))))
    rows += [(200 + i, rows[i][1], rng.choice(("hot", "c"))) for i in range(60)] + [(500 + i, "same text", "hot") for i in range(80)]
    rows += [(None, "same text", "hot"), (None, "no id", "n"), (None, "no id", "n"), (3, "no id", "n"), (3, rows[3][1], "n"), (90, rows[5][1], "n"),
             (700, None, "e"), (701, "", "e"), (702, " \n", "e"), (703, "word " * 200_000, "long"), (704, "$" * 10, "only fails D and A"), (5, rows[5][1], None)]
    return rows


def test_audit_against_filters_in_order(spark):
    rng = random.Random(5)
    rows = documents(rng)
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 0, 1, None))) for i in range(0, 400, 2)]
    labels += [(0, 1, 1), (0, 0, 0), (None, 1, 1), (10**6, 1, 1)]
    assert len({frozenset(f) for f in fails(rows)}) > 12
    assert found(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert found(spark, [], [(1, 1, 1)]) == []
    got = found(spark, [(1, "", "s")], [])
    assert len(got) == 600 and got == brute([(1, "", "s")], [])


def test_ranks_are_the_first_failing_position():
    orders, rank = fa.removal_ranks(3)
    for mask in range(8):
        for o, order in enumerate(orders.tolist()):
            first = next((p for p, f in enumerate(order) if mask >> f & 1), 3)
            assert rank[mask, o] == first


def test_other_filters(spark):
    """The audit takes any masks and any number of filters."""
    rng = random.Random(6)
    own = Counter((f"p{rng.randrange(2)}", rng.randrange(8)) for _ in range(300))
    counts = spark.createDataFrame([(p, m, n, n // 2, 1) for (p, m), n in own.items()], "part string, mask int, n long, good long, toxic long")
    out = fa.audit(counts, "xyz").collect()
    assert len(out) == 2 * 6 * 3
    for r in out:
        early = sum(1 << "xyz".index(f) for f in r.filter_order[:r.step - 1])
        bit = 1 << "xyz".index(r.filter_order[r.step - 1])
        assert r.removed == sum(n for (p, m), n in own.items() if p == r.part and m & bit and not m & early)
        assert r.redundant == sum(n for (p, m), n in own.items() if p == r.part and m & bit and m & early)


def test_slices_of_a_column():
    texts = pa.array(["skip", "A b", None, "ÄÄ $", "x" * 5])
    assert fa.text_failures(texts.slice(1, 3)).tolist() == [fa.text_failures(pa.array([t], pa.string())).tolist()[0] for t in ("A b", None, "ÄÄ $")]
