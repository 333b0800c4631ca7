"""The pipeline: stages in order, each judged on its own input by brute force."""

from collections import Counter

import corpus_pipeline
import pytest
from test_chosen_path import brute
from test_native_operators import brute_lines, brute_mix
from test_packing import check

from saleslens.llm.quality_mil import THRESHOLD, fit_quality, scorer

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]
    for name, (_, after) in steps.items():
        assert name == "packing" or after.columns == COLUMNS


def test_quality_keeps_clean_documents(spark, steps):
    before, after = steps["quality"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r.doc_id for r in after.collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(good & kept) >= 0.97 * len(good) and len(bad & kept) <= 0.15 * len(bad)
    score = scorer(fit_quality(before, labels))
    assert kept == {r.doc_id for r in before.select("doc_id", score("text").alias("s")).collect() if r.s >= THRESHOLD}


def test_lines(steps):
    before, after = steps["line_dedup"]
    rows = [(r.doc_id, r.text, r.source) for r in before.collect()]
    want = {d: t for d, _, removed, t in brute_lines(rows, 10) if not (removed and not t.strip())}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_one_of_each_class_stays(steps):
    before, after = steps["near_duplicates"]
    want = {d for d, c, *_ in brute([(r.doc_id, r.text) for r in before.collect()]) if d == c}
    assert {r.doc_id for r in after.collect()} == want and after.count() == len(want)


def test_mix(steps):
    before, after = steps["mixing"]
    taken = {d: (n, t) for d, n, _, _, t in brute_mix([(r.doc_id, r.text, r.source) for r in before.collect()])}
    times = Counter(r.doc_id for r in after.collect())
    assert all(t == n * times[d] for d, (n, t) in taken.items())


def test_packed(steps):
    before, after = steps["packing"]
    check(after.collect(), [(r.doc_id, r.text) for r in before.collect()])


def test_run_and_registration(spark, steps):
    import __spark_entry__ as entry

    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
    assert sum(1 for q in entry.queries() if q.startswith("op")) == 13
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = sorted(tuple(r[c] for c in columns) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == sorted(tuple(r[c] for c in columns) for r in steps["packing"][1].collect())


def test_odd_documents_pass_through(spark):
    """Empty tables, NULLs, repeats, and columns with the names that stages use for their own."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (3, "x " * 30000, "en", "b", 60000), (None, "null id " * 9, "en", "a", 72)]
    extra = ["cid", "key", "_row", "row", "own", "_own", "score", "_score", "_lines", "_removed", "_gone", "n_lines", "size", "copies", "nth", "class_id"]
    docs = spark.createDataFrame(
        [(*r, *range(len(extra))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in extra))
    for name, stage in corpus_pipeline.STAGES:
        for own in (docs, docs.limit(0)):
            out = stage(spark, own, FOLDER)
            found = out.collect()
            assert out.columns == docs.columns or name == "packing"
            if name != "packing":
                assert all(tuple(r[c] for c in extra) == tuple(range(len(extra))) for r in found)


def test_near_duplicates_go_by_row(spark):
    """Of a class one row stays, whatever ids repeat or lack; what is similar to nothing stays though its id repeats."""
    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"}
    near = text["a"] + " more"
    rows = [(1, text["a"]), (5, near), (5, text["b"]), (5, text["c"])]  # b and c are clean, 5 belongs to the class of 1
    rows += [(7, text["d"])] * 4 + [(None, text["e"]), (9, text["e"]), (8, text["e"])] + [(None, text["f"])] * 2 + [(3, ""), (3, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    after = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, FOLDER)
    want = [(1, text["a"]), (5, text["b"]), (5, text["c"]), (7, text["d"]), (8, text["e"]), (None, text["f"]), (3, ""), (3, ""), (None, None)]
    assert after.columns == COLUMNS and Counter((r.doc_id, r.text) for r in after.collect()) == Counter(want)
