"""The pipeline against its stages' brute-force versions on a small corpus."""

import random

import corpus_pipeline
from oracle_check import connect, same

from quarrelscope.llm import quality, queries, tiling


def _words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "of", "and"]) if k % 4 == 0 else f"w{r.randrange(4000)}" for k in range(n))


def test_pipeline_on_planted_cases(spark, tmp_path):
    leak = _words(40, "leak")
    clean = [f"{_words(60, i)}\n{_words(60, -i - 1)}" for i in range(30)]
    near = [t.replace(" ", " x ", 1) for t in clean[:5]]
    bad = ["few words", "again and again the same words come " * 30, "### $$$ %%% " * 20]
    notice = "A notice line that stands in a great many of these documents."
    marked = [f"{_words(70, 1000 + i)}\n{notice}" for i in range(8)]
    texts = [*clean, *clean[5:10], *near, *bad, f"{_words(50, 77)} {leak} {_words(50, 78)}", *marked]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    rules = quality.Cascade()
    n = len(texts)
    assert seen["quality rules"] == {i for i, t in enumerate(texts) if rules.verdict(quality.Measured(t)) is None} == set(range(n)) - {40, 41, 42}
    assert seen["line dedup"] == seen["quality rules"]
    assert seen["near duplicates"] == set(range(30)) | set(range(43, n))
    items = tiling.Benchmark([(1, leak)])
    assert seen["decontamination"] == seen["near duplicates"] - {i for i, t in enumerate(texts) if list(items.leaks(t))} == seen["near duplicates"] - {43}
    assert seen["packing"] == seen["decontamination"]
    whole = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == seen["packing"]


def test_near_copies_of_a_large_group_are_caught_whole(spark, tmp_path):
    """Every copy has its own edited line; line dedup leaves it little else."""
    body = [_words(30, f"line {k}") for k in range(9)]
    copies = [[_words(6, f"edit {i}") + x[25:] if k == i else x for k, x in enumerate(body)] for i in range(9)]
    texts = ["\n".join(x) for x in [*copies, [_words(30, f"other {k}") for k in range(9)]]]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, _words(40, "leak"))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {0, 9}


def _benchmark(spark, folder, texts=("nothing of this stands anywhere in these documents at all",)):
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


CLASH = "_h long, _id long, _gone string, removed string, lines int, lead string, row int, fp string, node long, shard int"


def test_stages_keep_rows_and_columns_apart(spark, tmp_path):
    """Rows that share an id, null ids, repeated rows, columns named like the operators' own."""
    notice = "A notice line that stands in a great many of these documents."
    texts = {k: f"{_words(60, k)}\n{_words(30, k + k)}" for k in "abcdefgh"}
    leak = _words(40, "leak")
    rows = [(1, texts["a"]), (1, texts["b"]), (None, texts["c"]), (None, texts["d"]), (2, texts["e"] + "\n" + notice), (2, texts["f"] + "\n" + notice), (None, leak + " " + texts["g"]), (3, texts["h"]), (3, texts["h"]), (4, texts["h"]), (1, texts["g"] + leak), (9, None), (8, None)]
    rows = [(i, t, "en", "s", len(t or ""), 7 * k, k, f"gone {k}", "r", 5, "l", 6, "f", -k, 1) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")
    _benchmark(spark, tmp_path, [leak])
    by_k = lambda df: {r._id: r for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    before = {r["_id"]: r for r in docs.collect()}

    def same_but(got, before, *changed):
        for k, r in got.items():
            assert {c: r[c] for c in docs.columns if c not in changed} == {c: before[k][c] for c in docs.columns if c not in changed}

    for name in ("quality rules", "line dedup", "near duplicates", "decontamination"):
        out = stages[name](spark, docs, str(tmp_path))
        assert out.schema == docs.schema and stages[name](spark, docs.limit(0), str(tmp_path)).count() == 0
    got = by_k(stages["quality rules"](spark, docs, str(tmp_path)))
    assert set(got) == set(range(11))
    same_but(got, before)
    got = by_k(stages["line dedup"](spark, docs, str(tmp_path)))
    assert set(got) == set(range(13))
    same_but(got, before, "text", "n_chars")
    cut = {k for k in got if got[k].text != before[k].text}
    assert len(cut) == 1 and cut <= {4, 5} and all(got[k].text == before[k].text.removesuffix("\n" + notice) and got[k].n_chars == len(got[k].text) for k in cut)
    assert got[11].text is None
    got = by_k(stages["near duplicates"](spark, docs, str(tmp_path)))
    assert set(got) - {7, 8} == {0, 1, 2, 3, 4, 5, 6, 12}
    assert len(set(got) & {7, 8}) == 1
    same_but(got, before)
    got = by_k(stages["decontamination"](spark, docs, str(tmp_path)))
    assert set(got) == set(range(13)) - {6, 10}
    same_but(got, before)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in stages["packing"](spark, docs, str(tmp_path)).where("start = 0").collect()) == sorted((r[0] is None, r[0] or 0) for r in rows)


def test_pipeline_over_nulls_long_texts_and_an_empty_table(spark, tmp_path):
    long = "\n".join(_words(400, k) for k in range(120))
    rows = [(1, None), (2, ""), (None, long), (4, long), (5, " " * 1_000_000), (6, _words(90, 6)), (6, _words(90, 6))]
    for name, some in (("full", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame([(i, t, None, None, None) for i, t in some], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
        _benchmark(spark, folder)
        got = {r.doc_id for r in corpus_pipeline.run(spark, str(folder)).collect()}
        assert got == ({None, 6} if some else set())


def test_license_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = connect(sf)
    for name, sql in queries.ORACLE_SQL.items():
        same(queries.QUERIES[name](spark, sf), con, sql)
