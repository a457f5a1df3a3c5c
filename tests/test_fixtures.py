"""Small hand-made inputs with values worked out by hand."""

import datetime as dt
import gzip
import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from quarrelscope import program
from quarrelscope.functions import text as X
from quarrelscope.operators import documents, graph, polemic, ranks, topten, tree
from quarrelscope.plans.warehouse import Warehouse
from quarrelscope.sources import files, schema
from quarrelscope.sources.store import Store
from quarrelscope.streaming import editors

ROOT = [(0, None, None, 0), (1, "Alpha things", None, 0), (2, "Beta things", None, 0), (10, "Ten", "a", 1), (11, "Eleven", None, 1), (12, "Twelve", "c", 2)]
EDITS = [
    (10, 1, 100, "2005-03-01", 0), (10, 2, 101, "2005-06-01", 1), (10, 3, None, "2006-01-10", 1), (10, 4, 100, "2006-07-01", 0),
    (11, 1, 100, "2006-02-01", 0), (11, 2, 102, "2006-03-03", 2), (12, 1, 103, "2006-05-01", 0),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROOT, "page_id long, page_title string, page_abstract string, parent_id long").withColumn("page_type", tree.page_type())


@pytest.fixture(scope="module")
def revisions(spark):
    rows = [(p, s, u, False, 0.0, 0.0, r, False, dt.datetime.fromisoformat(d), int(d[:4])) for p, s, u, d, r in EDITS]
    return spark.createDataFrame(rows, "page_id long, rev_serialid int, user_id long, user_isbot boolean, rev_charweight double, rev_chardiff double, rev_isrevert int, rev_isreverted boolean, rev_timestamp timestamp_ntz, rev_year int")


@pytest.fixture(scope="module")
def warehouse(pages, revisions, tmp_path_factory):
    return Warehouse(pages, revisions, source=str(tmp_path_factory.mktemp("source")))


def test_live_articles_and_creation_years(warehouse):
    assert {r.year: r.totalpagecount for r in warehouse.live_articles.collect()} == {2005: 1, 2006: 3, 0: 3}
    years = {r.page_id: r.page_creationyear for r in warehouse.pages.collect()}
    assert years == {0: 2005, 1: 2005, 2: 2005, 10: 2005, 11: 2006, 12: 2006}


def test_counts(warehouse):
    got = {(r.page_id, r.year): (r.popularity, r.conflict) for r in warehouse.counts.collect()}
    assert got == {
        (0, 0): (4, 2), (0, 2005): (2, 1), (0, 2006): (3, 1), (1, 0): (3, 2), (1, 2005): (2, 1), (1, 2006): (2, 1), (2, 0): (1, 0), (2, 2006): (1, 0),
        (10, 0): (2, 1), (10, 2005): (2, 1), (10, 2006): (1, 0), (11, 0): (2, 1), (11, 2006): (2, 1), (12, 0): (1, 0), (12, 2006): (1, 0),
    }


def test_polemic_and_cube(warehouse):
    cube = {(r.type, r.page_id, r.year): r.weight for r in warehouse.cube.collect()}
    assert len(cube) == 32
    want = {(0, 0): 45.519590, (0, 2006): 7.156819, (1, 0): 45.519590, (1, 2006): 7.156819, (10, 0): 42.878222, (11, 0): 2.641369, (11, 2006): 7.156819}
    for (kind, page, year), weight in cube.items():
        if kind == "polemic":
            assert weight == pytest.approx(want.get((page, year), 0.0), abs=1e-5), (page, year)


def test_ranks(spark):
    cube = spark.createDataFrame([("conflict", i, 1, "article", 0, w) for i, w in enumerate([1.0, 1.0, 2.0, 5.0])] + [("conflict", 9, 2, "topic", 0, 3.0)], "type string, page_id long, topic_id long, page_type string, year int, weight double")
    got = {r.page_id: (round(r.percentile, 6), r.dense_percentile, r["rank"]) for r in ranks.ranked(cube).collect()}
    assert got == {0: (0, 0, 3), 1: (0, 0, 3), 2: (0.666667, 0.5, 2), 3: (1, 1, 1), 9: (0, 0, 1)}


@pytest.mark.parametrize(
    "changes, weight",
    [([(500, 1)], 1), ([(50, 0)], 10), ([(500, 1), (-20, 0)], 10), ([(150, 0)], 15), ([(50, 0), (150, 0), (300, 0)], 45), ([(999, 0), (999, 0)], 100)],
)
def test_contributions(spark, changes, weight):
    rows = [(1, 7, False, float(d), r) for d, r in changes] + [(1, None, False, 999.0, 0), (1, 8, True, 999.0, 0)]
    df = spark.createDataFrame(rows, "page_id long, user_id long, user_isbot boolean, rev_chardiff double, rev_isrevert int")
    assert [tuple(r) for r in graph.contributions(df).collect()] == [(1, 7, weight)]


def test_contribution_equals_the_fold(spark):
    import random

    random.seed(5)
    rows, want = [], {}
    for user in range(300):
        w = 0.0
        for _ in range(random.randint(1, 8)):
            d, r = float(random.choice([-50, 20, 99, 100, 101, 150, 400, 2000])), random.choice([0, 0, 1])
            rows.append((1, user, False, d, r))
            if r:
                w = max(w, 1)
            elif d <= 100:
                w = max(w, 10)
            else:
                w = min((0 if w <= 10 else w) + d / 10, 100)
        want[user] = w
    df = spark.createDataFrame(rows, "page_id long, user_id long, user_isbot boolean, rev_chardiff double, rev_isrevert int")
    assert {r.user_id: pytest.approx(r.weight) for r in graph.contributions(df).collect()} == want


def test_dominance_equals_all_pairs(spark):
    import random

    random.seed(6)
    points = [(i, y, random.randint(1, 9), random.randint(1, 5)) for i in range(200) for y in (0, 1)]
    cells = polemic.histogram(spark.createDataFrame(points, "page_id long, year int, popularity long, conflict long"))
    for r in polemic.dominance(cells).collect():
        assert r["count"] == sum(y == r.year and p <= r.popularity and c >= r.conflict for _, y, p, c in points)
    got = {(r.year, r.popularity, r.conflict): r["count"] for r in polemic.dominating(cells).collect()}
    assert got == {(y, p, c): sum(y == z and q <= p and d >= c for _, z, q, d in points) for _, y, p, c in points}


def _truncate(s, limit):
    """Restated: the last word end within the limit that something else follows within the limit."""
    import unicodedata

    data = s.encode()[:limit].decode(errors="ignore")
    word = lambda c: unicodedata.category(c)[0] in "LMN"
    ends = [k for k in range(1, len(data)) if word(data[k - 1]) and not word(data[k])]
    return data[: ends[-1]] if ends else ""


def test_smart_truncate(spark):
    import random

    random.seed(7)
    texts = ["hello", "hello world", "hello world.", "", "  ", "é" * 200, "a� b"] + ["".join(random.choice("ab é.日\n-1") for _ in range(random.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for limit in (256, 17):
        for t, got in df.select("t", X.smart_truncate("t", limit)).collect():
            assert got == _truncate(t, limit), (t, limit)


def test_strings(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(X.url_text(F.lit("a b/c?d#"))) == "a_b∕c？d＃"
    assert get(X.percentage(F.lit(0.995))) == 100
    assert get(X.topten_path(F.lit(0), F.lit("conflict"), F.lit("all"))) == "toptens/all/conflict/all.html"
    assert get(X.topten_title(F.lit(2006), F.lit("polemic"), F.lit("art"))) == "2006 Top Ten of Polemic for Art"
    assert get(X.page_path(F.lit("article"), F.lit("é" * 200))) == "articles/" + "é" * 122 + ".html"
    assert get(X.array_text(F.array(F.lit(1), F.lit(2)))) == "{1, 2}"
    assert get(X.byte_length(F.lit("é"))) == 2


def test_years_never_count_down(spark):
    assert spark.range(1).select(tree.years(F.lit(5), F.lit(3)), tree.years(F.lit(3), F.lit(5))).first()[:] == ([], [3, 4, 5])


def test_neighbours_keep_order_and_drop_unknown(spark, warehouse):
    jumps = spark.createDataFrame([(10, [12, 99, 11]), (11, [])], "page_id long, page_socialjumps array<long>")
    got = {r.page_id: [p.page_id for p in r.socialjumps or []] for r in documents.neighbours(warehouse.pages, jumps).collect()}
    assert got[10] == [12, 11] and got[11] == []


def test_toptens(spark):
    cube = spark.createDataFrame([("conflict", i, i % 2 + 1, "article", 0, float(i // 4)) for i in range(50)] + [("conflict", 99, 3, "article", 5, 0.0)], "type string, page_id long, topic_id long, page_type string, year int, weight double")
    got = {(r.year, r.topic_id): r.pages for r in topten.lists(topten.by_topic(cube)).collect()}
    assert got[0, 1] == [48, 44, 46, 40, 42, 36, 38, 32, 34, 28]
    assert got[0, 0] == [48, 49, 44, 45, 46, 47, 40, 41, 42, 43]
    assert got[5, 3] == [99] and (5, 1) not in got
    assert [r.year for r in topten.ordered(topten.lists(topten.by_topic(cube))).collect()][-1] == 0


def test_constraints(spark, pages, revisions):
    good = {r.rule: r.n for r in schema.violations(pages, revisions).collect()}
    assert set(good.values()) == {0}
    orphan = spark.createDataFrame([(50, "x", None, 77, "article"), (10, "Ten", None, 1, "article")], pages.schema)
    bad = {r.rule: r.n for r in schema.violations(pages.unionByName(orphan), revisions.unionByName(revisions.limit(1)).unionByName(revisions.limit(1).withColumn("page_id", F.lit(88).cast("long")))).collect()}
    assert bad["k1"] == 1 and bad["k2"] == 1 and bad["k3"] == 1 and bad["k4"] == 1 and bad["k6"] == 1


def test_constraints_broadcast_no_page_ids_and_deal_revisions_once(spark):
    from quarrelscope.sources import tables

    few = spark.range(9).selectExpr("id page_id", "'x' page_title", "id % 3 parent_id", "'article' page_type")  # of a known, small size
    edits = spark.range(9).selectExpr("id % 5 page_id", "int(id % 2) rev_serialid", "timestamp_ntz '2005-01-01' + make_interval(0, 0, 0, int(id)) rev_timestamp")
    assert "BroadcastHashJoin" not in _physical(schema.violations(few, edits))
    assert {r.rule: r.n for r in schema.violations(few, edits).collect()} == {"k1": 0, "k2": 0, "k3": 0, "k4": 0, "k5": 0, "k6": 4, "k7": 2, "title_length": 0, "page_type": 0}
    more = edits.unionByName(edits).unionByName(edits.where("page_id = 1")).unionByName(edits.selectExpr("page_id", "int(null) rev_serialid", "rev_timestamp"))
    assert {r.rule: r.n for r in schema.violations(few, more).collect()}["k3"] == more.groupBy("page_id", "rev_serialid").count().where("count > 1").count()
    plan = _physical(tables.revisions(spark, "/root/testdata/sf0.001"))
    assert "REPARTITION_BY_NUM" in plan and plan.count("hashpartitioning(page_id") == 1


def test_csv_keeps_null_and_empty_apart(spark, tmp_path):
    rows = [(1, 'say "hi"', None, 0), (2, "line\nfeed, comma", "", 1), (3, "back\\slash", "x", 1)]
    df = spark.createDataFrame(rows, schema.PAGES_CSV)
    files.write_csv(df, str(tmp_path / "p"))
    assert sorted(tuple(r) for r in files.read_csv(spark, str(tmp_path / "p"), schema.PAGES_CSV).collect()) == rows


def test_jumps_text_round_trip(spark):
    df = spark.createDataFrame([(1, [3, 2]), (2, [])], "page_id long, page_socialjumps array<long>")
    assert sorted((r.page_id, r.page_socialjumps) for r in files.jumps_in(files.jumps_out(df)).collect()) == [(1, [3, 2]), (2, [])]


def test_documents_and_tar(spark, warehouse, tmp_path):
    docs = warehouse.documents().collect()
    paths = {r.path for r in docs}
    assert {"index.html", "categories/Alpha_things.html", "articles/Ten.html", "toptens/all/conflict/all.html"} <= paths
    n = files.write_tar(docs, str(tmp_path / "out.tar.gz"))
    with tarfile.open(tmp_path / "out.tar.gz") as tar:
        assert len(tar.getnames()) == n == len(docs)
        import gzip

        body = tar.extractfile("html/articles/Ten.html.gz").read()
        assert b"<h1>Ten</h1>" in gzip.GzipFile(fileobj=io.BytesIO(body)).read()


def test_saved_warehouse_gives_the_same_cube(spark, warehouse, tmp_path):
    warehouse.save(str(tmp_path / "w"))
    opened = Warehouse.opened(spark, str(tmp_path / "w"))
    rows = lambda w: sorted(tuple(r) for r in w.cube.select("type", "page_id", "year", "weight").collect())
    assert rows(opened) == rows(warehouse)


def test_bucketed_tables_need_no_shuffle_of_revisions(spark, warehouse, tmp_path):
    warehouse.save_tables("fixture_db", str(tmp_path / "db"), 4)
    try:
        opened = Warehouse.of_database(spark, "fixture_db")
        rows = lambda w: sorted(tuple(r) for r in w.counts.collect())
        assert rows(opened) == rows(warehouse)
        counted = opened.revisions.groupBy("page_id").count()
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
        assert spark.sql("DESCRIBE EXTENDED fixture_db.revisions").where("col_name = 'Statistics'").count() == 1
    finally:
        Warehouse.drop_tables(spark, "fixture_db")
    assert not spark.catalog.databaseExists("fixture_db")


def test_store_follows_its_files_and_deletes(spark, tmp_path):
    store, made = Store(), []

    def make():
        made.append(1)
        return spark.range(len(made))

    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    count = lambda: store.table(spark, str(tmp_path), "t", make).count()
    assert [count(), count(), len(made)] == [1, 1, 1]
    spark.range(5).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert [count(), count(), len(made)] == [2, 2, 2]
    path = store._known[spark.sparkContext.applicationId, str(tmp_path), "t"][0]
    assert os.path.isdir(path) and store.forget(spark, str(tmp_path)) == 1 and not os.path.exists(path)
    assert store.forget(spark) == 0 and count() == 3


def test_processes_and_test_mode(spark, pages, revisions):
    seen = []
    watch = lambda p, r: seen.append(r.count())
    no_bots = lambda p, r: (p, r.where("user_id != 100 or user_id is null"))
    p, r = files.taken_in(pages, revisions, [watch, no_bots, watch])
    assert seen == [7, 4] and p.count() == 6 and r.count() == 4
    many = spark.range(1000, 3000).selectExpr("id as page_id", "'x' as page_title", "'a' as page_abstract", "1L as parent_id", "'article' as page_type").unionByName(pages.where("page_type != 'article'"))
    p, r = files.taken_in(many, revisions, test_percent=10)
    assert p.where("page_type != 'article'").count() == 3 and 100 < p.count() < 300
    assert r.count() == 0


def test_a_file_for_each_document(spark, warehouse, tmp_path):
    files.write_tree(warehouse.documents(), str(tmp_path))
    files.write_tree(warehouse.documents(), str(tmp_path))  # again: files are replaced
    found = {os.path.relpath(os.path.join(d, f), tmp_path) for d, _, names in os.walk(tmp_path) for f in names}
    assert found == {r.path + ".gz" for r in warehouse.documents().collect()}
    assert "<h1>Ten</h1>" in gzip.decompress((tmp_path / "articles/Ten.html.gz").read_bytes()).decode()
    files.write_documents(warehouse.documents(), str(tmp_path / "lines"))
    assert {r.path for r in spark.read.json(str(tmp_path / "lines")).collect()} == {x.removesuffix(".gz") for x in found}


def test_documents_come_in_order_and_name_times_and_words(spark, warehouse):
    words = spark.createDataFrame([(0, {"Word2Occur": '{"of":2}'}), (10, {"BWord2Occur": '{"damn":1}'})], "id long, fields map<string,string>")
    fields = warehouse.enrichment(external=(words,))
    docs = list(warehouse.documents("it", "http://it.example.org", fields, ordered=True).toLocalIterator())
    assert [d.path for d in docs][:6] == ["index.html", "categories/Alpha_things.html", "categories/Beta_things.html", "articles/Ten.html", "articles/Eleven.html", "articles/Twelve.html"]
    assert len({d.path for d in docs}) == len(docs) and docs[-1].path.startswith("toptens/all/")
    by = {d.path: d.data for d in docs}
    assert 'const Word2Occur = {"of": 2};' in by["index.html"] and 'const address = "http://it.example.org";' in by["index.html"] and "ranking_fields" in by["index.html"]
    assert 'const BWord2Occur = {"damn": 1};' in by["articles/Ten.html"] and "const Word2TFIDF" in by["articles/Ten.html"] and "ranking_fields" not in by["articles/Ten.html"]
    assert all('"first": "2005-03-01T00:00:00Z"' in d and '"maxyear": 2006' in d for p, d in by.items() if not p.startswith("toptens"))


def test_scripts_and_markup_are_escaped():
    assert "</script>" not in documents._script({"a": "</script>\u2028"})
    assert documents._entries([{"topic": '"', "title": "<b>", "abstract": "&"}]) == '<ol><li data-topic="&quot;"><cite>&lt;b&gt;</cite> &amp;</li></ol>'


def test_program_from_tables_to_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(program, "TEST_PERCENT", 20)
    out, folder = str(tmp_path / "x.tar.gz"), str(tmp_path / "savepoint")
    told = ["--tables", "/root/testdata/sf0.001", "--folder", folder, "--out", out, "--lang", "de", "--url", "http://%s.example.org"]
    n = program.main([*told, "--test", "--words", "--keep"], spark)
    with tarfile.open(out) as tar:
        names = tar.getnames()
        home = gzip.decompress(tar.extractfile("html/index.html.gz").read()).decode()
    assert len(names) == len(set(names)) == n > 100 and 'lang="de"' in home and "http://de.example.org" in home and "const Word2Occur" in home
    assert program.main([*told, "--source", "savepoint", "--out", out + "2"], spark) == n
    with tarfile.open(out + "2") as tar:
        assert tar.getnames() == names  # the saved statistics and the kept files give the same archive
        assert gzip.decompress(tar.extractfile("html/index.html.gz").read()).decode() == home
    assert not os.path.exists(folder)
    with pytest.raises(SystemExit):
        program.main(["--folder", folder], spark)
    with pytest.raises(SystemExit):
        program.main(["--source", "disk"], spark)


def test_similarities_of_heavy_users_equal_all_pairs(spark):
    import math
    import random

    random.seed(3)
    edges = [(p, u, float(random.choice([1, 10, 55]))) for u in range(12) for p in random.sample(range(60), 50 if u < 2 else 5)]
    df = spark.createDataFrame(edges, "page_id long, user_id long, weight double")
    w = {(p, u): x for p, u, x in edges}
    norm = {p: math.sqrt(sum(x * x for (q, _), x in w.items() if q == p)) for p, _ in w}
    want = {(a, b): sum(w[a, u] * w[b, u] for u in range(12) if (a, u) in w and (b, u) in w) / norm[a] / norm[b] for a in norm for b in norm if a < b and any((a, u) in w and (b, u) in w for u in range(12))}
    for block in (1000, 7):
        got = {(r.a, r.b): r.similarity for r in graph.similarities(df, block).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())


def test_best_similarities_hold_all_neighbours(spark):
    import random

    random.seed(4)
    edges = [(p, u, float(random.choice([1, 10]))) for u in range(40) for p in random.sample(range(-30, 60), 12)]
    df = spark.createDataFrame(edges, "page_id long, user_id long, weight double")
    every, some = graph.similarities(df), graph.similarities(df, 7, 3)
    rows = lambda d: sorted(map(tuple, graph.jumps(d, 3).collect()))
    assert rows(some) == rows(every) and some.count() < every.count()


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_pages_are_never_shuffled(spark):
    df = spark.createDataFrame([(1, 7, 1.0)], "page_id long, user_id long, weight double")
    plan = _physical(graph.similarities(df))
    assert "hashpartitioning(_i" in plan and not {"hashpartitioning(a#", "hashpartitioning(least"} & set(plan.split())
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 1  # the one with the norms, no join of edges with edges


def test_tables_of_pages_are_never_broadcast(warehouse, pages, spark):
    weights = spark.createDataFrame([(10, 2005, 1.0)], "page_id long, year int, weight double")
    listed = spark.createDataFrame([(10, [1])], "page_id long, page_socialjumps array<long>")
    for df in (polemic.articles_polemic(weights, weights), polemic.rolled_up(weights, pages.select("page_id", "parent_id")), documents.page_infos(warehouse.pages.drop("page_creationyear").withColumn("page_creationyear", F.lit(1)), listed.withColumnRenamed("page_socialjumps", "stats"), documents.neighbours(warehouse.pages, listed))):
        assert "SortMergeJoin" in _physical(df) and "BroadcastHashJoin" not in _physical(df)


def test_pairs_and_standings_are_never_broadcast(spark):
    year = "int(id % 2 + 2005) year"
    pairs = spark.range(9).selectExpr("id page_id", year, "id % 3 + 1 popularity", "id % 2 + 1 conflict")  # of a known, small size
    live = spark.range(1).selectExpr(year, "9L totalpagecount")
    cells = spark.range(2).selectExpr(year, "id + 1 popularity", "id + 1 conflict", "3L count")
    plan = _physical(polemic.untimed(pairs, cells, live))
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1  # the latter with the live articles, a row a year
    cube = spark.range(9).selectExpr("'conflict' type", "id page_id", "1L topic_id", "'article' page_type", "0 year", "double(id % 4) weight")
    plan = _physical(ranks.standings(cube))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.fixture
def exchanges(spark, monkeypatch):
    """Makes a table of a warehouse with a fresh store; by name, the exchanges in the plan of each table written for it."""
    from quarrelscope.plans import warehouse as plans

    class Counting(Store):
        def table(self, session, source, name, make):
            def made():
                df = make()
                found[name] = _physical(df).count("Exchange ")
                return df

            return super().table(session, source, name, made)

    found, store = {}, Counting()
    monkeypatch.setattr(plans, "STORE", store)

    def of(table):
        getattr(Warehouse.of_tables(spark, "/root/testdata/sf0.001"), table)
        return found

    yield of
    store.forget(spark)


def test_plan_of_the_cube_stays_small(exchanges):
    assert max(exchanges("cube").values()) <= 16  # 48 when all that it reads twice stood in its plan twice


def test_plan_of_the_ranks_stays_small(exchanges):
    assert exchanges("ranked")["ranked"] <= 8  # 30 when each of the standings stood in it twice


def test_plan_of_the_top_ten_lists_stays_small(exchanges):
    assert exchanges("topten_lists")["topten_lists"] <= 8  # 14 when the top tens of topics stood in it six times


def test_roll_up_to_all_time_needs_no_shuffle_of_its_own(warehouse):
    from quarrelscope.operators import social

    plan = _physical(social.rolled_up(warehouse.article_editors, warehouse.pagetree))
    assert "hashpartitioning(page_id#" in plan and ", year#" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_csv_keeps_white_space_and_odd_texts(spark, tmp_path):
    odd = ["  lead", "trail  ", "\n", " ", "a\n", "\t", "\\N", "", None, '"', "a\r\nb"]
    df = spark.createDataFrame([(i + 1, str(i), t, 5) for i, t in enumerate(odd)], "page_id long, page_title string, page_abstract string, parent_id long")
    files.write_csv(files.pages_out(df), str(tmp_path / "pages"))
    back = {r.page_id: r.page_abstract for r in files.pages_in(files.read_csv(spark, str(tmp_path / "pages"), schema.PAGES_CSV)).collect()}
    assert [back[i + 1] for i in range(len(odd))] == odd


def test_words_are_counted_where_texts_stand(spark):
    plan = _physical(documents.word_counts(spark.createDataFrame([(1, "a b a")], "id long, text string")))
    assert plan.count("Exchange") == 1
    counts = documents.word_counts(spark.createDataFrame([(i, f"all w{i % 900} w{i}" if i else "all") for i in range(1200)], "id long, text string"))
    import math

    got = {(r.id, r.word): r.tfidf for r in documents.tf_idf(counts).collect()}
    assert len(got) == counts.count() and got[5, "all"] == 0 and got[5, "w"] == round(2 * math.log(1200 / 1199), 9)


def test_first_edits_of_a_stream(spark, tmp_path):
    rows = [(1, 7, dt.datetime(2005, 1, 1)), (1, 7, dt.datetime(2005, 1, 3)), (1, 8, dt.datetime(2005, 1, 2)), (1, None, dt.datetime(2005, 1, 2)), (2, 7, dt.datetime(2006, 1, 1))]
    spark.createDataFrame(rows, "page_id long, user_id long, rev_timestamp timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("page_id long, user_id long, rev_timestamp timestamp").parquet(str(tmp_path / "in"))
    q = editors.first_edits(stream).writeStream.format("memory").queryName("first_edits").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.page_id, r.user_id, r.year) for r in spark.table("first_edits").collect()) == [(1, 7, 2005), (1, 8, 2005), (2, 7, 2006)]


def test_options():
    assert files.Options(lang="it").url() == "http://it.example.org"
    with pytest.raises(ValueError):
        files.Options(source="disk")
    with pytest.raises(ValueError):
        files.Options(base_url="%s%s")


def test_sampling_is_stable(spark):
    df = spark.range(1000)
    assert files.sampled(df, "id", 10).collect() == files.sampled(df, "id", 10).collect()
