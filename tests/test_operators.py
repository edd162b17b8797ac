"""Keyed operators: edge rows, hot and null keys, retries, incremental runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V
from gigloom.operators import keys as K
from gigloom.operators import merge as M
from gigloom.operators.match import nearest
from gigloom.plans import careers, publish
from gigloom.session import settled, shared_dir
from gigloom.sources import pages as P
from gigloom.sources import tables as T
from gigloom.streaming.incremental import append_new


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_dedupe_keeps_first_or_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z"), (None, 4, "n"), (None, 5, "m")], "k string, o int, v string")
    assert rows(K.dedupe(df, "k", "o", "last").where("k IS NOT NULL"), "k", "v") == [("a", "y"), ("b", "z")]
    assert rows(K.dedupe(df, "k", "o", "first").where("k IS NOT NULL"), "k", "v") == [("a", "x"), ("b", "z")]
    assert K.dedupe(df, "k", "o").columns == df.columns


def test_dedupe_aggregates_before_its_shuffle(spark):
    plan = K.dedupe(spark.range(100).selectExpr("id % 2 AS k", "id AS o"), "k", "o")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")  # printed top down


def test_hot_and_null_keys_are_spread(spark):
    """Null keys, a third of all rows, are dealt to many join tasks and all come through."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS k", "id AS v")
        out = K.new_only(df, spark.range(3000).selectExpr("id AS k"), "k")
        assert out.count() == 2000 + 2000
        nulls = out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(nulls) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 7 ELSE id END AS scrape_id")
        joined = T.with_parents(hot, spark.range(10).selectExpr("id AS scrape_id", "id * 2 AS x"))
        assert joined.count() == 6000 and joined.where("scrape_id = 7 AND x = 14").groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_new_only_keeps_duplicates_and_null_keys(spark):
    new = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1)], "k string, n int")
    old = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(rows(K.new_only(new, old, "k"), "k", "n"), key=str) == sorted([("b", 1), ("b", 2), (None, 1)], key=str)


def test_patch_variants(spark):
    t = spark.createDataFrame([(1, "old", 5, None), (2, "two", 6, None)], "id int, location string, min_exp int, updated_at timestamp")
    p = spark.createDataFrame([(1, "", 0)], "id int, location string, min_exp int")
    assert rows(M.patch(t, p, "id", as_of="2024-01-01"), "id", "location", "min_exp") == [(1, "old", 0), (2, "two", 6)]
    assert rows(M.patch(t, p, "id", drop="falsy"), "id", "location", "min_exp") == [(1, "old", 5), (2, "two", 6)]
    assert rows(M.patch(t, p, "id", drop="none"), "id", "location", "min_exp") == [(1, "", 0), (2, "two", 6)]
    stamped = M.patch(t, p, "id", drop="falsy", as_of="2024-01-01").where("updated_at IS NOT NULL")
    assert stamped.count() == 0 and M.patch(t, p, "id", drop="falsy", as_of="2024-01-01", stamp="always").where("updated_at IS NOT NULL").count() == 1


def test_upsert_variants(spark):
    t = spark.createDataFrame([(1, "a", "n1"), (2, "b", "n2"), (None, "c", "n3")], "id int, v string, note string")
    s = spark.createDataFrame([(2, None), (3, "d"), (None, "e")], "id int, v string")
    assert sorted(rows(M.upsert(t, s, "id"), "id", "v", "note"), key=str) == sorted(
        [(1, "a", "n1"), (2, None, "n2"), (3, "d", None), (None, "c", "n3"), (None, "e", None)], key=str)
    assert (2, "b", "n2") in rows(M.upsert(t, s, "id", nulls="keep").where("id IS NOT NULL"), "id", "v", "note")
    assert (2, "b", "n2") in rows(M.upsert(t, s, "id", fixed=["v"]).where("id IS NOT NULL"), "id", "v", "note")


def test_retain_keeps_cutoff_day_and_undated(spark):
    df = spark.createDataFrame([("2024-03-17",), ("2024-03-16",), (None,)], "d string")
    assert sorted(rows(M.retain(df, "d", "2024-06-15 12:00:00", days=90), "d"), key=str) == [("2024-03-17",), (None,)]


def test_skip_reasons_are_exclusive(spark):
    text = {"short": "word " * 50, "long": "word " * 51}
    jobs = spark.createDataFrame(
        [(1, True, text["short"], "2024-06-01"), (2, True, text["short"], "2020-01-01"), (3, True, text["long"], "2020-01-01"),
         (4, True, text["long"], None), (5, True, text["long"], "2024-06-01"), (6, False, text["long"], "2024-06-01")],
        "id long, is_active boolean, original_description string, published_date string")
    done = spark.createDataFrame([(1, "jobs"), (5, "jobs_sustain")], "job_id long, source_table string")
    got = dict(rows(publish.judged(jobs, done, publish.GENERAL, "2024-06-15 12:00:00"), "id", "reason"))
    assert got == {1: "exists", 2: "short", 3: "old", 4: "old", 5: None}
    assert rows(publish.wanted(jobs, done, publish.GENERAL, "2024-06-15 12:00:00"), "id") == [(5,)]


def test_parents_missing_row_differs_from_missing_name(spark):
    jobs = spark.createDataFrame([(1, "s1"), (2, "s2"), (3, "s3")], "id long, scrape_id string")
    scrapes = spark.createDataFrame([("s1", "a1"), ("s2", "a2")], "id string, ats_website_id string")
    ats = spark.createDataFrame([("a1", "c1", "x"), ("a2", "c2", "y")], "id string, company_id string, ats_name string")
    co = spark.createDataFrame([("c1", None, "u", "l", "d")], "id string, name string, homepage_url string, logo_file_name string, description string")
    got = dict(rows(T.with_parents(jobs, T.parents(scrapes, ats, co)), "id", "company_name"))
    assert got == {1: None, 2: "Unknown", 3: "Unknown"}


@pytest.mark.parametrize("block", [4096, 7])
def test_nearest_matches_brute_force(spark, block):
    rng = np.random.default_rng(3)
    vecs, cats = rng.normal(size=(200, 16)), rng.normal(size=(20, 16))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)] + [(999, None)], "id int, vec array<double>")
    c = spark.createDataFrame([(f"c{i}", i, [float(x) for x in v]) for i, v in enumerate(cats)], "category string, rank int, vec array<double>")
    scores = (vecs / np.linalg.norm(vecs, axis=1, keepdims=True)) @ (cats / np.linalg.norm(cats, axis=1, keepdims=True)).T
    want = {i: f"c{s.argmax()}" if s.max() >= 0.4 else "none" for i, s in enumerate(scores)} | {999: "none"}
    assert dict(rows(nearest(df, "vec", c, 0.4, "none", block=block), "id", "label")) == want


def test_incremental_runs_equal_one_run_and_repeat_safely(spark):
    root = settled(spark.range(1)).inputFiles() and f"{shared_dir(spark)}/inc"
    import uuid
    root = f"{root}-{uuid.uuid4().hex}"
    schema = "job_url string, title string, seq long"
    def land(lo, hi):
        spark.range(lo, hi).selectExpr("concat('u', id % 40) AS job_url", "concat('t', id) AS title", "id AS seq").write.mode("append").parquet(f"{root}/landed")
    def run(name):
        stream = spark.readStream.schema(schema).parquet(f"{root}/landed")
        append_new(stream, f"{root}/target", "job_url", "seq", f"{root}/{name}").awaitTermination()
        return spark.read.schema(schema).parquet(f"{root}/target")
    land(0, 30)
    assert run("a").count() == 30
    land(30, 100)
    assert run("a").count() == 40
    assert run("b").count() == 40  # a lost progress folder reads everything again and adds nothing
    assert run("b").where("seq < 30").count() == 30


def test_shared_folder_is_named_by_the_session():
    class Stub:
        def __init__(self, named, master):
            self.conf = {"spark.checkpoint.dir": named} if named else {}
            self.sparkContext = type("C", (), {"master": master, "getCheckpointDir": lambda s: None})()

    assert shared_dir(Stub("hdfs://shared/x", "yarn")) == "hdfs://shared/x"
    with pytest.raises(ValueError):
        shared_dir(Stub(None, "yarn"))


def test_nearest_takes_any_rank(spark):
    """Negative, sparse and null ranks, and ties, give one answer at every size of a block."""
    cats = [("a", -3, [1.0, 0.0]), ("b", 10**9, [0.0, 1.0]), ("c", None, [0.0, 1.0]), ("d", 5, [1.0, 0.0]), ("e", None, [-1.0, 0.0]), ("f", 0, None)]
    c = spark.createDataFrame(cats, "category string, rank long, vec array<double>")
    df = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [-1.0, 0.1]), (4, [-1.0, -1.0]), (5, None)], "id int, vec array<double>")
    for block in (1, 2, 4096):
        assert dict(rows(nearest(df, "vec", c, 0.8, "none", block=block), "id", "label")) == {1: "a", 2: "b", 3: "e", 4: "none", 5: "none"}
    assert {r.label for r in nearest(df, "vec", c.limit(0), 0.8, "none").collect()} == {"none"}


def test_upsert_does_not_move_the_target(spark):
    target = spark.range(1000).selectExpr("id", "id * 2 AS v", "'t' AS w")
    source = spark.sql("SELECT CAST(id AS BIGINT) AS id, CAST(v AS BIGINT) AS v FROM VALUES (5, NULL), (2000, 7), (NULL, 8) AS s(id, v)")
    out = M.upsert(target, source, "id")
    got = {r.id: (r.v, r.w) for r in out.collect()}
    assert (got[5], got[6], got[2000], got[None], len(got)) == ((None, "t"), (12, "t"), (7, None), (8, None), 1002)
    assert {r.id: r.v for r in M.upsert(target, source, "id", nulls="keep").collect()}[5] == 10
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "SortMergeJoin" not in plan


def test_repeated_batches_add_rows_without_a_key_once(spark, tmp_path):
    schema = "job_url string, title string, seq long"
    spark.createDataFrame([(None, "a", 1), ("u", "b", 2)], schema).write.parquet(f"{tmp_path}/landed")
    for name in ("a", "b"):
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/landed")
        append_new(stream, f"{tmp_path}/target", "job_url", "seq", f"{tmp_path}/{name}").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/target").count() == 2


def test_settled_tables_are_dropped(spark):
    from gigloom.session import drop_settled
    held = settled(spark.range(5))
    path = held.inputFiles()[0]
    drop_settled(spark)
    assert not T.exists(spark, path)


def test_replaced_tables_are_whole_at_any_time(spark, tmp_path):
    path = f"{tmp_path}/t"
    T.append(spark.range(3), path)
    assert spark.read.parquet(T.live(spark, path)).count() == 3
    for n in (4, 5, 6):
        before = T.live(spark, path)
        T.replace(spark.read.parquet(before).union(spark.range(1)), path)
        assert spark.read.parquet(T.live(spark, path)).count() == n
        assert T.live(spark, path) != before and T.exists(spark, before)  # a reader that has begun goes on
    T.append(spark.range(2), path)
    assert spark.read.parquet(T.live(spark, path)).count() == 8 and len(T._versions(spark, path)) == 2
    (tmp_path / "t/_versions/v99999999-broken").mkdir()  # a writer that died
    assert spark.read.parquet(T.live(spark, path)).count() == 8


@pytest.mark.parametrize("block", [4096, 2])
def test_nearest_of_odd_vectors(spark, block):
    cats = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 2, [0.0, 1.0]), ("c", 3, [1.0, 0.0]), ("d", 4, [1.0, 0.0, 0.0]), ("e", 5, [None, 1.0])],
                                 "category string, rank int, vec array<double>")
    df = spark.createDataFrame([(1, [2.0, 0.1]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [5.0, 0.0, 0.0]), (6, [1.0]), (7, [0.0, 0.0]), (8, [])],
                               "id int, vec array<double>")
    got = dict(rows(nearest(df, "vec", cats, 0.5, "none", block=block), "id", "label"))
    assert got == {1: "a", 2: "none", 3: "none", 4: "none", 5: "d", 6: "none", 7: "none", 8: "none"}


@pytest.mark.parametrize("block", [4096, 700])
def test_nearest_holds_a_chunk_of_many_vectors(spark, block):
    """200,000 distinct vectors in one task meet 1,500 categories: their scores together are 2.4 GB, a chunk's are 8 MB."""
    def peak(batches):
        import resource

        import pyarrow as pa
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024])], ["mb"])

    cats = spark.range(1500).selectExpr("concat('c', id) AS category", "cast(id AS int) AS rank", "array(cos(id / 1500), sin(id / 1500)) AS vec")
    df = spark.range(0, 200_000, 1, 1).selectExpr("id", "array(cos((id % 1500) / 1500) * (1 + id), sin((id % 1500) / 1500) * (1 + id)) AS vec")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = nearest(df, "vec", cats, 0.9, block=block)
        assert found.where("label <> concat('c', id % 1500)").count() == 0 and found.where("label is not null").count() == 200_000
        peaks = spark.range(1).mapInArrow(peak, "mb long").collect()
        assert all(r.mb < 1500 for r in peaks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_careers_search_reads_each_page_once(spark, monkeypatch):
    """A page that one company reaches in the first round of links and another in the second is parsed once and counts for both."""
    def a(to):
        return f"<p><a href='{to}'>Jobs</a></p>"
    pages = spark.createDataFrame([
        ("https://a.x/", a("/team"), 200), ("https://a.x/team", a("https://acme.keka.com/careers"), 200),
        ("https://b.x", a("/x"), 200), ("https://b.x/x", a("https://a.x/team#top"), 200), ("https://b.x/jobs", "gone", 404),
        ("https://c.x", a("/none"), 200)], "url string, html string, status int")
    sites = spark.createDataFrame([(1, "https://a.x"), (2, "https://b.x"), (3, "https://c.x"), (4, "https://d.x"), (5, None)], "list_id long, base string")
    read, own = [], P.captures

    def spied(pages, wanted, **how):
        read.append({r[0] for r in wanted.collect()})
        return own(pages, wanted, **how)
    monkeypatch.setattr(P, "captures", spied)
    got = {r.list_id: (r.careers_url.split("#")[0], r.confidence, r.method) for r in careers.search(sites, pages).collect()}
    assert got == {1: ("https://a.x/team", 0.9, "depth-1:links-to-ats"), 2: ("https://a.x/team", 0.9, "depth-2:links-to-ats")}
    assert read == [{"https://a.x", "https://b.x", "https://c.x"}, {"https://a.x/team", "https://b.x/x"}, set()]
