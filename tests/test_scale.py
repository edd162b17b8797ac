"""What keeps many small rows out of the driver and out of single tasks."""

import pytest
from pyspark.sql import functions as F

from gigloom.boards import BOARDS
from gigloom.catalog.registry import dealt
from gigloom.functions import fixed_values as V
from gigloom.functions import urls
from gigloom.functions.text import strip
from gigloom.operators import keys as K
from gigloom.operators.coverage import gaps
from gigloom.operators.match import closest_spelling, spellable
from gigloom.plans import listing
from gigloom.sources import pages as P


@pytest.fixture
def landed(spark, tmp_path):
    """A table whose file is far under the size that Spark broadcasts."""
    spark.range(300).selectExpr("id AS page_id", "concat('https://b.example.com/list/', id) AS url", "'<p>none</p>' AS html").write.parquet(f"{tmp_path}/p")
    return spark.read.parquet(f"{tmp_path}/p")


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookups_meet_by_shuffle_however_small_their_files(landed, how):
    for salts in (1, 8):
        met = K.lookup_join(landed, landed.select("url"), "url", how, salts=salts)
        assert "Broadcast" not in planned(met)
        assert met.count() == (0 if how == "left_anti" else 300)


def test_chosen_captures_meet_by_shuffle(landed):
    got = P.captures(landed, landed.where("page_id < 7").select("url"))
    assert "Broadcast" not in planned(got)
    assert got.count() == 7
    assert "Broadcast" not in planned(P.captures(landed.drop("page_id"), landed.select("url")))


def test_a_run_sends_no_board_through_the_driver(spark, landed):
    boards = landed.select(F.col("page_id").cast("string").alias("id"), F.lit("Keka").alias("ats_name"), F.col("url").alias("ats_url"))
    scrapes, fresh = listing.discover(BOARDS["keka"], boards, landed, landed.select(F.col("url").alias("job_url")), "2024-06-15 12:00:00")
    assert "Broadcast" not in planned(scrapes) and "Broadcast" not in planned(fresh)
    assert (scrapes.count(), fresh.count()) == (300, 0)


@pytest.mark.parametrize("name", list(BOARDS))
def test_whole_runs_send_no_rows_through_the_driver(spark, landed, monkeypatch, name):
    """With nothing written in between, so that the plan shows every join of the run."""
    monkeypatch.setattr(listing, "settled", lambda df: df)
    board, known = BOARDS[name], landed.select(F.col("url").alias("job_url"))
    boards = landed.select(F.col("page_id").cast("string").alias("id"), F.lit(board.ats).alias("ats_name"), F.col("url").alias("ats_url"))
    companies = landed.select(F.col("page_id").cast("string").alias("id"), F.lit("c").alias("company_name"),
                              F.lit(board.ats_once or board.ats).alias("ats_detected"), F.col("url").alias("jobs_page_url"))
    scrapes, fresh = listing.discover(board, boards, landed, known, "2024-06-15 12:00:00")
    once = listing.once(board, companies, landed, known, "2024-06-15 12:00:00")
    assert "Broadcast" not in planned(scrapes)
    for plan in (planned(fresh), planned(once)):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_spellings_are_compared_with_entries_of_like_length(spark):
    texts = ["Enginering", "Human Resorces", "Solar", "", None, "Operations / Strateg", "é" * 12]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    left = df.select(F.size(spellable(F.col("t"), V.LONG_DEPARTMENTS, 0.85))).collect()
    assert all(r[0] < len(V.LONG_DEPARTMENTS) / 3 for r in left)

    def best(t, threshold):
        """Of all entries, without leaving any out."""
        def edits(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a, 1):
                row, old = [i], row
                for j, y in enumerate(b, 1):
                    row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
            return row[-1]
        score = [(1 - edits(t, n) / max(len(t), len(n)), -i) for i, n in enumerate(V.LONG_DEPARTMENTS)] if t is not None else [(-1, 0)]
        top = max(score)
        return V.LONG_DEPARTMENTS[-top[1]] if top[0] >= threshold else None
    for threshold in (0.0, 0.3, 0.85, 1.0):
        got = [r[0] for r in df.select(closest_spelling("t", V.LONG_DEPARTMENTS, threshold)).collect()]
        assert got == [best(t, threshold) for t in texts]


def test_small_rows_of_few_splits_are_dealt_out(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert dealt(spark, str(tmp_path), "part").rdd.getNumPartitions() == K.partitions(spark.range(1))
    assert dealt(spark, str(tmp_path), "part").count() == 1000
    spark.range(1000).repartition(9).write.parquet(f"{tmp_path}/many.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(2**28))
    try:
        assert "Exchange" not in planned(dealt(spark, str(tmp_path), "many"))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_gaps_read_the_landed_spans_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(i):
        read.add(1)
        return i
    spans = spark.range(40).select(F.lit("s").alias("k"), F.udf(seen, "long")("id").alias("start"), (F.col("id") + 1).alias("stop"), F.lit(50).alias("total"))
    assert [tuple(r) for r in gaps(spans, ["k"]).collect()] == [("s", 50, 40, 50)]
    assert read.value == 40


def test_addresses_without_capitals_fragment_or_slash_pass_no_pattern(spark):
    """What the patterns give, but they are matched only where they would change something."""
    host = r"^\s*([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
    texts = ["https://a.example.com/jobs", "https://A.Example.com/Jobs", " https://a.b/x// ", "https://a.b/x/#y/", "https://a.b/\n#f", "#f", "/", "", None,
             "HTTP://É.b/É", "İ://x", " https://a.b/\u0085", "https://a.b?Q#", "a/\r\n"]
    df = spark.createDataFrame([(t,) for t in texts], "u string")
    bare = F.regexp_replace(F.regexp_replace(strip("u"), "#.*$", ""), "/+$", "")
    every = F.concat(F.lower(F.regexp_extract(bare, host, 1)), F.regexp_replace(bare, host, ""))
    for got, wanted in df.select(urls.key("u"), every).collect():
        assert got == wanted
    assert planned(df.select(urls.key("u"))).count("CASE WHEN") >= 2
