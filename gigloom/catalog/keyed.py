"""Dedupe, anti-joins, reasons, upsert, patch, retention, enrichment, board status."""

from pyspark.sql import functions as F

from gigloom.catalog.registry import Shape, query, table
from gigloom.functions.text import title_case
from gigloom.operators import keys as K
from gigloom.operators import merge as M
from gigloom.plans.careers import check_counts
from gigloom.plans.listing import board_status


def _rank(order, by="text"):
    return f"""SELECT doc_id, text, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS rn
        FROM documents) WHERE rn = 1"""


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "lang", "source")


@query(_rank("doc_id DESC"))
def dedupe_last(spark, sf):
    return K.dedupe(_docs(spark, sf), "text", "doc_id", "last")


@query(_rank("doc_id"))
def dedupe_first(spark, sf):
    return K.dedupe(_docs(spark, sf), "text", "doc_id", "first")


@query(_rank("doc_id DESC", "text, source"))
def dedupe_two_keys_last(spark, sf):
    return K.dedupe(_docs(spark, sf), ["text", "source"], "doc_id", "last")


@query(_rank("lang, doc_id", "source"))
def dedupe_hot_key_first(spark, sf):
    return K.dedupe(_docs(spark, sf), "source", ["lang", "doc_id"], "first")


@query("SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey * 2 = p_partkey)")
def new_only(spark, sf):
    sold = table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("p_partkey"))
    return K.new_only(table(spark, sf, "part").select("p_partkey", "p_name"), sold, "p_partkey")


@query("""SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus, nullif(o_custkey % 3, 0) * o_custkey AS k FROM orders)
    WHERE k IS NULL OR k NOT IN (SELECT c_custkey * 2 FROM customer)""")
def new_only_null_keys(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus", "nullif(o_custkey % 3, 0) * o_custkey AS k")
    seen = table(spark, sf, "customer").select((F.col("c_custkey") * 2).alias("k"))
    return K.new_only(rows, seen, "k").drop("k")


@query("""SELECT s_suppkey, EXISTS (SELECT 1 FROM customer WHERE c_custkey = s_suppkey * 7)
    OR EXISTS (SELECT 1 FROM customer WHERE c_nationkey + 13 = s_nationkey) AS known FROM supplier""")
def known_by_any(spark, sf):
    s = table(spark, sf, "supplier").selectExpr("s_suppkey", "CAST(s_suppkey * 7 AS STRING) AS a", "CAST(s_nationkey AS STRING) AS b")
    c = table(spark, sf, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS x", "CAST(c_nationkey + 13 AS STRING) AS y")
    return K.known_by_any(s, c, [("a", "x"), ("b", "y")]).select("s_suppkey", "known")


@query("""SELECT o_custkey AS company, arg_min(o_orderkey, (o_orderpriority, o_orderkey)) AS o_orderkey,
    arg_min(o_totalprice, (o_orderpriority, o_orderkey)) AS o_totalprice FROM orders GROUP BY 1""")
def pick_first(spark, sf):
    rows = table(spark, sf, "orders").withColumnRenamed("o_custkey", "company")
    return K.pick_first(rows, "company", ["o_orderpriority", "o_orderkey"], ["o_orderkey", "o_totalprice"])


REASONS = """CASE WHEN l.doc_id IS NOT NULL THEN 'exists' WHEN d.words <= 50 THEN 'short'
    WHEN d.n_chars % 5 = 0 THEN 'old' END"""
DOCS = """(SELECT *, CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0
    ELSE length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) - length(replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ', '')) + 1 END AS words FROM documents)"""


def _reasons(spark, sf):
    from gigloom.functions.text import words
    seen = table(spark, sf, "labels").select("doc_id").distinct().withColumn("seen", F.lit(True))
    docs = K.lookup_join(table(spark, sf, "documents"), seen, ["doc_id"])
    return K.skip_reasons(docs, [("exists", F.col("seen")), ("short", words("text") <= 50), ("old", F.col("n_chars") % 5 == 0)])


@query(f"SELECT d.doc_id, {REASONS} AS reason FROM {DOCS} d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def skip_reasons(spark, sf):
    return _reasons(spark, sf).select("doc_id", "reason")


@query(f"""SELECT coalesce({REASONS}, 'kept') AS reason, count(*) AS n FROM {DOCS} d
    LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY 1""")
def skip_counts(spark, sf):
    return K.reason_counts(_reasons(spark, sf))


CHECK = Shape("customer", id="CAST(c_custkey AS STRING)", name="c_name", status="CASE WHEN c_nationkey = 4 THEN 'scanned' WHEN c_nationkey = 5 THEN '  ' END",
              homepage_url="CASE WHEN c_nationkey = 7 THEN NULL ELSE concat(' https://H', CAST(c_custkey % 500 AS STRING), '.com') END",
              careers_url="CASE WHEN c_acctbal < 0 THEN 'ftp://x' ELSE concat('https://c.com/', CAST(c_custkey AS STRING)) END")
DONE = Shape("supplier", company_id="CAST(s_suppkey AS STRING)")


@query(f"""WITH c AS {CHECK.sql()}, done AS (SELECT DISTINCT lower(trim(homepage_url)) AS h FROM c
      WHERE id IN (SELECT company_id FROM {DONE.sql()}) AND homepage_url IS NOT NULL)
    SELECT CASE WHEN trim(coalesce(status, '')) <> '' THEN 'status' WHEN lower(trim(homepage_url)) IN (SELECT h FROM done)
      THEN 'homepage' ELSE 'kept' END AS reason, count(*) AS n FROM c WHERE careers_url LIKE 'http%' GROUP BY 1""")
def detection_counts(spark, sf):
    return check_counts(CHECK.df(spark, sf), DONE.df(spark, sf))


@query("SELECT p_partkey, upper(substr(p_name, 1, 1)) AS initial FROM part")
def map_distinct(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name")
    return K.map_distinct(rows, "p_name", lambda d: d.withColumn("initial", F.substring(title_case("p_name"), 1, 1)),
                          "initial").select("p_partkey", "initial")


@query("""SELECT s_suppkey AS id, s_name AS title, CAST(NULL AS STRING) AS extra FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def union_results(spark, sf):
    a = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS title")
    b = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS title", "c_mktsegment AS extra")
    return a.unionByName(b, allowMissingColumns=True)


# --- table changes ---------------------------------------------------------------------

OLD = Shape("orders", id="CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey END", status="o_orderstatus",
            price="o_totalprice", note="o_orderpriority", updated_at="o_orderdate", row_id="o_orderkey")
NEW = Shape("customer", id="CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey * 12 END",
            status="CASE c_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_mktsegment END",
            price="CASE c_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE c_acctbal END")


def _old_new(spark, sf):
    return OLD.df(spark, sf).select("id", "status", "price", "note", "row_id"), NEW.df(spark, sf)


def _upsert(status, price):
    return f"""WITH t AS {OLD.sql()}, s AS {NEW.sql()}
        SELECT coalesce(t.id, s.id) AS id, {status} AS status, {price} AS price, t.note, t.row_id
        FROM t FULL JOIN s ON t.id = s.id"""


@query(_upsert("CASE WHEN s.price IS NOT NULL OR s.id IS NOT NULL OR t.row_id IS NULL THEN s.status ELSE t.status END",
               "CASE WHEN s.id IS NOT NULL OR t.row_id IS NULL THEN s.price ELSE t.price END"))
def upsert_overwrite(spark, sf):
    return M.upsert(*_old_new(spark, sf), "id")


@query(_upsert("coalesce(s.status, t.status)", "coalesce(s.price, t.price)"))
def upsert_keep(spark, sf):
    return M.upsert(*_old_new(spark, sf), "id", nulls="keep")


@query("""SELECT o_orderkey AS id, coalesce(c.c_mktsegment, o_orderstatus) AS status FROM orders
    LEFT JOIN customer c ON c.c_custkey = o_orderkey""")
def status_update(spark, sf):
    return M.upsert(table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS status"),
                    K.lookup_join(table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS status"),
                                  table(spark, sf, "orders").selectExpr("o_orderkey AS id"), ["id"], "left_semi"), "id")


def _patch(status, price, touched):
    return f"""WITH t AS {OLD.sql()}, s AS (SELECT *, TRUE AS hit FROM {NEW.sql()} WHERE id IS NOT NULL)
        SELECT t.row_id, coalesce({status}, t.status) AS status, coalesce({price}, t.price) AS price,
        CASE WHEN {touched} THEN TIMESTAMP '2024-06-15 12:00:00' ELSE t.updated_at END AS updated_at
        FROM t LEFT JOIN s ON t.id = s.id"""


def _patched(spark, sf, **how):
    old = OLD.df(spark, sf).select("id", "status", "price", "updated_at", "row_id")
    return M.patch(old, NEW.df(spark, sf), "id", as_of="2024-06-15 12:00:00", **how).drop("id")


EMPTY = "nullif(s.status, '')"


@query(_patch(EMPTY, "s.price", f"coalesce({EMPTY}, CAST(s.price AS VARCHAR)) IS NOT NULL"))
def patch_none_empty(spark, sf):
    return _patched(spark, sf)


@query(_patch("s.status", "s.price", "coalesce(s.status, CAST(s.price AS VARCHAR)) IS NOT NULL"))
def patch_none(spark, sf):
    return _patched(spark, sf, drop="none")


@query(_patch(EMPTY, "nullif(s.price, 0)", f"coalesce({EMPTY}, CAST(nullif(s.price, 0) AS VARCHAR)) IS NOT NULL"))
def patch_falsy(spark, sf):
    return _patched(spark, sf, drop="falsy")


@query(_patch(EMPTY, "s.price", "coalesce(s.hit, FALSE)"))
def patch_always_stamped(spark, sf):
    return _patched(spark, sf, stamp="always")


DATED = "CASE WHEN event_id % 9 = 0 THEN NULL ELSE {} END"


@query(f"""SELECT event_id, day FROM (SELECT event_id, {DATED.format("strftime(ts, '%Y-%m-%d')")} AS day FROM events)
    WHERE day IS NULL OR day >= '2024-01-16'""")
def retention_days(spark, sf):
    day = DATED.format("date_format(ts, 'yyyy-MM-dd')")
    e = table(spark, sf, "events").selectExpr("event_id", f"{day} AS day")
    return M.retain(e, "day", "2024-04-15 12:00:00", days=90)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1999-08-31' - INTERVAL 6 MONTH")
def retention_months(spark, sf):
    return M.retain(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "1999-08-31 10:00:00", months=6)


LISTED = Shape("orders", key="o_orderkey", place="CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderpriority END",
               kind="o_orderstatus", price="o_totalprice")
TOLD = Shape("part", key="p_partkey * 5", place="p_brand", kind="CASE WHEN p_size > 25 THEN NULL ELSE p_type END",
             price="CASE WHEN p_size < 10 THEN NULL ELSE p_retailprice END", about="p_name")


def _enrich(place, kind, price, about):
    return f"""WITH l AS {LISTED.sql()}, d AS {TOLD.sql()} SELECT l.key, {place} AS place, {kind} AS kind,
        {price} AS price, {about} AS about FROM l LEFT JOIN d ON l.key = d.key"""


@query(_enrich("coalesce(d.place, nullif(l.place, ''))", "coalesce(d.kind, l.kind)", "coalesce(d.price, l.price)",
               "CASE WHEN d.key IS NULL THEN 'FAILED_TO_LOAD' ELSE d.about END"))
def enrich_detail_first(spark, sf):
    return M.enrich(LISTED.df(spark, sf), TOLD.df(spark, sf), "key", missing={"about": "FAILED_TO_LOAD"})


@query(_enrich("coalesce(nullif(l.place, ''), d.place)", "CASE WHEN d.key IS NULL THEN l.kind ELSE d.kind END", "l.price", "d.about"))
def enrich_listing_first(spark, sf):
    return M.enrich(LISTED.df(spark, sf), TOLD.df(spark, sf), "key",
                    prefer={"place": "listing", "kind": "detail_only", "price": "listing_only"})


def _status(strict):
    status = "CASE WHEN count(l.l_orderkey) > 0 THEN 'success' ELSE 'failed' END" if strict else "'success'"
    return f"""SELECT s_suppkey AS board, count(l.l_orderkey) AS n, {status} AS status
        FROM supplier LEFT JOIN lineitem l ON l_suppkey * 2 = s_suppkey GROUP BY 1"""


def _boards(spark, sf, strict):
    found = table(spark, sf, "lineitem").select((F.col("l_suppkey") * 2).alias("board"))
    return board_status(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("board")), found, "board", strict)


@query(_status(True))
def board_status_strict(spark, sf):
    return _boards(spark, sf, True)


@query(_status(False))
def board_status_any(spark, sf):
    return _boards(spark, sf, False)
