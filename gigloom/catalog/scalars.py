"""Text, number, date, URL and rule expressions over whole columns."""

from pyspark.sql import functions as F

from gigloom.catalog.expected import PATHS
from gigloom.catalog.registry import AS_OF, Shape, query, table
from gigloom.functions import dates as D
from gigloom.functions import fixed_values as V
from gigloom.functions import numbers as N
from gigloom.functions import rules as R
from gigloom.functions import text as T
from gigloom.functions import urls as U
from gigloom.operators.match import closest_spelling

CLEAN = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(shape: Shape, **exprs):
    """SQL over a shape: its key column plus expressions."""
    return "SELECT id, " + ", ".join(f"{e} AS {n}" for n, e in exprs.items()) + f" FROM {shape.sql()}"


def _of(shape, spark, sf, **cols):
    return shape.df(spark, sf, deal=True).select("id", *[c.alias(n) for n, c in cols.items()])


# --- text -------------------------------------------------------------------------------

DOC = Shape("documents", id="doc_id", text="text")


@query(_in(DOC, cleaned=CLEAN.format("text"), no_commas="regexp_replace(replace(text, ',', ' '), '^\\s+|\\s+$', '', 'g')",
           words=f"CASE WHEN {CLEAN.format('text')} = '' THEN 0 ELSE len(string_split({CLEAN.format('text')}, ' ')) END"))
def text_clean(spark, sf):
    return _of(DOC, spark, sf, cleaned=T.clean("text"), no_commas=T.commas_to_spaces("text"), words=T.words("text"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<br\s*/?>', chr(10), 'gi'),
    '</p\s*>', chr(10) || chr(10), 'gi'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages""")
def drop_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.drop_tags("html").alias("plain"))


NAMES = Shape("customer", id="c_custkey", company="CASE WHEN c_nationkey = 9 THEN NULL ELSE concat('  ', c_name, ', Inc. & Co. ') END",
              title="CASE WHEN c_nationkey = 8 THEN NULL ELSE concat(c_mktsegment, ' Engineer (', c_mktsegment, ')') END")
SLUG = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '-')"
SNAKE = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_')"


@query(_in(NAMES, slug=f"{SLUG.format('title')} || '-at-' || {SLUG.format(chr(34)+'company'+chr(34)).replace(chr(34)+'company'+chr(34), 'coalesce(company, ' + chr(39) + 'unknown' + chr(39) + ')')} || '-' || substr(md5(CAST(id AS VARCHAR)), 1, 6)",
           code=f"concat_ws('_', {SNAKE.format('company')}, {SNAKE.format('title')})"))
def slug_and_code(spark, sf):
    return _of(NAMES, spark, sf, slug=T.slug("title", "company", "id"), code=T.code_name("company", "title"))


PLACES = Shape(
    "part", id="p_partkey",
    place="CASE p_size % 10 WHEN 0 THEN NULL WHEN 1 THEN concat(p_name, ' (HQ) ..+ ', CAST(p_size AS STRING))"
          " WHEN 2 THEN concat('Sector-', CAST(p_size AS STRING), 'B ', p_name) WHEN 3 THEN concat(CAST(p_size AS STRING), ' MW Plant, ', p_name)"
          " WHEN 4 THEN concat('Work From Home, ', p_type) WHEN 5 THEN 'Head Office - Pune' WHEN 6 THEN concat('new-', p_name, ' o''neil')"
          " WHEN 7 THEN 'nan' WHEN 8 THEN concat(p_type, '  1/2 remote') ELSE concat(upper(p_name), '/', lower(p_type)) END",
    listed="CASE p_size % 4 WHEN 0 THEN concat(p_name, '; ', p_type) WHEN 1 THEN concat(p_name, ', ', p_type, ', India')"
           " WHEN 2 THEN concat(p_name, ' , ', p_type, ',', p_name, ', ', p_brand, ', India') ELSE concat(p_name, ', India, ', p_type, ', India') END")
LOC = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    CASE WHEN lower(coalesce(place, '')) = 'nan' THEN '' ELSE lower(coalesce(place, '')) END,
    '\.\.\+\s*\d+', '', 'g'), '\(.*?\)', '', 'g'), '\d+\/\d+|\d+\s*mw.*', '', 'g'), 'sector[-\s]*\d+[a-z]*', '', 'g'), '\s+', ' ', 'g'))"""
TITLED = "array_to_string(list_transform(regexp_extract_all({}, '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '')"


def _label(remote):
    hit = " OR ".join(f"contains({LOC}, '{w}')" for w in remote)
    return f"CASE WHEN {LOC} = '' THEN '' WHEN {hit} THEN 'Remote' WHEN contains({LOC}, 'head office') THEN 'Head Office' ELSE {TITLED.format(LOC)} END"


@query(_in(PLACES, cleaned=LOC, label=_label(["remote"]), wide_label=_label(["remote", "work from home", "wfh"])))
def location_label(spark, sf):
    return _of(PLACES, spark, sf, cleaned=T.clean_location("place"), label=T.standard_location("place"),
               wide_label=T.standard_location("place", ("remote", "work from home", "wfh")))


@query(f"""WITH p AS (SELECT id, listed, list_transform(string_split(listed, ','), lambda x: trim(x)) AS a FROM {PLACES.sql()}),
    e AS (SELECT id, unnest(a[1:len(a)-1]) AS city, generate_subscripts(a[1:len(a)-1], 1) AS i, a[len(a)] AS last FROM p WHERE len(a) > 3),
    f AS (SELECT id, city, min(i) AS i FROM e WHERE city <> last GROUP BY id, city),
    g AS (SELECT id, city, row_number() OVER (PARTITION BY id ORDER BY i) AS k FROM f),
    h AS (SELECT id, string_agg(city, ', ' ORDER BY k) AS two FROM g WHERE k <= 2 GROUP BY id)
    SELECT p.id, CASE WHEN contains(listed, ';') OR len(a) <= 3 THEN listed ELSE coalesce(two, '') || ', ' || a[len(a)] END AS short
    FROM p LEFT JOIN h ON p.id = h.id""")
def location_short(spark, sf):
    return _of(PLACES, spark, sf, short=T.shorten_location("listed"))


@query(_in(PLACES, answer=r"regexp_replace(split_part(split_part(trim('  ' || listed || chr(10) || 'x'), chr(10), 1), 'Example', 1), '[.: ]+$', '')"))
def location_answer(spark, sf):
    return _of(PLACES, spark, sf, answer=T.first_answer_line(F.concat(F.lit("  "), "listed", F.lit("\nx"))))


# every whole document becomes a sectioned description: its lines as bullets under changing headings
SECTIONED = r"""regexp_replace(concat(CASE WHEN doc_id % 3 = 0 THEN 'Intro' ELSE 'Responsibilities' END, chr(10), '- ',
    replace(text, chr(10), CASE doc_id % 4 WHEN 0 THEN concat(chr(10), '  - ') WHEN 1 THEN concat(chr(10), 'PERKS', chr(10), '- ')
    WHEN 2 THEN concat(chr(10), ' role ', chr(10), '-') ELSE concat(chr(10), 'qualifications', chr(10)) END)), 'qui', 'n/a')"""
SECTIONS = Shape("documents", id="doc_id", text=SECTIONED)
BAD = " OR ".join(f"contains(lower(line), {_q(p)})" for p in V.PLACEHOLDERS)


@query(rf"""WITH s AS (SELECT doc_id AS id, {SECTIONED.replace("'n/a')", "'n/a', 'g')")} AS text FROM documents),
    l AS (SELECT id, generate_subscripts(string_split(text, chr(10)), 1) AS i, trim(unnest(string_split(text, chr(10)))) AS line FROM s),
    h AS (SELECT *, CASE WHEN upper(line) IN ('ROLE', 'RESPONSIBILITIES') THEN 1 WHEN upper(line) IN ('REQUIREMENTS', 'QUALIFICATIONS') THEN 2
      WHEN upper(line) IN ('BENEFITS', 'PERKS') THEN 3 END AS head FROM l),
    w AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY id ORDER BY i) AS sec FROM h),
    b AS (SELECT id, sec, string_agg(line, chr(10) ORDER BY i) AS body FROM w WHERE head IS NULL AND sec IS NOT NULL
      AND starts_with(line, '-') AND NOT ({BAD}) GROUP BY id, sec)
    SELECT s.id, CASE WHEN r.body IS NULL THEN '' ELSE concat_ws(chr(10) || chr(10), 'ROLE' || chr(10) || r.body,
      'REQUIREMENTS' || chr(10) || q.body, 'BENEFITS' || chr(10) || f.body) END AS sections
    FROM s LEFT JOIN b r ON r.id = s.id AND r.sec = 1 LEFT JOIN b q ON q.id = s.id AND q.sec = 2
    LEFT JOIN b f ON f.id = s.id AND f.sec = 3""")
def section_rules(spark, sf):
    return _of(SECTIONS, spark, sf, sections=T.sections("text"))


@query(_in(DOC, first_line="trim(split_part(text, chr(10), 1))",
           place="list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1]",
           kind="CASE WHEN len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) >= 2 THEN trim(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[-1]) END"))
def first_and_last_line(spark, sf):
    cell = T.location_and_type("text")
    return _of(DOC, spark, sf, first_line=T.first_line("text"), place=cell["location"], kind=cell["job_type"])


@query(_in(DOC, bullets="array_to_string(list_filter(list_transform(string_split(text, '. '), lambda x: " + CLEAN.format("x") + "), lambda x: x <> ''), ' | ')",
           titled="concat_ws(chr(10) || chr(10), CASE WHEN " + CLEAN.format("split_part(text, chr(10), 1)") + " <> '' THEN '### Job Description' || chr(10) || " + CLEAN.format("split_part(text, chr(10), 1)") + " END, CASE WHEN " + CLEAN.format("substr(text, instr(text, chr(10)) + 1)") + " <> '' THEN '### Qualifications' || chr(10) || " + CLEAN.format("substr(text, instr(text, chr(10)) + 1)") + " END)",
           plain="concat_ws(chr(10) || chr(10), nullif(" + CLEAN.format("split_part(text, chr(10), 1)") + ", ''), nullif(" + CLEAN.format("substr(text, instr(text, chr(10)) + 1)") + ", ''))"))
def joined_parts(spark, sf):
    one, two = T.clean(F.split_part("text", F.lit("\n"), F.lit(1))), T.clean(F.expr("substring(text, instr(text, '\\n') + 1)"))
    return _of(DOC, spark, sf, bullets=T.bullets_or_text(F.split("text", r"\. "), F.col("text")),
               titled=T.titled_sections(("### Job Description", one), ("### Qualifications", two)),
               plain=T.plain_sections(one, two))


@query(r"""SELECT page_id, regexp_extract_all(html || url || ' "' || url || '"', 'https?://[^\s"''<>]+') AS urls FROM pages""")
def urls_in_text(spark, sf):
    whole = F.concat("html", "url", F.lit(' "'), "url", F.lit('"'))
    return table(spark, sf, "pages").select("page_id", T.urls_in(whole).alias("urls"))


KINDS = Shape("orders", id="o_orderkey", text="concat(o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN ' Time Type: Full time' ELSE ' Time: x' END, chr(10), o_orderstatus, ' /Location')")


@query(_in(KINDS, time_type=r"nullif(trim(regexp_extract(text, 'Time Type:\s*([A-Za-z ]+)', 1)), '')",
           unlabelled="trim(replace(replace(text, 'Location', ''), '/', ''))"))
def time_type(spark, sf):
    return _of(KINDS, spark, sf, time_type=T.time_type("text"), unlabelled=T.strip(
        F.replace(F.replace("text", F.lit("Location"), F.lit("")), F.lit("/"), F.lit(""))))


# --- numbers ----------------------------------------------------------------------------

EXPERIENCE = Shape(
    "part", id="p_partkey", text="CASE p_partkey % 9 WHEN 0 THEN 'Fresher' WHEN 1 THEN '0 Yrs' WHEN 2 THEN concat(CAST(p_size AS STRING), '+ years')"
    " WHEN 3 THEN concat(CAST(p_size AS STRING), ' - ', CAST(p_size + 3 AS STRING), ' yrs') WHEN 4 THEN concat(CAST(p_size AS STRING), ' to ', CAST(p_size + 1 AS STRING))"
    " WHEN 5 THEN concat(' ', CAST(p_size AS STRING), ' Years ') WHEN 6 THEN p_name WHEN 7 THEN concat('2-', CAST(p_size AS STRING), '+') END")


@query(f"""SELECT id, CAST(CASE WHEN contains(t, 'fresher') OR regexp_full_match(t, '0\\s*(years|yrs)?') THEN 0
      WHEN regexp_matches(t, '\\d+\\s*\\+') THEN CAST(regexp_extract(t, '(\\d+)\\s*\\+', 1) AS INT)
      WHEN regexp_matches(t, '\\d+') THEN CAST(regexp_extract(t, '(\\d+)', 1) AS INT) END AS INT) AS min_exp,
    CAST(CASE WHEN contains(t, 'fresher') OR regexp_full_match(t, '0\\s*(years|yrs)?') THEN 0
      WHEN regexp_matches(t, '\\d+\\s*\\+') THEN NULL
      WHEN regexp_matches(t, '\\d+\\s*(?:-|to)\\s*\\d+') THEN CAST(regexp_extract(t, '(\\d+)\\s*(?:-|to)\\s*(\\d+)', 2) AS INT)
      WHEN regexp_matches(t, '\\d+') THEN CAST(regexp_extract(t, '(\\d+)', 1) AS INT) END AS INT) AS max_exp
    FROM (SELECT id, trim(lower(coalesce(text, ''))) AS t FROM {EXPERIENCE.sql()})""")
def experience_parse(spark, sf):
    return EXPERIENCE.df(spark, sf).select("id", N.experience("text").alias("e")).select("id", "e.*")


RANGES = Shape("lineitem", id="l_orderkey", line="l_linenumber", part="l_partkey",
               low="CASE WHEN l_quantity > 40 THEN NULL ELSE CAST(l_linenumber - 1 AS INT) END",
               high="CASE WHEN l_quantity < 10 THEN NULL ELSE CAST(l_partkey % 6 AS INT) END")


@query(f"""SELECT id, line, part, CASE WHEN a < 1 AND b < 1 THEN NULL WHEN b > a THEN a || '-' || b || ' years' ELSE a || '+ years' END AS label
    FROM (SELECT *, coalesce(low, 0) AS a, coalesce(high, 0) AS b FROM {RANGES.sql()})""")
def experience_label(spark, sf):
    return RANGES.df(spark, sf).select("id", "line", "part", N.experience_label("low", "high").alias("label"))


# --- dates ------------------------------------------------------------------------------

NOW = f"TIMESTAMP '{AS_OF}'"
AGO = Shape(
    "events", id="event_id", n="CAST(user_id AS INT)",
    text="CASE event_type WHEN 'view' THEN concat(CAST(user_id AS STRING), ' days ago') WHEN 'click' THEN 'Posted Yesterday'"
         " WHEN 'error' THEN 'Just now' WHEN 'signup' THEN concat('Posted ', CAST(user_id AS STRING), '+ Days Ago') ELSE '1 day ago' END",
    unit="concat('Posted about ', CAST(user_id + 700001 * (CASE WHEN event_type IN ('view', 'click') THEN event_id % 2 ELSE 0 END) AS STRING), CASE event_type WHEN 'view' THEN ' minutes ago' WHEN 'click' THEN ' hours ago'"
         " WHEN 'error' THEN ' weeks ago' WHEN 'signup' THEN ' months ago' ELSE ' years ago' END)", kind="event_type")


@query(_in(AGO, posted=f"CASE kind WHEN 'view' THEN {NOW} - to_days(n) WHEN 'click' THEN {NOW} - to_days(1) WHEN 'error' THEN {NOW} WHEN 'signup' THEN NULL ELSE {NOW} - to_days(1) END",
           day=f"CAST(CASE kind WHEN 'view' THEN {NOW} - to_days(n) WHEN 'click' THEN {NOW} - to_days(1) WHEN 'error' THEN NULL WHEN 'signup' THEN {NOW} - to_days(n) ELSE {NOW} - to_days(1) END AS DATE)"))
def relative_dates(spark, sf):
    return _of(AGO, spark, sf, posted=D.relative("text", AS_OF), day=D.first_number_days("text", AS_OF))


UNITS = f"CASE kind WHEN 'view' THEN {{}} WHEN 'click' THEN {{}} WHEN 'error' THEN {NOW} - to_days(n * 7) WHEN 'signup' THEN {NOW} - to_days(n * 30) ELSE {NOW} - to_days(n * 365) END"


@query(_in(AGO, posted=UNITS.format(f"{NOW} - to_minutes(n + 700001 * (id % 2))", f"{NOW} - to_hours(n + 700001 * (id % 2))"), day=f"CAST({UNITS.format(NOW, NOW)} AS DATE)"))
def relative_unit_dates(spark, sf):
    return _of(AGO, spark, sf, posted=D.relative_units("unit", AS_OF), day=D.relative_units("unit", AS_OF, whole_days=True))


def _stamped(spark, sf, *patterns):
    o = table(spark, sf, "orders").withColumn("id", F.col("o_orderkey"))
    return o.select("id", *[F.date_format("o_orderdate", p).alias(f"t{i}") for i, p in enumerate(patterns)])


MD = "CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) ELSE CAST(o_orderdate AS DATE) END"


@query(f"""SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS us, CAST({MD} AS TIMESTAMP) AS dmy,
    CAST(o_orderdate AS TIMESTAMP) AS named, CAST(o_orderdate AS TIMESTAMP) AS dashed FROM orders""")
def month_first_dates(spark, sf):
    t = _stamped(spark, sf, "MM/dd/yyyy", "d/M/yyyy", "MMM d, yyyy", "d-MMM-yyyy")
    return t.select("id", D.month_first("t0").alias("us"), D.month_first("t1").alias("dmy"),
                    D.month_first(F.concat(F.lit("Posted On "), "t2")).alias("named"), D.month_first("t3").alias("dashed"))


@query(f"""SELECT o_orderkey AS id, CAST({MD} AS TIMESTAMP) AS us, CAST(o_orderdate AS TIMESTAMP) AS dmy,
    CAST(o_orderdate AS TIMESTAMP) AS named, CAST(o_orderdate AS TIMESTAMP) AS dashed FROM orders""")
def day_first_dates(spark, sf):
    t = _stamped(spark, sf, "M/d/yyyy", "dd/MM/yyyy", "MMMM d, yyyy", "dd-MM-yyyy")
    return t.select("id", D.day_first("t0").alias("us"), D.day_first("t1").alias("dmy"),
                    D.day_first("t2").alias("named"), D.day_first("t3").alias("dashed"))


@query("""SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS named, CAST(o_orderdate AS TIMESTAMP) AS dashed,
    CAST(NULL AS TIMESTAMP) AS slashed, CAST(o_orderdate AS DATE) AS leading FROM orders""")
def written_dates(spark, sf):
    t = _stamped(spark, sf, "MMM dd, yyyy", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd'T'HH:mm:ss")
    return t.select("id", D.relative_or_written("t0", AS_OF).alias("named"), D.relative_or_written("t1", AS_OF).alias("dashed"),
                    D.relative_or_written("t2", AS_OF).alias("slashed"), D.leading_date("t3").alias("leading"))


@query("""SELECT event_id AS id, date_trunc('second', ts) AS zulu, date_trunc('second', ts) - INTERVAL 330 MINUTE AS shifted,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, CAST(NULL AS TIMESTAMP) AS bad, strftime(ts, '%Y-%m-%d') AS printed FROM events""")
def iso_dates(spark, sf):
    e = table(spark, sf, "events")
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select(F.col("event_id").alias("id"), D.iso_or_written(F.concat(second, F.lit("Z"))).alias("zulu"),
                    D.iso_or_written(F.concat(second, F.lit("+05:30"))).alias("shifted"),
                    D.iso_or_written(F.date_format("ts", "dd/MM/yyyy")).alias("day"),
                    D.any_timestamp("event_type").alias("bad"), D.day_text("ts").alias("printed"))


# --- URLs -------------------------------------------------------------------------------

PAGE = Shape("pages", id="page_id", url="url", bare="concat('  ', replace(replace(url, 'https://', ''), 'http://', ''), '// ')")


@query(_in(PAGE, base="regexp_replace(url, '/+$', '')", bare="'https://' || regexp_replace(trim(bare), '/+$', '')",
           icon="'https://t1.gstatic.com/faviconV2?client=SOCIAL&type=FAVICON&fallback_opts=TYPE,SIZE,URL&url=' || regexp_replace(url, '/+$', '') || '&size=64'",
           careers="replace(regexp_replace(url, '^(https?://)(www\\.)?', '\\1'), '://', '://careers.')",
           origin="regexp_extract(url, '^(https?://[^/?#]*)', 1)"))
def url_base(spark, sf):
    return _of(PAGE, spark, sf, base=U.base("url"), bare=U.base("bare"), icon=U.icon("url"), careers=U.careers_host("url"),
               origin=U.origin("url"))


SITE = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"
PATH = "regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"


@query(_in(PAGE, rooted=f"{SITE} || '/jobs?x=1'", beside=f"{SITE} || regexp_replace({PATH}, '[^/]*$', '') || 'next/1'",
           up=f"{SITE} || regexp_replace(regexp_replace({PATH}, '[^/]*$', ''), '[^/]*/$', '') || 'a'",
           asked=f"{SITE} || {PATH} || '?p=2'", marked="regexp_replace(url, '#.*$', '') || '#top'",
           other="regexp_extract(url, '^(https?:)', 1) || '//cdn.example.com/x'", full="'mailto:a@b.c'", none="url"))
def url_join(spark, sf):
    def to(href):
        return U.absolute("url", F.lit(href))
    return _of(PAGE, spark, sf, rooted=to("/jobs?x=1"), beside=to("next/1"), up=to("../a"), asked=to("?p=2"), marked=to("#top"),
               other=to("//cdn.example.com/x"), full=to("mailto:a@b.c"), none=to(""))


TRACK = "ref=example&utm_medium=referral"


@query(_in(PAGE, tracked=f"regexp_extract(url, '^([^?#]*)', 1) || '?' || CASE WHEN contains(split_part(url, '#', 1), '?') THEN regexp_extract(url, '\\?([^#]*)', 1) || '&' ELSE '' END || '{TRACK}' || CASE WHEN contains(url, '#') THEN regexp_extract(url, '(#.*)$', 1) ELSE '' END",
           bare=f"CASE WHEN {SITE} LIKE '%//spam-farm.example.org' THEN regexp_extract(url, '^([^?#]*)', 1) END",
           relative="'/a?b'"))
def url_tracking(spark, sf):
    bare = U.tracked("url", TRACK, "spam-farm.example.org")
    return _of(PAGE, spark, sf, tracked=U.tracked("url", TRACK),
               bare=F.when(U.origin("url").endswith("//spam-farm.example.org"), bare), relative=U.tracked(F.lit("/a?b"), TRACK))


@query("SELECT s_suppkey, 'https://s' || s_suppkey || '.example.com' || p AS url FROM supplier, (SELECT unnest(["
       + ", ".join(_q(p) for p in PATHS) + "]) AS p)")
def path_candidates(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.explode(F.array(*[F.lit(p) for p in U.path_guesses()])).alias("p"))
    return s.select("s_suppkey", F.concat(F.lit("https://s"), F.col("s_suppkey").cast("string"), F.lit(".example.com"), "p").alias("url"))


ORACLE = Shape("supplier", id="s_suppkey", url="CASE s_nationkey % 3 WHEN 0 THEN concat('https://h', CAST(s_suppkey AS STRING), '.fa.us2.oraclecloud.com/hcmUI/sites//CX_', CAST(s_nationkey AS STRING), '/jobs?a=1') WHEN 1 THEN concat('https://sites/', s_name) ELSE 'https://x.com/sites/' END",
               raw="CASE s_nationkey % 4 WHEN 0 THEN concat('#/jobdetails/', CAST(s_suppkey AS STRING), '?x=1') WHEN 1 THEN '' WHEN 2 THEN 'https://k.keka.com/z' ELSE 'openings' END",
               nation="s_nationkey")


@query(_in(ORACLE, api_base="CASE WHEN nation % 3 = 0 THEN 'https://h' || id || '.fa.us2.oraclecloud.com' END",
           site_name="CASE WHEN nation % 3 = 0 THEN 'CX_' || nation END",
           job_url="CASE WHEN nation % 3 = 0 THEN 'https://h' || id || '.fa.us2.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_' || nation || '/job/9' END",
           spare="CASE WHEN nation % 3 = 0 THEN 'https://h' || id || '.fa.ocs.oraclecloud.com' END",
           detail="CASE nation % 4 WHEN 0 THEN 'https://c.keka.com/careers/jobdetails/' || id WHEN 1 THEN '' WHEN 2 THEN 'https://k.keka.com/z' ELSE 'https://c.keka.com/careers/openings' END"))
def url_builders(spark, sf):
    info = U.site_info("url")
    return _of(ORACLE, spark, sf, api_base=info["api_base"], site_name=info["site_name"],
               job_url=U.requisition_url(info["api_base"], info["site_name"], F.lit("9")), spare=U.alternate_host(info["api_base"]),
               detail=U.job_details_url(F.lit("https://c.keka.com/careers/"), "raw"))


# --- rules ------------------------------------------------------------------------------

TITLES = Shape(
    "lineitem", id="l_orderkey", line="l_linenumber", part="l_partkey",
    title="concat(CASE l_partkey % 25 WHEN 0 THEN 'Solar' WHEN 1 THEN 'ESG' WHEN 2 THEN 'Wastewater' WHEN 3 THEN 'QA' WHEN 4 THEN 'Software'"
          " WHEN 5 THEN 'BESS' WHEN 6 THEN 'Safety' WHEN 7 THEN 'Windows' WHEN 8 THEN 'EV charging' WHEN 9 THEN 'Data' WHEN 10 THEN 'Wind'"
          " WHEN 11 THEN 'Net Zero' WHEN 12 THEN 'Legal' WHEN 13 THEN 'HR' WHEN 14 THEN 'UI/UX' WHEN 15 THEN 'O&M' WHEN 16 THEN 'R&D'"
          " WHEN 17 THEN 'Field' WHEN 18 THEN 'GIS' WHEN 19 THEN 'Intern' WHEN 20 THEN '.net' WHEN 21 THEN 'Watershed' WHEN 22 THEN 'Clean Energy'"
          " WHEN 23 THEN 'pre-sales' ELSE l_shipmode END, CASE l_suppkey % 3 WHEN 0 THEN '-' ELSE ' ' END,"
          " CASE l_linenumber WHEN 1 THEN 'Engineer' WHEN 2 THEN 'Analyst' WHEN 3 THEN 'Officer' WHEN 4 THEN 'Manager' WHEN 5 THEN 'Scientist' WHEN 6 THEN 'storage' ELSE 'Lead' END)".replace("l_shipmode", "l_returnflag"))


def _titled(spark, sf, **cols):
    return TITLES.df(spark, sf, deal=True).select("id", "line", "part", *[c.alias(n) for n, c in cols.items()])


def _case(rules, default):
    whens = " ".join(f"WHEN regexp_matches(lower(title), {_q(p)}, 'i') THEN {_q(label)}" for p, label in rules)
    return f"CASE {whens} ELSE {_q(default)} END"


@query(f"SELECT id, line, part, regexp_matches(title, {_q(chr(92) + 'b(?:' + '|'.join(V.TITLE_WORDS) + ')' + chr(92) + 'b')}, 'i') AS passes FROM {TITLES.sql()}")
def title_gate(spark, sf):
    return _titled(spark, sf, passes=R.is_green_title("title"))


@query(f"SELECT id, line, part, {_case(V.GENERAL_DEPARTMENT_RULES, V.GENERAL_DEPARTMENT_DEFAULT)} AS department FROM {TITLES.sql()}")
def department_general(spark, sf):
    return _titled(spark, sf, department=R.first_match("title", V.GENERAL_DEPARTMENT_RULES, V.GENERAL_DEPARTMENT_DEFAULT))


@query(f"SELECT id, line, part, {_case(V.GREEN_DEPARTMENT_RULES, V.GREEN_DEPARTMENT_DEFAULT)} AS department FROM {TITLES.sql()}")
def department_green(spark, sf):
    return _titled(spark, sf, department=R.first_match("title", V.GREEN_DEPARTMENT_RULES, V.GREEN_DEPARTMENT_DEFAULT))


@query(f"SELECT id, line, part, {_case(V.LONG_DEPARTMENT_RULES, V.LONG_DEPARTMENT_DEFAULT)} AS department FROM {TITLES.sql()}")
def department_long(spark, sf):
    return _titled(spark, sf, department=R.first_match("title", V.LONG_DEPARTMENT_RULES, V.LONG_DEPARTMENT_DEFAULT))


SPELLED = Shape("customer", id="c_custkey", name="CASE c_nationkey % 5 WHEN 0 THEN 'Enginering' WHEN 1 THEN 'Human Resorces' WHEN 2 THEN 'Wind power' WHEN 3 THEN c_mktsegment ELSE 'Solar' END")


@query(f"""WITH v AS (SELECT DISTINCT name FROM {SPELLED.sql()}),
    c AS (SELECT unnest([{", ".join(_q(x) for x in V.LONG_DEPARTMENTS)}]) AS canon, generate_subscripts([{", ".join("0" for _ in V.LONG_DEPARTMENTS)}], 1) AS i),
    s AS (SELECT name, canon, i, 1 - levenshtein(name, canon) / greatest(length(name), length(canon)) AS score FROM v, c),
    b AS (SELECT name, arg_max(canon, (score, -i)) AS canon, max(score) AS score FROM s GROUP BY name)
    SELECT t.id, CASE WHEN b.score >= 0.85 THEN b.canon END AS closest FROM {SPELLED.sql()} t JOIN b ON t.name = b.name""")
def department_spelling(spark, sf):
    return _of(SPELLED, spark, sf, closest=closest_spelling("name", V.LONG_DEPARTMENTS))


TYPES = Shape("orders", id="o_orderkey", kind="CASE o_custkey % 9 WHEN 0 THEN '/ Full-time' WHEN 1 THEN 'PART_TIME' WHEN 2 THEN 'Full time' WHEN 3 THEN 'Contract'"
              " WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'International  transfer ' WHEN 7 THEN 'NA' ELSE concat(' ', o_orderpriority, ' ') END")


def _known(key, table_, otherwise):
    return f"CASE {key} " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table_.items()) + f" ELSE {otherwise} END"


SLASHED = "trim(replace(" + CLEAN.format("kind") + ", '/', ''))"


@query(_in(TYPES, underscored="nullif(" + _known("trim(replace(lower(" + CLEAN.format("kind") + "), '_', ' '))", V.JOB_TYPES, CLEAN.format("kind")) + ", '')",
           slashed="CASE WHEN coalesce(kind, '') <> '' THEN nullif(" + _known(f"lower({SLASHED})", V.JOB_TYPES, SLASHED) + ", '') END",
           titled="CASE WHEN coalesce(kind, '') NOT IN ('', 'NA') THEN " + _known("lower(" + CLEAN.format("kind") + ")", V.JOB_TYPES_TITLED, "trim(kind)") + " END",
           class_="CASE WHEN contains(lower(kind), 'intern') THEN 'Internship' WHEN regexp_matches(lower(kind), 'freelance|contract|part|fraction|training') THEN 'Contractor' ELSE 'Full Time' END"))
def job_types(spark, sf):
    return _of(TYPES, spark, sf, underscored=R.job_type("kind", underscores=True), slashed=R.job_type("kind", slashes=True),
               titled=R.job_type("kind", titled=True), class_=R.employment_class("kind"))


def _any(c, parts):
    return "(" + " OR ".join(f"contains(lower({c}), {_q(p)})" for p in parts) + ")"


BOARD_URL = Shape(
    "customer", id="c_custkey",
    url="CASE c_nationkey WHEN 0 THEN concat('https://c', CAST(c_custkey AS STRING), '.keka.com/careers') WHEN 1 THEN concat('https://jobs.lever.co/c', CAST(c_custkey AS STRING), '?x=1')"
        " WHEN 2 THEN concat('https://c', CAST(c_custkey AS STRING), '.ZOHOrecruit.in/jobs') WHEN 3 THEN concat('https://wd3.myworkdaysite.com/recruiting/c', CAST(c_custkey AS STRING), '/x')"
        " WHEN 4 THEN concat('https://apply.workable.com/c', CAST(c_custkey AS STRING), '/') WHEN 5 THEN 'https://recruitcrm.io/apply/1'"
        " WHEN 6 THEN concat('https://boards.greenhouse.io/c', CAST(c_custkey AS STRING), '/jobs/1') WHEN 7 THEN concat('https://career5.successfactors.com/career?x=1&company=c', CAST(c_custkey AS STRING), '&y')"
        " WHEN 8 THEN concat('http://c', CAST(c_custkey AS STRING), '.darwinbox.in/ms') WHEN 9 THEN concat('https://careers.smartrecruiters.com/c', CAST(c_custkey AS STRING), '#a')"
        " ELSE concat('https://c', CAST(c_custkey AS STRING), '.example.com/careers') END", nation="c_nationkey")
BUILT = {0: ("Keka", "'https://c' || id || '.keka.com/careers/'"), 1: ("Lever", "'https://jobs.lever.co/c' || id"),
         2: ("Zoho Recruit", "'https://c' || id || '.zohorecruit.in/jobs/careers'"), 3: ("Workday", "'https://c' || id || '.myworkdayjobs.com/en-US/Careers'"),
         4: ("Workable", "'https://apply.workable.com/c' || id || '/'"), 6: ("Greenhouse", "'https://boards.greenhouse.io/c' || id"),
         7: ("SuccessFactors", "'https://career5.successfactors.com/career?company=c' || id"),
         8: ("Darwinbox", "'https://c' || id || '.darwinbox.in/ms/candidatev2/main/careers/allJobs'"),
         9: ("SmartRecruiters", "'https://careers.smartrecruiters.com/c' || id")}


@query(_in(BOARD_URL, ats_name="CASE nation " + " ".join(f"WHEN {n} THEN {_q(a)}" for n, (a, _) in BUILT.items()) + " END",
           ats_url="CASE nation " + " ".join(f"WHEN {n} THEN {u}" for n, (_, u) in BUILT.items()) + " END",
           known_host=_any("url", V.PLATFORM_HOSTS), job_link=_any("url", V.JOB_LINK_WORDS)))
def platform_rules(spark, sf):
    return BOARD_URL.df(spark, sf).select("id", R.platform_of("url").alias("p"), R.on_platform("url").alias("known_host"),
                                          R.is_job_link("url").alias("job_link")).select("id", "p.*", "known_host", "job_link")


SCORE = "CASE WHEN contains(lower(text), 'jobposting') THEN 2 ELSE 0 END + " + " + ".join(
    f"CASE WHEN contains(lower(text), {_q(h)}) THEN 1 ELSE 0 END" for h in V.PAGE_HINTS)


@query(f"SELECT doc_id AS id, CAST({SCORE} AS INT) AS score FROM documents")
def page_score(spark, sf):
    return _of(DOC, spark, sf, score=R.page_score("text").cast("int"))


FEATURES = Shape("customer", id="c_custkey", url="CASE WHEN c_nationkey = 0 THEN 'https://x.keka.com' WHEN c_nationkey < 9 THEN 'https://x.com/Jobs' ELSE 'https://x.com' END",
                 score="CAST(c_custkey % 6 AS INT)", text_length="CAST(c_custkey % 1000 AS INT)", job_links="CAST(c_custkey % 8 AS INT)",
                 platform_links="CAST(c_nationkey % 2 AS INT)")


@query(_in(FEATURES, confidence="CASE WHEN contains(url, 'keka.com') THEN 0.95 WHEN platform_links > 0 THEN 0.9 WHEN job_links >= 5 THEN 0.8 WHEN score >= 3 AND text_length > 500 THEN 0.75 WHEN contains(lower(url), 'job') THEN 0.7 ELSE 0.0 END",
           reason="CASE WHEN contains(url, 'keka.com') THEN 'ats-url' WHEN contains(lower(url), 'job') THEN 'url-hint' WHEN score >= 3 AND text_length > 500 THEN 'content-hints' WHEN job_links >= 5 THEN 'many-jobish-links' WHEN platform_links > 0 THEN 'links-to-ats' ELSE 'low' END").replace("THEN 0.", "THEN 0.").replace("ELSE 0.0 END AS confidence", "ELSE 0.0 END::DOUBLE AS confidence"))
def careers_verdict(spark, sf):
    v = R.careers_verdict("url", "score", "text_length", "job_links", "platform_links")
    return FEATURES.df(spark, sf).select("id", v.alias("v")).select("id", "v.*")


GATES = Shape("customer", id="c_custkey", place="CASE c_nationkey % 10 WHEN 0 THEN 'Bengaluru, Karnataka' WHEN 1 THEN 'Indianapolis, Indiana' WHEN 2 THEN 'Remote' WHEN 3 THEN 'Remote - US' WHEN 4 THEN NULL WHEN 5 THEN 'Mumbai / Pune, India' WHEN 6 THEN c_mktsegment WHEN 7 THEN 'Hyderabad, Pakistan' WHEN 8 THEN 'remote india' WHEN 9 THEN concat(CASE c_custkey % 5 WHEN 0 THEN 'Kota Kinabalu, Malaysia' WHEN 1 THEN 'Surat Thani, Thailand' WHEN 2 THEN 'Agra, Kansas' WHEN 3 THEN 'Goa, Philippines' ELSE 'Goalpara' END, '') END",
              country="CASE c_nationkey % 5 WHEN 0 THEN 'IN' WHEN 1 THEN 'in' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE 'US' END", nation="c_nationkey")


@query(_in(GATES, in_india="(nation % 10) IN (0, 2, 5, 8)", country_ok="(nation % 5) <> 4"))
def place_gates(spark, sf):
    return _of(GATES, spark, sf, in_india=R.in_india("place"), country_ok=R.country_gate("country"))
