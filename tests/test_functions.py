"""Golden cases; expected values were worked out by hand."""

import datetime as dt
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gigloom.functions import dates as D
from gigloom.functions import numbers as N
from gigloom.functions import rules as R
from gigloom.functions import text as T
from gigloom.functions import urls as U
from gigloom.functions import fixed_values as V
from gigloom.operators.match import closest_spelling

NOW = "2024-06-15 12:00:00"


def at(y, m, d, h=0, mi=0):
    return dt.datetime(y, m, d, h, mi)


CASES = [
    (N.experience, {"Fresher": (0, 0), "0 Yrs": (0, 0), "0": (0, 0), "5+ years": (5, None), "2-5+": (5, None), "2 - 4 yrs": (2, 4),
                    "2 to 4": (2, 4), "2–4": (2, 2), "3 years": (3, 3), "0-1 years": (0, 1), "n/a": (None, None), None: (None, None)}),
    (lambda c: D.relative(c, NOW), {"3 days ago": at(2024, 6, 12, 12), "yesterday": at(2024, 6, 14, 12), "just now": at(2024, 6, 15, 12),
                                    "30+ days ago": None, "99999999999 days ago": None, None: None}),
    (D.month_first, {"01/02/2024": at(2024, 1, 2), "13/02/2024": at(2024, 2, 13), "Posted on Jan 5, 2024": at(2024, 1, 5),
                     "05-Jan-2024": at(2024, 1, 5), "January 5, 2024": at(2024, 1, 5), "1/2/2024": at(2024, 1, 2), "31/02/2024": None}),
    (D.day_first, {"01/02/2024": at(2024, 2, 1), "12/31/2024": at(2024, 12, 31), "2024-3-4": at(2024, 3, 4)}),
    (lambda c: D.relative_or_written(c, NOW), {"Jan 5, 2024": at(2024, 1, 5), "05-01-2024": at(2024, 1, 5), "NA": None,
                                               "2 days ago": at(2024, 6, 13, 12)}),
    (lambda c: D.relative_units(c, NOW), {"Posted about 2 months ago": at(2024, 4, 16, 12), "3 hours ago": at(2024, 6, 15, 9),
                                          "1 year ago": at(2023, 6, 16, 12), "5 minutes ago": at(2024, 6, 15, 11, 55), "soon": None}),
    (lambda c: D.relative_units(c, NOW, whole_days=True), {"3 hours ago": dt.date(2024, 6, 15), "2 weeks ago": dt.date(2024, 6, 1)}),
    (lambda c: D.first_number_days(c, NOW), {"Posted 30+ Days Ago": dt.date(2024, 5, 16), "2 months ago": dt.date(2024, 6, 13),
                                             "Posted Today": None, "Yesterday": dt.date(2024, 6, 14)}),
    (D.iso_or_written, {"2024-01-05T10:11:12Z": dt.datetime(2024, 1, 5, 10, 11, 12), "2024-01-05T10:11:12+05:30": dt.datetime(2024, 1, 5, 4, 41, 12),
                        "2024-01-05": at(2024, 1, 5), "05/01/2024": at(2024, 1, 5), "13/14/2024": None, "2024": None}),
    (D.leading_date, {"2024-01-05T10:11": dt.date(2024, 1, 5), "bad": None, None: None}),
    (T.snake, {"  Acme Corp, Inc. ": "acme_corp_inc"}),
    (T.clean, {" a​ \n b c ": "a b c", None: "", "\x1c x": "x"}),
    (T.words, {None: 0, "": 0, " a  b\nc ": 3}),
    (T.clean_location, {"Bangalore (HQ) ..+ 3": "bangalore", "Sector-18B Noida": "noida", "100 MW Plant, Gujarat": "", "nan": "", None: ""}),
    (T.title_case, {"new-delhi": "New-Delhi", "they're BIG": "They'Re Big"}),
    (T.shorten_location, {"Bangalore, Karnataka, India": "Bangalore, Karnataka, India", "A; B": "A; B",
                          "Bangalore, Karnataka, Mumbai, Maharashtra, India": "Bangalore, Karnataka, India",
                          "Pune, Mumbai, India, India": "Pune, Mumbai, India", "": ""}),
    (T.sections, {"Responsibilities\n- Build\n- Lead (team)\nPerks\n- None": "ROLE\n- Build", "ROLE:\n- x": "", "- x\nROLE": "",
                  "role\n- a\n  requirements \r\n- b\nBENEFITS\n- c\nROLE\n- d": "ROLE\n- a\n- d\n\nREQUIREMENTS\n- b\n\nBENEFITS\n- c"}),
    (lambda c: T.slug(c, F.lit("Acme & Co."), F.lit(1)), {"Senior Engineer (Solar)": "senior-engineer-solar-at-acme-co-c4ca42", None: None}),
    (U.base, {" example.com/ ": "https://example.com", "http://a.b//": "http://a.b", " ": "", None: "", "host:8080": "host:8080"}),
    (lambda c: U.tracked(c, "T", "x.y"), {"https://a.b/c?x=1#f": "https://a.b/c?x=1&T#f", "https://a.b": "https://a.b?T", "/rel": "/rel",
                                          "https://x.y/p;q?z#f": "https://x.y/p", None: None}),
    (U.site_info, {"https://h/x/sites/CX_1/jobs": ("https://h", "CX_1"), "https://h/x": (None, None), "https://sites/a": (None, None)}),
    (R.is_green_title, {"ESG Analyst": True, "Wastewater Engineer": True, "Safety-Officer": True, "Windows Admin": False,
                        "Watershed Lead": False, "analyste écoesg": False, None: False}),
    (R.platform_of, {"https://acme.keka.com/careers": ("Keka", "https://acme.keka.com/careers/"),
                     "https://jobs.lever.co/acme?x=1": ("Lever", "https://jobs.lever.co/acme"),
                     "https://acme.zohorecruit.in/jobs": ("Zoho Recruit", "https://acme.zohorecruit.in/jobs/careers"),
                     "https://wd3.myworkdaysite.com/recruiting/acme/x": ("Workday", "https://acme.myworkdayjobs.com/en-US/Careers"),
                     "https://recruitcrm.io/apply/x": None, "https://x.com": None}),
    (lambda c: R.job_type(c, slashes=True), {"/ Full-time": "Full time", "Odd": "Odd", "": None}),
    (lambda c: R.job_type(c, underscores=True), {"FULL_TIME": "Full time", "other_x": "other_x"}),
    (lambda c: R.job_type(c, titled=True), {"Full time": "Full Time", "NA": None}),
    (R.employment_class, {"Internal transfer": "Internship", "Partner": "Contractor", "Permanent": "Full Time", None: "Full Time"}),
    (R.country_gate, {"IN": True, "in": True, None: True, "": True, "US": False}),
    (R.in_india, {"Bengaluru": True, "Indianapolis, IN": False, "Remote": True, "Remote - US": False, "Indiana": False, "Remote India": True, None: False,
                   "Kota Kinabalu, Malaysia": False, "Surat Thani, Thailand": False, "Agra, Kansas": False, "Goa, Philippines": False,
                   "Sector 62, Noida": True, "Delhi NCR": True, "Greater Hyderabad Area": True, "Kota": True}),
    (lambda c: R.first_match(c, V.GENERAL_DEPARTMENT_RULES, "x"), {"Senior QA Engineer": "Quality Assurance & Testing",
                                                                   "EV Charging Lead": "Electric Vehicles & Charging Infrastructure", "Poet": "x"}),
    (lambda c: closest_spelling(c, V.LONG_DEPARTMENTS), {"Enginering": "Engineering", "zzz": None, "Solar": "Solar"}),
    (T.urls_in, {'a "https://x.y/z?q" <b>http://k</b>': ["https://x.y/z?q", "http://k"]}),
]


@pytest.mark.parametrize("n", range(len(CASES)))
def test_golden(values, n):
    fn, cases = CASES[n]
    assert dict(zip(cases, values(fn, list(cases)))) == cases


def test_experience_label(spark):
    rows = spark.createDataFrame([(None, None, None), (0, 0, None), (0, 3, "0-3 years"), (3, None, "3+ years"), (5, 5, "5+ years"),
                                  (2, 4, "2-4 years")], "a int, b int, want string")
    assert all(r.want == r.got for r in rows.withColumn("got", N.experience_label("a", "b")).collect())


def test_careers_verdict_keeps_best_confidence_and_last_reason(spark):
    df = spark.createDataFrame([("https://x.com/jobs", 0, 10, 1, 1)], "url string, s int, n int, j int, p int")
    assert tuple(df.select(R.careers_verdict("url", "s", "n", "j", "p").alias("v")).first().v) == (0.9, "url-hint")


def test_fixed_lists():
    assert (len(V.TITLE_WORDS), len(V.GENERAL_DEPARTMENT_RULES), len(V.GREEN_DEPARTMENT_RULES), len(V.LONG_DEPARTMENT_RULES)) == (78, 30, 14, 15)
    assert (len(V.PLATFORM_RULES), len(V.PLATFORM_HOSTS), len(set(V.LONG_DEPARTMENTS)), len(U.path_guesses())) == (24, 19, 165, 15)


def test_addresses_resolve_as_in_the_standard_library(spark):
    hrefs = ["g", "./g", "g/", "/g", "//h/g", "?y", "g?y", "#s", "g#s", "", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g",
             "http://z/q", "mailto:x", "/a/./b/../c", "g;x=1", "a//b", "?", "#", "jobs/1", "x/../../y"]
    pairs = [(b, h) for b in ["https://a.b/c/d?x#f", "https://a.b", "https://a.b/", "http://a.b/c//d/"] for h in hrefs]
    rows = spark.createDataFrame(pairs, "b string, h string").select("b", "h", U.absolute("b", "h").alias("got")).collect()
    assert [(r.b, r.h, r.got) for r in rows if r.got != urljoin(r.b, r.h)] == []


def test_sections_match_a_line_by_line_reading(spark):
    import random
    rnd = random.Random(1)
    pool = ["ROLE", "role ", "- a", "-b (x)", " - c", "Perks", "- none", "QUALIFICATIONS", "text", "", "- d\r", "\x0b- e", "Benefits:", "- n/a"]
    texts = ["\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))) for _ in range(300)]

    def expected(text):
        found, now = {"ROLE": [], "REQUIREMENTS": [], "BENEFITS": []}, None
        for raw in text.splitlines():
            line = raw.strip()
            head = next((k for k, names in V.SECTION_HEADINGS.items() if line.upper() in names), None)
            if head:
                now = head
            elif now and line.startswith("-") and not any(p in line.lower() for p in V.PLACEHOLDERS):
                found[now].append(line)
        return "\n\n".join("\n".join([k, *v]) for k, v in found.items() if v) if found["ROLE"] else ""

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.sections("t").alias("got")).collect()
    assert [(r.t, r.got, expected(r.t)) for r in rows if r.got != expected(r.t)] == []
