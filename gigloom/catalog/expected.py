"""What each platform's runs are expected to write, by hand from the survey's precedence table; boards are checked against it."""

TEXTS = ("original_description", "location", "job_type", "department")

# stage two: columns written, how often `updated_at` is set, and whether a page without a description counts
ENRICHED = {
    "darwinbox": {"patched": (*TEXTS, "published_date", "min_exp", "max_exp"), "stamped": "changed", "needs_description": False},
    "freshteam": {"patched": (*TEXTS, "published_date"), "stamped": "changed", "needs_description": True},
    "keka": {"patched": ("original_description", "location", "job_type", "min_exp", "max_exp"), "stamped": "always", "needs_description": False},
    "lever": {"patched": TEXTS, "stamped": "always", "needs_description": True},
    "smartrecruiters": {"patched": TEXTS, "stamped": "changed", "needs_description": True},
    "workable": {"patched": TEXTS, "stamped": "changed", "needs_description": True},
    "zoho": {"patched": (*TEXTS, "title", "published_date", "min_exp", "max_exp", "industry"), "stamped": "changed", "needs_description": False},
}

# one pass: columns a listing gives, which side wins ("detail" where nothing is said), known postings again, and pages that failed
ONE_PASS = {
    "darwinbox": {"listed": ("location", "job_type", "department", "published_date"),
                  "wins": {"location": "listing", "job_type": "listing", "department": "listing", "published_date": "listing"},
                  "again": True, "failed": "FAILED_TO_LOAD", "skips_failed": False},
    "freshteam": {"listed": ("location", "job_type", "department", "published_date"), "wins": {}, "again": False, "failed": "FAILED_TO_LOAD",
                  "skips_failed": False},
    "keka": {"listed": ("location", "job_type", "published_date"),
             "wins": {"location": "listing", "job_type": "listing", "published_date": "listing_only"}, "again": False, "failed": None,
             "skips_failed": False},
    "lever": {"listed": ("location", "job_type", "department", "published_date"), "wins": {}, "again": False, "failed": "FAILED_TO_LOAD",
              "skips_failed": False},
    "smartrecruiters": {"listed": (), "wins": {"location": "detail_only", "job_type": "detail_only", "department": "detail_only"},
                        "again": False, "failed": "FAILED_TO_LOAD", "skips_failed": False},
    "workable": {"listed": ("location", "job_type", "department", "published_date"), "wins": {"published_date": "listing_only"},
                 "again": False, "failed": "FAILED_TO_LOAD", "skips_failed": False},
    "zoho": {"listed": ("location", "job_type", "published_date"), "wins": {}, "again": False, "failed": None, "skips_failed": False},
    "eightfold": {"listed": ("location", "published_date"), "wins": {"location": "listing_only", "job_type": "detail_only"}, "again": False,
                  "failed": "FAILED_TO_LOAD", "skips_failed": False},
    "workday": {"listed": (), "wins": {"location": "detail_only", "job_type": "detail_only", "published_date": "detail_only"}, "again": False,
                "failed": "FAILED_TO_LOAD", "skips_failed": True},
}

# labels that the published scorer gives the titles in use, whatever number follows them
WORDED = {"Solar Engineer": "Solar", "Data Analyst": "Data Science & Analytics", "HR Partner": "HR Business Advisory", "Wind Turbine Cook": "Wind Power"}

PATHS = ["/about/careers", "/career", "/careers", "/company/careers", "/en/careers", "/job", "/jobs", "/join", "/join-us", "/opening", "/openings",
         "/opportunities", "/vacancies", "/vacancy", "/work-with-us"]
