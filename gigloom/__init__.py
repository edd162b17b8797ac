"""gigloom: Spark operators that turn landed career pages and postings into publishable tables."""
