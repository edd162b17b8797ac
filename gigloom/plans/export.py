"""Final export of all postings with their platform."""

from pyspark.sql import DataFrame

from gigloom.sources.tables import export_csv, export_rows


def backup(jobs: DataFrame, scrapes: DataFrame, ats_website: DataFrame, path: str, ats: str | None = None) -> None:
    """One run for one platform, or for all of them with a folder each."""
    export_csv(export_rows(jobs, scrapes, ats_website, ats), path, by=None if ats else "ats_name")
