"""All queries over the given tables, by operator ID."""

from docflow.plans import changelog, jobs, views
from docflow.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "changelog", "jobs", "views"]
