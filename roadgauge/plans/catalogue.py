"""All registered queries. Importing the modules registers them."""

from roadgauge.plans import queries_history, queries_jobs, queries_records, queries_streams, queries_summaries  # noqa: F401
from roadgauge.plans.registry import CHECK_SQL, QUERIES  # noqa: F401
