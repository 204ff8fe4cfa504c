"""Registered queries and the SQL each is checked against."""

from barlake.queries.contents import CONTENT_QUERIES
from barlake.queries.features import FEATURE_QUERIES
from barlake.queries.jobs import JOB_QUERIES
from barlake.queries.manifests import MANIFEST_QUERIES
from barlake.queries.quality import QUALITY_QUERIES
from barlake.queries.scans import SCAN_QUERIES
from barlake.queries.stored import STORED_QUERIES
from barlake.queries.strategies import STRATEGY_QUERIES

# name -> (query, oracle SQL or None)
ALL = {
    **SCAN_QUERIES,
    **QUALITY_QUERIES,
    **MANIFEST_QUERIES,
    **FEATURE_QUERIES,
    **STRATEGY_QUERIES,
    **JOB_QUERIES,
    **STORED_QUERIES,
    **CONTENT_QUERIES,
}
