"""Every operator as a query over the test tables, with SQL that must agree."""

from fieldtide.registry import (  # noqa: F401
    allocation_queries,
    cluster_queries,
    comment_queries,
    falloff_queries,
    plain_queries,
    series_queries,
    source_queries,
    text_queries,
)
from fieldtide.registry.core import ORACLES, QUERIES  # noqa: F401
