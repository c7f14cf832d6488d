"""The registered queries over the test tables, and the SQL that checks them."""

from . import feed_queries, layout_queries, queries, stream_queries  # noqa: F401 - each registers its own
