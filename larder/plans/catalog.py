"""All registered queries."""

from larder.plans import evaluating, ingest, profiles, retrieval, streams, texts  # noqa: F401
from larder.plans.registry import QUERIES, SQL  # noqa: F401
