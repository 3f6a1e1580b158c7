"""Runnable queries over the given tables."""


def all_queries():
    """All registered queries by name."""
    from ratingmill.plans import base
    from ratingmill.plans import preparation, profiles, recommend  # noqa: F401

    return base.QUERIES
