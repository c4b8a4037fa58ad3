"""All registered queries."""

from rowtide.plans import feed, kv, messages, positions, rules, sinks, values  # noqa: F401


def queries():
    return dict(feed.QUERIES)


def oracles():
    return dict(feed.ORACLES)
