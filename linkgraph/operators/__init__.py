"""DataFrame operators: every one is ``op(df, ...) -> DataFrame`` (use with ``df.transform``)."""

from linkgraph.operators import columns, filters, graph, metrics, nested, relational  # noqa: F401
from linkgraph.operators.graph import Graph  # noqa: F401
