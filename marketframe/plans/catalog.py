"""The full query catalog: importing this module registers every query module.

``queries()`` and ``oracle_sql()`` in ``__spark_entry__.py`` are views of ``REGISTRY``.
"""

from marketframe.plans.registry import RANGE_FROM, RANGE_TO, REGISTRY, Query, register  # noqa: F401
from marketframe.plans import q_market, q_features, q_trading, q_ops, q_store  # noqa: E402,F401
