"""Model graph, warehouse build, serving queries, dashboard frames, checks.

Typical use::

    from trackline.plans import lakehouse_from_ndjson, repository
    lh = lakehouse_from_ndjson(spark, landed_root)
    lh.build()
    repository.laps(lh.models, session_key, [1, 4], ordered=True)
"""

from trackline.plans import gold, metrics, quality, repository, silver, staging  # noqa: F401
from trackline.plans.materialize import Lakehouse, lakehouse_for, lakehouse_from_ndjson  # noqa: F401
from trackline.plans.models import Models  # noqa: F401
