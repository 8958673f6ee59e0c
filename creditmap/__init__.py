"""creditmap: territory attribution of third-party fund positions on Spark.

Public entry points:

* ``creditmap.plans.market_share.market_share(sources, config)``
* ``creditmap.plans.sales_assets.sales_assets(sources, config)``

and the operators they are built from (``creditmap.operators``,
``creditmap.functions``).  Sources are a ``creditmap.sources.Sources``
registry of DataFrames keyed by the logical table names.
"""

from .config import AttributionConfig, testdata_config  # noqa: F401
