"""hourglass: sparse entity time series → causal panels, features and metrics on Spark.

Every operator is a DataFrame → DataFrame function driven by one :class:`PanelSpec`.
"""

from hourglass.spec import PanelSpec, feature_catalog

__all__ = ["PanelSpec", "feature_catalog"]
