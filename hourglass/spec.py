"""Column roles of a panel.

A panel is one row per (entity id, time step) with static and dynamic feature columns. All
operators take a frozen :class:`PanelSpec`, so the same code runs on any entity log.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class PanelSpec:
    id_col: str
    time_col: str
    target_col: str
    static: tuple[str, ...]
    dynamic: tuple[str, ...]
    binary: tuple[str, ...] = ()
    log: tuple[str, ...] = ()
    # feature -> (low, high); either bound may be None; bounds are inclusive
    ranges: dict = field(default_factory=dict, hash=False, compare=False)
    n_steps: int = 49
    sentinel: float | None = -1.0
    split_col: str = "split"
    train_split: str = "a"

    @property
    def features(self) -> list[str]:
        return list(self.static) + list(self.dynamic)

    @property
    def scaled(self) -> list[str]:
        """Features that a robust scaler transforms: everything but binaries."""
        return [c for c in self.features if c not in self.binary]

    def index_of(self, feature: str) -> int:
        return self.features.index(feature)

    def with_ranges(self, ranges: dict) -> "PanelSpec":
        return PanelSpec(**{**self.__dict__, "ranges": dict(ranges)})


CATALOG_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType(), False),
    T.StructField("idx", T.IntegerType(), False),
    T.StructField("role", T.StringType(), False),
    T.StructField("is_binary", T.BooleanType(), False),
    T.StructField("use_log1p", T.BooleanType(), False),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("ohe_column", T.StringType(), False),
])


def feature_catalog(spark: SparkSession, spec: PanelSpec) -> DataFrame:
    """One row per feature: index, role, binary/log flags, valid range and one-hot column name.

    Bounded by the number of features in the spec, so it is always safe to broadcast.
    """
    rows = []
    for i, f in enumerate(spec.features):
        low, high = spec.ranges.get(f, (None, None))
        rows.append((f, i, "static" if f in spec.static else "dynamic", f in spec.binary,
                     f in spec.log and f not in spec.binary,
                     None if low is None else float(low), None if high is None else float(high),
                     f"var_{f}"))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)
