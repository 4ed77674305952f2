"""Column roles of a session table.

Operators never hard-code column names: they read them from a ``Contract``, so
the same code profiles or scores any table with numeric, categorical and target
columns.  ``SESSION`` is the default.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    numeric: tuple[str, ...]
    native_categorical: tuple[str, ...]
    coded_categorical: tuple[str, ...]
    target: str
    engineered: tuple[str, ...] = ()
    leakage: tuple[str, ...] = ()
    counts: tuple[str, ...] = ()
    rates: tuple[str, ...] = ()
    unit_scaled: tuple[str, ...] = ()
    visits: tuple[tuple[str, str], ...] = ()
    flags: tuple[str, ...] = ()
    calendar: str | None = None
    types: tuple[tuple[str, T.DataType], ...] = ()

    @property
    def categorical(self) -> tuple[str, ...]:
        return self.native_categorical + self.coded_categorical

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def columns(self) -> tuple[str, ...]:
        return self.features + (self.target,)

    @property
    def all_numeric(self) -> tuple[str, ...]:
        return self.numeric + self.engineered

    @property
    def text(self) -> tuple[str, ...]:
        return tuple(c for c in self.native_categorical if c not in self.flags)

    @property
    def schema(self) -> T.StructType:
        known = dict(self.types)
        return T.StructType([T.StructField(c, known[c]) for c in self.columns])

    def without(self, *names: str) -> "Contract":
        """The same contract minus some model inputs."""
        unknown = set(names) - set(self.features) - set(self.engineered)
        if unknown:
            raise ValueError(f"not features of this contract: {sorted(unknown)}")

        def keep(cols: tuple[str, ...]) -> tuple[str, ...]:
            return tuple(c for c in cols if c not in names)

        return replace(
            self,
            numeric=keep(self.numeric),
            native_categorical=keep(self.native_categorical),
            coded_categorical=keep(self.coded_categorical),
            engineered=keep(self.engineered),
        )


# Session columns, roles and labels.
SESSION = Contract(
    numeric=(
        "Administrative", "Administrative_Duration",
        "Informational", "Informational_Duration",
        "ProductRelated", "ProductRelated_Duration",
        "BounceRates", "ExitRates", "PageValues", "SpecialDay",
    ),
    native_categorical=("Month", "VisitorType", "Weekend"),
    coded_categorical=("OperatingSystems", "Browser", "Region", "TrafficType"),
    target="Revenue",
    engineered=(
        "TotalPages", "TotalDuration", "AvgDurationPerPage",
        "ProductPageRatio", "BounceExitDelta",
    ),
    leakage=("PageValues",),
    counts=("Administrative", "Informational", "ProductRelated"),
    rates=("BounceRates", "ExitRates"),
    unit_scaled=("BounceRates", "ExitRates", "SpecialDay"),
    visits=(
        ("Administrative", "Administrative_Duration"),
        ("Informational", "Informational_Duration"),
        ("ProductRelated", "ProductRelated_Duration"),
    ),
    flags=("Weekend",),
    calendar="Month",
    types=(
        ("Administrative", T.LongType()), ("Administrative_Duration", T.DoubleType()),
        ("Informational", T.LongType()), ("Informational_Duration", T.DoubleType()),
        ("ProductRelated", T.LongType()), ("ProductRelated_Duration", T.DoubleType()),
        ("BounceRates", T.DoubleType()), ("ExitRates", T.DoubleType()),
        ("PageValues", T.DoubleType()), ("SpecialDay", T.DoubleType()),
        ("Month", T.StringType()), ("VisitorType", T.StringType()),
        ("Weekend", T.BooleanType()),
        ("OperatingSystems", T.IntegerType()), ("Browser", T.IntegerType()),
        ("Region", T.IntegerType()), ("TrafficType", T.IntegerType()),
        ("Revenue", T.BooleanType()),
    ),
)
CALENDAR = (
    "Jan", "Feb", "Mar", "Apr", "May", "June",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)
POSITIVE_LABEL = "Purchase"
NEGATIVE_LABEL = "No purchase"

# Split, search and cost-model defaults.
SEED = 42
TEST_SHARE = 0.20
FOLDS = 5
SEARCH_DRAWS = 30
DEFAULT_THRESHOLD = 0.50
INCENTIVE_COST = 5.0
ORDER_VALUE = 120.0
UPLIFT = 0.10
