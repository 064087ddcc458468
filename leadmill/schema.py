"""Tables and settings of a campaign."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _table(**columns) -> StructType:
    return StructType([StructField(n, t, n != "compound_id") for n, t in columns.items()])


COMPOUNDS = _table(
    compound_id=LongType(), reghash=StringType(), smiles=StringType(), smilesid=StringType(), dock_score=DoubleType(), pred_score=DoubleType(),
    sim_fp=DoubleType(), sim_pharm=DoubleType(), query_cycle=IntegerType(), dock_iteration=IntegerType(), pred_version=IntegerType(), simsearch_cycle=IntegerType(),
)
CLUSTERS = _table(compound_id=LongType(), cluster_id=LongType())
STORED_CLUSTERS = _table(compound_id=LongType(), cluster_id=LongType(), sim=DoubleType(), percent=IntegerType())
MODELS = StructType([StructField("model_version", IntegerType()), StructField("path", StringType()), StructField("mean", DoubleType()), StructField("deviation", DoubleType())])
PROPERTIES = StructType([StructField("property", StringType()), StructField("low", DoubleType()), StructField("high", DoubleType())])
BLOBS = StructType([StructField("name", StringType()), StructField("content", BinaryType())])


@dataclass(frozen=True)
class Range:
    low: float
    high: float


@dataclass(frozen=True)
class PropertyLimits:
    """Inclusive ranges of the six descriptors, in the order in which they are tested."""

    mw: Range = Range(0, 500)
    slogp: Range = Range(-10, 5)
    hba: Range = Range(0, 10)
    hbd: Range = Range(0, 5)
    rotbonds: Range = Range(0, 10)
    tpsa: Range = Range(0, 140)

    def items(self) -> list[tuple[str, Range]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


@dataclass(frozen=True)
class Settings:
    """What a campaign may set; the defaults are the published ones, but for the surrogate. `acquisition` is greedy or clustering, `surrogate`
    linear or network, with `hidden` layers and `epochs`."""

    train_cutoff: float = 10.0
    min_similarity: tuple[tuple[str, float], ...] = (("fp", 0.5), ("pharm", 0.9))
    hits_per_query: int = 10_000
    queries_per_cycle: int = 1_000
    docked_per_round: int = 1_000_000
    dock_chunk: int = 1_000
    export_cutoff: float = -10.0
    seeds: int = 1_000_000
    cluster_similarity_percent: int = 30
    acquisition: str = "greedy"
    surrogate: str = "linear"
    hidden: tuple[int, ...] = (32,)
    epochs: int = 60
    limits: PropertyLimits = field(default_factory=PropertyLimits)
