"""Batches that wait: their files count for no sample until their run is understood and they have come to rest.

Tables (keys): ``curations`` (batch), what is known of every batch that waits or has waited; ``codes`` (kind, code), the
reference codes that were looked up so far. Both are appended to by the pass that looks at a batch. A waiting batch is looked
at again when a code that it lacks appears or changes, when its run is described, or when it waits for rest; others are not.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.paths import first_token
from ..operators.curation import waiting
from ..session import written
from ..sources import tables

_S, _L = T.StringType(), T.LongType()
CODES = T.StructType([T.StructField(n, _S) for n in ("kind", "code", "value")])
LACKING = T.ArrayType(T.StructType([T.StructField("kind", _S), T.StructField("code", _S)]))
CURATIONS = T.StructType([T.StructField(n, t) for n, t in dict(
    batch=_S, held=T.BooleanType(), unknowns=T.ArrayType(_S), debounce=T.BooleanType(), lacking=LACKING, refs_version=_S,
    modified=T.TimestampType(), updated_at_DB=T.TimestampType()).items()])


@dataclass(frozen=True)
class Curation:
    """What passes judge batches by."""

    runs: DataFrame   # batch, and the code columns that ``needed`` names; a batch once
    codes: DataFrame  # kind, code, value; a code of a kind once
    version: str      # of the codes, kept with what was judged by them
    needed: dict[str, str] = field(default_factory=lambda: {"pore": "flow_cell", "experiment_type": "kit"})
    hold_seconds: int | None = 600  # fixed value: how long a batch rests before it counts; None: it need not


def by_batch(batch="batch") -> Column:
    return tables.bucket(first_token(batch))


def read_curations(spark: SparkSession, root: str, upto=None, buckets=None) -> DataFrame:
    """Every batch that waits or has waited, as last judged."""
    return tables.read_live(spark, root, "curations", CURATIONS, "batch", upto, buckets=buckets)


def read_held(spark: SparkSession, root: str, upto=None, buckets=None) -> DataFrame:
    return read_curations(spark, root, upto, buckets).filter("held")


def _again(held, fresh, runs):
    """Waiting batches that there is a reason to look at."""
    rest = held.filter("debounce").select("batch")
    known = held.select("batch", F.inline("lacking")).join(fresh, ["kind", "code"], "left_semi").select("batch")
    undescribed = held.filter(F.size("lacking") < F.size("unknowns")).select("batch").join(runs, "batch", "left_semi")
    return rest.union(known).union(undescribed)


def review(spark: SparkSession, root: str, version: int, changed: DataFrame, batches, curation: Curation, now: Column) -> DataFrame:
    """Judge the changed batches and those with a reason to be judged again; write what came of it.

    ``changed`` are batch names, ``batches`` a function from batch names and buckets to their present rows. Returns the
    batches that begin or end to wait in this pass.
    """
    before = version - 1
    known = tables.read_live(spark, root, "codes", CODES, ["kind", "code"], before)
    fresh = written(curation.codes.select("kind", "code", "value").join(known, ["kind", "code", "value"], "left_anti"), "codes")
    tables.append_rows(fresh, root, "codes", version)
    held = written(read_held(spark, root, before), "held")
    names = written(changed.select("batch").union(_again(held, fresh, curation.runs)).distinct(), "judged")
    present = batches(names, tables.buckets_of(names, at=by_batch())["at"]).select("batch", "modified", F.lit(True).alias("_there"))
    judged = waiting(names.join(present, "batch", "left"), curation.runs, curation.codes, curation.needed, curation.hold_seconds, now)
    judged = judged.join(held.select("batch", F.lit(True).alias("_was")), "batch", "left").withColumns({
        "held": F.col("_there").isNotNull() & ((F.size("unknowns") > 0) | F.col("debounce")),
        "_was": F.coalesce("_was", F.lit(False)), "refs_version": F.lit(curation.version), "updated_at_DB": now})
    rows = written(judged.filter(F.col("held") | F.col("_was")).select(*CURATIONS.fieldNames(), "_was"), "curations")
    tables.append_rows(rows.drop("_was"), root, "curations", version, by_batch())
    return rows.filter(F.col("held") != F.col("_was")).select("batch")
