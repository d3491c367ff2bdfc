"""Batches whose run metadata are not understood yet, and what depends on them."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Flow cell to pore, sequencing kit to chemistry.
PORES = {
    "FLO-PRO002": "r9.4.1", "FLO-MIN114": "r10.4.1", "FLO-FLG114": "r10.4.1", "FLO-PRO114M": "r10.4.1",
}
CHEMISTRIES = {
    "SQK-LSK109": "e8", "SQK-LSK114": "e8.2", "SQK-RAD114": "e8.2", "SQK-ULK114": "e8.2",
    "SQK-RBK114.24": "e8.2", "SQK-NBD114.24": "e8.2", "SQK-RPB114.24": "e8.2",
}


# Basecalling models, their sampling frequency and the versions of the modified bases they can call.
MODELS = (
    ("dna_r10.4.1_e8.2_400bps_fast@v5.0.0", "5000", {}),
    ("dna_r10.4.1_e8.2_400bps_hac@v5.0.0", "5000", {"4mC_5mC": "3", "5mCG_5hmCG": "3", "5mC_5hmC": "3", "6mA": "3"}),
    ("dna_r10.4.1_e8.2_400bps_sup@v5.0.0", "5000", {"4mC_5mC": "3", "5mCG_5hmCG": "3", "5mC_5hmC": "3", "6mA": "3"}),
    ("dna_r10.4.1_e8.2_400bps_fast@v4.3.0", "5000", {}),
    ("dna_r10.4.1_e8.2_400bps_hac@v4.3.0", "5000", {"5mCG_5hmCG": "1", "5mC_5hmC": "1", "6mA": "2"}),
    ("dna_r10.4.1_e8.2_400bps_sup@v4.3.0", "5000", {"5mCG_5hmCG": "1", "5mC_5hmC": "1", "6mA": "2"}),
    ("dna_r10.4.1_e8.2_400bps_fast@v4.2.0", "5000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_hac@v4.2.0", "5000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_sup@v4.2.0", "5000", {"5mCG_5hmCG": "3.1", "5mC_5hmC": "1", "5mC": "2", "6mA": "3"}),
    ("dna_r10.4.1_e8.2_400bps_fast@v4.1.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_hac@v4.1.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_sup@v4.1.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_fast@v4.1.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_hac@v4.1.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_sup@v4.1.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_fast@v4.0.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_hac@v4.0.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_sup@v4.0.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_fast@v4.0.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_hac@v4.0.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_sup@v4.0.0", "4000", {"5mCG_5hmCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_fast@v3.5.2", "4000", {"5mCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_hac@v3.5.2", "4000", {"5mCG": "2"}),
    ("dna_r10.4.1_e8.2_260bps_sup@v3.5.2", "4000", {"5mCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_fast@v3.5.2", "4000", {"5mCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_hac@v3.5.2", "4000", {"5mCG": "2"}),
    ("dna_r10.4.1_e8.2_400bps_sup@v3.5.2", "4000", {"5mCG": "2"}),
    ("dna_r9.4.1_e8_sup@v3.6", "4000", {}),
    ("dna_r9.4.1_e8_fast@v3.4", "4000", {"5mCG_5hmCG": "0", "5mCG": "0.1"}),
    ("dna_r9.4.1_e8_hac@v3.3", "4000", {"5mCG_5hmCG": "0", "5mCG": "0.1"}),
    ("dna_r9.4.1_e8_sup@v3.3", "4000", {"5mCG_5hmCG": "0", "5mCG": "0.1"}),
)
_MODEL = r"^([a-z]+)_(r[0-9.]+)_(e[0-9.]+)(_([0-9]+)bps)?_([a-z]+)@v([0-9.]+)$"


def version_parts(text: Column) -> Column:
    """``4.10`` as the numbers 4 and 10, which compare as versions do; what is no version is null."""
    return F.when(text.rlike(r"^[0-9]+(\.[0-9]+)*$"), F.split(text, r"\.").cast("array<int>"))


def model_table(spark: SparkSession, models=MODELS) -> DataFrame:
    """One row for each model: what its name says, and its modified bases as a map."""
    rows = spark.createDataFrame(list(models), "model string, freq string, modifications map<string,string>")

    def part(number):
        return F.regexp_extract("model", _MODEL, number)

    return rows.select(
        "model", "freq", part(1).alias("molecule"), part(2).alias("pore"), part(3).alias("chemistry"), part(5).alias("speed"),
        part(6).alias("kind"), version_parts(part(7)).alias("version"), "modifications")


def by_modification(models: DataFrame) -> DataFrame:
    """One row for each model and modified base that it can call."""
    return models.select(*[c for c in models.columns if c != "modifications"],
                         F.explode("modifications").alias("modification", "modification_version"))


def newest_up_to(rows: DataFrame, dimension: DataFrame, keys, version: str, values) -> DataFrame:
    """Rows with the ``values`` of the newest dimension row of the same keys whose version is at or below their own.

    The dimension is folded to one row a key, its versions in order, so that a row meets one row, however many versions
    there are of a key; a row without a version, or older than all, gets nulls. Versions compare as arrays of numbers.
    """
    folded = dimension.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        F.col(version).alias("_at"), F.struct(*values).alias("_value")))).alias("_versions"))
    found = F.filter("_versions", lambda v: v["_at"] <= F.col(version))
    joined = rows.join(folded, list(keys), "left").withColumn("_found", F.try_element_at(found, F.lit(-1)))
    return joined.select(*rows.columns, *[F.col(f"_found._value.{v}").alias(v) for v in values])


def waiting(batches: DataFrame, runs: DataFrame, codes: DataFrame, needed: dict[str, str], hold_seconds: int | None, now: Column) -> DataFrame:
    """Batches with what keeps them waiting: ``unknowns`` (needed properties without a value), ``lacking`` (their kind and
    code, where the run has one), ``debounce`` (modified within the hold time).

    ``needed`` names the code column of ``runs`` for each property, which is the ``kind`` of its ``codes``.
    """
    found = batches.join(runs.select("batch", *needed.values()), "batch", "left")
    for kind, column in needed.items():
        own = codes.filter(F.col("kind") == kind).select(F.col("code").alias(column), F.col("value").alias(kind))
        found = found.join(own, column, "left")
    lacks = {k: F.col(k).isNull() for k in needed}
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col("modified").cast("timestamp"))
    unknowns = [F.when(lacks[k], F.lit(k)) for k in needed]
    lacking = [F.when(lacks[k] & F.col(c).isNotNull(), F.struct(F.lit(k).alias("kind"), F.col(c).alias("code"))) for k, c in needed.items()]
    return found.withColumns({
        "unknowns": F.array_compact(F.array(*unknowns).cast("array<string>")),
        "lacking": F.array_compact(F.array(*lacking).cast("array<struct<kind:string,code:string>>")),
        "debounce": F.lit(False) if hold_seconds is None else F.coalesce(age <= hold_seconds, F.lit(False))})


def lookup(rows: DataFrame, dimension: DataFrame, key: str, code: str, value: str, into: str) -> DataFrame:
    """A left lookup in a code table; an unknown code gives null. The codes must be unique."""
    codes = dimension.select(F.col(code).alias(key), F.col(value).alias(into))
    return rows.join(codes, key, "left")


def lookup_code(column, codes: dict[str, str]):
    """The same for a handful of fixed codes: a map literal, no join."""
    table = F.create_map(*[F.lit(part) for pair in codes.items() for part in pair])
    return F.try_element_at(table, column)


def curate_batches(batches: DataFrame, needed=("pore", "experiment_type")) -> DataFrame:
    """Batches lacking a needed property get status ``curation`` and the list of unknowns."""
    unknown = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in needed]))
    flagged = batches.withColumn("unknowns", unknown)
    return flagged.withColumn(
        "status", F.when(F.size("unknowns") > 0, "curation").otherwise("indexed"))


def curations(curated: DataFrame) -> DataFrame:
    return curated.filter("status = 'curation'")


def released(held: DataFrame, needed=("pore", "experiment_type")) -> DataFrame:
    """Held batches that reference data, looked up again, now explain completely."""
    return curate_batches(held, needed).filter("status = 'indexed'")


def clear_pairs(pairs: DataFrame, curated: DataFrame) -> DataFrame:
    """Membership without the batches under curation, so their files stay out of sample rollups."""
    return pairs.join(curations(curated).select("batch"), "batch", "left_anti")


def sample_readiness(pairs: DataFrame, curated: DataFrame) -> DataFrame:
    """Per sample: its batches, how many of them are held, and whether none is."""
    states = pairs.select("sample", "batch").join(
        curated.select("batch", (F.col("status") == "curation").alias("held")), "batch", "left")
    held = F.coalesce("held", F.lit(False))
    counted = states.groupBy("sample").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum(F.when(held, 1).otherwise(0)).alias("n_held"))
    ready = F.col("n_held") == 0
    return counted.withColumns({
        "ready": ready, "status": F.when(ready, "indexed").otherwise("curation")})


def run_groups(pairs: DataFrame, batches: DataFrame, by=("experiment_type", "pore")) -> DataFrame:
    """A sample's files and bytes per experiment type and pore."""
    joined = pairs.select("sample", "batch", "n_files", "size").join(batches.select("batch", *by), "batch")
    return joined.groupBy("sample", *by).agg(
        F.sum("n_files").alias("n_files"), F.sum("size").alias("size"))


def settling(batches: DataFrame, now, hold_seconds: int = 600) -> DataFrame:
    """Flag batches modified within the hold time; they wait before joining their samples."""
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col("modified").cast("timestamp"))
    return batches.withColumn("debounce", age <= hold_seconds)
