"""The library's input tables, derived from a TPC-H-like data set.

Files, catalogs, tasks and jobs are not among the given tables, so each is a projection of one:
orders stand for files and tasks, line items for jobs, customers for samples, events for file events,
parts and pages for result listings. What differs between the listing and the previous catalog
follows from an order's date, priority and status.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

LINK_DIR = "/links"
NOW = "2002-01-01 00:00:00"
# Files that came after the catalog was last written.
CATALOG_TIME = "2001-01-01 00:00:00"
QUEUE_TIME = "2001-07-20 00:00:00"
POLL_TIME = "2001-07-26 00:00:00"
EXTENSIONS = {"F": "fast5", "O": "pod5", "P": "fastq.gz"}
QUEUES = {"SJF": 150, "LJF": 400}

RULES = {
    "polish_v0-3-1": {
        "name": "polish", "version": "v0.3.1", "sorting": "SJF", "timeout": "1-02:45",
        "conditions": [
            {"field": "kit.code", "type": "lt", "value": 20},
            {"field": "name", "type": "exists"},
        ],
        "command_template": "polish --in={{SAMPLE}} --threads={{ CORES }} > {{ OUT }}/{{ RUN_ID }}.log",
        "input_data": {
            "signal": [
                {"source": "sample", "file_mask": ["*.pod5"], "requirements": ["is_file", "size_lte 40000000"],
                 "condition": "preferred"},
                {"source": "sample", "file_mask": ["[0-4]*.fast?"], "requirements": ["not_empty"], "condition": "preferred"},
            ],
            "sequence": [{"source": "sample", "file_mask": ["*.f*q.gz"], "condition": "required",
                          "requirements": ["is_file", "size_gte 2500000", "realpath"]}],
        },
        "expected_output_data": {
            "tables": {"counts": "*[0-9].tsv", "sheet": "*_?.csv"},
            "plots": {"page": "[!x]*.svg"},
        },
    },
    "assemble_v5-0-0": {
        "name": "assemble", "version": "v5.0.0", "sorting": "LJF", "timeout": "07:20",
        "conditions": [
            {"field": "size", "type": "gt", "value": 250000},
            {"field": "kit.name", "type": "nin", "value": ["AUTOMOBILE", None]},
            {"field": "batches", "type": "in", "value": ["B3", "B9"]},
        ],
    },
    "survey_v2-2-2": {
        "name": "survey", "version": "v2.2.2", "sorting": "SJF", "timeout": "soon",
        "conditions": [
            {"field": "region", "type": "ne", "value": 2},
            {"field": "region", "type": "gte", "value": 1},
            {"field": "pore", "type": "exists", "value": False},
        ],
    },
}


_schemas = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the file once. The session's time zone is to be UTC."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def ts(text: str):
    return F.lit(text).cast("timestamp")


def _ext(status):
    return F.when(status == "F", "fast5").when(status == "O", "pod5").otherwise("fastq.gz")


def _source_path(custkey, orderkey, date, status, subdir):
    run = F.concat(F.date_format(date, "yyyyMMdd"), F.lit("_1200_P1_B"), orderkey % 40)
    return F.concat(F.lit("/src/S"), custkey, F.lit("/"), run, F.lit("/"), subdir, F.lit("/"),
                    orderkey, F.lit("."), _ext(status))


def _orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def _stat(date, size, key):
    return [
        size.alias("size"), (date - F.expr("INTERVAL 12 HOURS")).alias("ctime"), date.alias("mtime"),
        (key % 3).alias("dev"), key.alias("ino"), F.lit(1).cast("bigint").alias("nlink"),
    ]


def _bytes(price):
    return F.floor(price * 100).cast("bigint")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current listing: one file per order."""
    o = _orders(spark, sf_dir)
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    return o.select(
        _source_path(F.col("o_custkey"), key, date, F.col("o_orderstatus"), F.lit("raw")).alias("filepath"),
        *_stat(date, _bytes(F.col("o_totalprice")), key),
        F.lit(True).alias("is_file"), F.lit(False).alias("is_dir"),
        (F.col("o_orderpriority") == "4-NOT SPECIFIED").alias("is_symlink"),
        ts(NOW).alias("observed_at"),
    )


def previous_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing the catalog was made from, with ``state``: how the row now stands in the catalog.

    Files dated after the catalog are missing; some sizes and folders differ; some files no longer
    exist; older versions and deleted rows lie beside the live ones.
    """
    o = _orders(spark, sf_dir)
    key, date, status = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    resized = urgent & status.isin("F", "O")
    subdir = F.when((high & (status == "F")) | (urgent & (status == "O")), "old").otherwise("raw")
    size = _bytes(F.col("o_totalprice"))

    known = o.filter(date < ts(CATALOG_TIME)).select(
        _source_path(F.col("o_custkey"), key, date, status, subdir).alias("filepath"),
        *_stat(date, F.when(resized, size + 1).otherwise(size), key),
        F.when(high & (status == "O"), None).otherwise("indexed").alias("state"),
        ts(CATALOG_TIME).alias("observed_at"),
    )
    # Files that were removed since: a second copy of the low-priority pending ones.
    removed = o.filter((F.col("o_orderpriority") == "5-LOW") & (status == "P")).select(
        _source_path(F.col("o_custkey"), key + 1_000_000_000, date, status, F.lit("raw")).alias("filepath"),
        *_stat(date, size, key + 1_000_000_000),
        F.lit("indexed").alias("state"), ts(CATALOG_TIME).alias("observed_at"),
    )
    # History: a version each medium-priority file had before, and rows deleted long ago.
    older = o.filter((F.col("o_orderpriority") == "3-MEDIUM") & (date < ts(CATALOG_TIME))).select(
        _source_path(F.col("o_custkey"), key, date, status, F.lit("raw")).alias("filepath"),
        *_stat(date, size + 7, key),
        F.when(status == "F", "deleted").otherwise("deprecated").alias("state"),
        ts("2000-01-01 00:00:00").alias("observed_at"),
    )
    return known.unionByName(removed).unionByName(older)


def files_now(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    from .operators.diff import as_files
    return as_files(inventory(spark, sf_dir), LINK_DIR, keep)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole previous catalog, old versions included."""
    from .functions.fingerprints import file_fingerprint
    from .functions.paths import with_identity
    rows = with_identity(previous_inventory(spark, sf_dir), LINK_DIR)
    print_ = file_fingerprint(F.col("size"), F.col("dev"), F.col("ino"), F.col("mtime"))
    return rows.withColumns({"fingerprint": print_, "status": F.col("state")}).withColumnsRenamed(
        {"ctime": "created", "mtime": "modified"}).drop("state")


def catalog_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.diff import active_files
    return active_files(catalog(spark, sf_dir))


def file_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of every file seen so far, the listing being the newest."""
    columns = ["symlink", "filepath", "size", "modified", "fingerprint", "observed_at"]
    now = files_now(spark, sf_dir).withColumn("observed_at", ts(NOW))
    return catalog(spark, sf_dir).select(*columns).unionByName(now.select(*columns))


def repeated_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing in which paths repeat: one row per order line."""
    line = table(spark, sf_dir, "lineitem")
    path = F.concat(F.lit("/src/S"), F.col("l_suppkey"), F.lit("/20240101_1200_P1_B"), F.col("l_linenumber"),
                    F.lit("/raw/"), F.col("l_orderkey"), F.lit(".pod5"))
    return line.select(path.alias("filepath"), F.col("l_orderkey").alias("ino"),
                       F.col("l_linenumber").cast("bigint").alias("dev"))


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_files(table(spark, sf_dir, "events"))


def events_as_files(events: DataFrame) -> DataFrame:
    """File events out of user events, streaming or not: one file per user."""
    user = F.col("user_id")
    kind = (
        F.when(F.col("event_type") == "signup", "created").when(F.col("event_type") == "click", "moved")
        .when(F.col("event_type") == "error", "deleted").otherwise("modified")
    )
    folder = F.concat(F.lit("/src/S"), user % 10, F.lit("/20240101_1200_P1_B"), user % 4, F.lit("/"))
    name = F.concat(F.lit("U"), user, F.lit(".pod5"))
    return events.select(
        "event_id", kind.alias("event_type"),
        F.concat(folder, F.lit("raw/"), name).alias("src_path"),
        F.when(kind == "moved", F.concat(folder, F.lit("kept/"), name)).alias("dest_path"),
        F.col("ts").cast("timestamp").alias("ts"), F.floor(F.col("value") * 100).cast("bigint").alias("size"),
        user.alias("ino"),
    )


def report_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report files: one per supplier, of alternating kind, and the suppliers' batches in their names."""
    s = table(spark, sf_dir, "supplier")
    kind = F.when(F.col("s_acctbal") >= 5000, "final_summary").when(
        F.col("s_acctbal") >= 2000, "sequencing_summary").otherwise("notes")
    path = F.concat(F.lit("/src/reports/N"), F.col("s_nationkey"), F.lit("/"), kind, F.lit("_B"),
                    F.col("s_suppkey"), F.lit("_run.txt"))
    return s.select(path.alias("filepath"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per order; recent ones hold a slot, pending ones are prepared."""
    o = _orders(spark, sf_dir)
    status, date, priority = F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_orderpriority")
    state = (
        F.when(status == "F", "completed").when(status == "P", "prepared")
        .when(date >= ts(POLL_TIME), "queued").when(date >= ts(QUEUE_TIME), "processing").otherwise("failed")
    )
    sorting = F.when(priority.isin("1-URGENT", "2-HIGH"), "SJF").otherwise("LJF")
    timeout = (
        F.when(priority == "1-URGENT", "04:00").when(priority == "2-HIGH", "0-12:30")
        .when(priority == "3-MEDIUM", "1-00:00").when(priority == "5-LOW", "3-00:00").otherwise("unlimited")
    )
    rule = F.when(priority == "1-URGENT", "polish_v0-3-1").when(
        priority == "2-HIGH", "assemble_v5-0-0").otherwise("survey_v2-2-2")
    return o.select(
        F.concat(F.lit("T"), F.col("o_orderkey")).alias("task_id"),
        F.concat(F.lit("S"), F.col("o_custkey")).alias("sample_id"), rule.alias("pipeline_id"),
        state.alias("status"), sorting.alias("sorting"), timeout.alias("timeout"),
        _bytes(F.col("o_totalprice")).alias("input_files_size"), date.alias("created"),
        (date + F.expr("INTERVAL 90 MINUTES")).alias("queued"),
        F.when(state.isin("queued", "processing", "failed"), F.col("o_orderkey") + 100_000).alias("job_id"),
    )


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster's listing: head jobs of open orders, and a child per distinct line of any order."""
    o = _orders(spark, sf_dir)
    head = o.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") != "5-LOW"))
    recent = F.col("o_orderdate") >= ts(QUEUE_TIME)
    number = lambda c: F.struct(c.cast("bigint").alias("number"))
    heads = head.select(
        (F.col("o_orderkey") + 100_000).alias("job_id"),
        F.concat(F.lit("nxf_T"), F.col("o_orderkey")).alias("name"), F.lit(None).cast("string").alias("comment"),
        F.lit("n1,n2").alias("nodes"),
        F.when(recent, F.array(F.lit("PENDING"), F.lit("RUNNING"))).otherwise(F.array(F.lit("PENDING"))).alias("job_state"),
        F.lit("/dev/null").alias("standard_error"), F.lit("/log/out").alias("standard_output"),
        number(F.floor(F.col("o_totalprice"))).alias("priority"),
        number(F.unix_timestamp("o_orderdate")).alias("start_time"),
        number(F.unix_timestamp("o_orderdate") + 86_400).alias("end_time"),
    )
    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_returnflag").alias("flag"), F.min("l_shipdate").cast("timestamp").alias("shipped"))
    children = line.select(
        (1_000_000_000 + F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("job_id"),
        F.concat(F.lit("step_"), F.col("l_linenumber")).alias("name"),
        F.concat(F.lit("parent_job_id "), F.col("l_orderkey") + 100_000).alias("comment"),
        F.lit("n3").alias("nodes"),
        F.when(F.col("flag") == "A", F.array(F.lit("RUNNING"))).otherwise(F.array(F.lit("PENDING"))).alias("job_state"),
        F.lit("/log/err").alias("standard_error"), F.lit("/dev/null").alias("standard_output"),
        number(F.col("l_linenumber")).alias("priority"),
        number(F.unix_timestamp("shipped")).alias("start_time"), number(F.lit(0)).alias("end_time"),
    )
    none = F.lit(None)
    return heads.unionByName(children).withColumns({
        "array_job_id": number(none), "partition": F.lit("gpu"), "exit_code": number(none),
        "current_working_directory": F.concat(F.lit("/work/"), F.col("job_id")),
    })


def exit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exit codes of the jobs of low-priority open orders; every other one of them left a file."""
    o = _orders(spark, sf_dir).filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
    code = F.when(F.col("o_totalprice") < 150_000, 0).when(F.col("o_totalprice") < 250_000, 124).when(
        F.col("o_totalprice") < 350_000, 1)
    return o.select((F.col("o_orderkey") + 100_000).alias("job_id"), code.cast("int").alias("exit_code"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample document per customer."""
    c = table(spark, sf_dir, "customer")
    key, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    done = F.when(nation < 5, F.create_map(F.lit("polish_v0-3-1"), F.create_map(
        F.concat(F.lit("S"), key, F.lit("_polish_v0-3-1")), F.lit("completed"))))
    return c.select(
        F.concat(F.lit("S"), key).alias("sample_id"), F.col("c_name").alias("name"),
        F.when(segment == "FURNITURE", "deprecated").when(segment == "HOUSEHOLD", None)
        .otherwise("indexed").alias("status"),
        F.floor(F.col("c_acctbal") * 100).cast("bigint").alias("size"),
        F.struct(F.when(nation != 12, segment).alias("name"), nation.alias("code")).alias("kit"),
        F.array(F.concat(F.lit("B"), key % 40), F.concat(F.lit("B"), nation)).alias("batches"),
        (nation % 5).alias("region"), F.when(nation > 8, F.concat(F.lit("r"), nation)).alias("pore"),
        done.alias("tasks"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result documents exist for the customers that had an urgent order before the catalog."""
    o = _orders(spark, sf_dir).filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") < ts(CATALOG_TIME)))
    return o.groupBy(F.concat(F.lit("S"), F.col("o_custkey")).alias("sample_id")).agg(
        F.count(F.lit(1)).alias("n_results"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files: one per part, spread over fifty tasks by part size."""
    p = table(spark, sf_dir, "part")
    suffix = (
        F.when(F.col("p_type") == "ECONOMY", ".tsv").when(F.col("p_type") == "SMALL", "_a.csv")
        .when(F.col("p_type") == "LARGE", "_ab.csv").when(F.col("p_type") == "MEDIUM", ".svg").otherwise(".log")
    )
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_partkey"), suffix)
    return p.select(
        F.concat(F.lit("T"), F.col("p_size")).alias("task_id"),
        F.concat(F.lit("/res/T"), F.col("p_size"), F.lit("/out/"), name).alias("filepath"),
        F.when(F.col("p_brand") == "Brand#1", 0).otherwise(F.floor(F.col("p_retailprice"))).cast("bigint").alias("size"),
        (F.col("p_brand") != "Brand#2").alias("is_file"),
    )


def expected_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each task with result files should have written."""
    outputs = RULES["polish_v0-3-1"]["expected_output_data"]
    inner = {g: F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]) for g, kinds in outputs.items()}
    document = F.create_map(*[part for g, m in inner.items() for part in (F.lit(g), m)])
    p = table(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("T"), F.col("p_size")).alias("task_id")).distinct().withColumn(
        "expected_output_data", document)


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as files: the path part of each URL."""
    path = F.regexp_extract("url", r"^[a-z]+://([^?#]*)", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("/"), path).alias("filepath"), F.length("html").cast("bigint").alias("size"))


def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metadata per batch: a batch is run on a nation's machine; some regions are not described."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    pore = r.select(F.col("r_regionkey").alias("n_regionkey"),
                    F.when(F.col("r_name") != "ASIA", F.concat(F.lit("R"), F.col("r_regionkey"))).alias("pore"))
    kind = F.when(F.col("n_nationkey") != 7, F.when(F.col("n_nationkey") > 10, "rna").otherwise("dna"))
    return n.join(pore, "n_regionkey").select(
        F.concat(F.lit("B"), F.col("n_nationkey")).alias("batch"), "pore", kind.alias("experiment_type"))


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that lead from the previous catalog to the listing, and some that lead nowhere.

    Files dated after the catalog are created (or, if pending, reported as merely modified); moved ones
    move, then everything known is reported with its present stat fields; removed ones are deleted;
    so are files of failed orders the catalog never had.
    """
    o = _orders(spark, sf_dir)
    key, date, status = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    path = _source_path(F.col("o_custkey"), key, date, status, F.lit("raw"))
    before = _source_path(F.col("o_custkey"), key, date, status, F.lit("old"))
    stat = _stat(date, _bytes(F.col("o_totalprice")), key)
    none = [F.lit(None).cast(t).alias(n) for n, t in (
        ("size", "bigint"), ("ctime", "timestamp"), ("mtime", "timestamp"), ("dev", "bigint"), ("ino", "bigint"),
        ("nlink", "bigint"))]
    nowhere = F.lit(None).cast("string").alias("dest_path")
    new = date >= ts(CATALOG_TIME)

    def at(minutes):
        return (ts(NOW) + F.make_dt_interval(mins=F.lit(minutes))).alias("ts")

    moved = o.filter(~new & ((high & (status == "F")) | (urgent & (status == "O")))).select(
        F.lit("moved").alias("event_type"), before.alias("src_path"), path.alias("dest_path"), at(1), *none)
    seen = o.select(
        F.when(new & (status != "P"), "created").otherwise("modified").alias("event_type"), path.alias("src_path"),
        nowhere, at(2), *stat)
    gone = o.filter((F.col("o_orderpriority") == "5-LOW") & (status == "P")).select(
        F.lit("deleted").alias("event_type"),
        _source_path(F.col("o_custkey"), key + 1_000_000_000, date, status, F.lit("raw")).alias("src_path"),
        nowhere, at(3), *none)
    unknown = o.filter(high & (status == "P")).select(
        F.lit("deleted").alias("event_type"),
        _source_path(F.col("o_custkey"), key + 2_000_000_000, date, status, F.lit("raw")).alias("src_path"),
        nowhere, at(4), *none)
    rows = moved.unionByName(seen).unionByName(gone).unionByName(unknown)
    return rows.withColumn("is_dir", F.lit(False))


def rotated_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log for each customer that is made, moved aside and made anew within five seconds."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    folder = F.concat(F.lit("/src/S"), F.col("c_custkey"), F.lit("/20020101_1200_P1_B"), F.col("c_custkey") % 40, F.lit("/raw/log"))
    new, old = F.concat(folder, F.lit(".pod5")), F.concat(folder, F.lit("-1.pod5"))

    def event(kind, second, path, dest, size):
        when = ts(NOW) + F.make_dt_interval(mins=F.lit(5), secs=F.lit(second))
        present = None if size is None else F.col("c_custkey") + size
        return c.select(
            F.lit(kind).alias("event_type"), path.alias("src_path"), dest.cast("string").alias("dest_path"), when.alias("ts"),
            *[(F.lit(None) if present is None else v).cast(t).alias(n) for n, v, t in (
                ("size", present, "bigint"), ("ctime", when, "timestamp"), ("mtime", when, "timestamp"), ("dev", F.lit(1), "bigint"),
                ("ino", F.col("c_custkey"), "bigint"), ("nlink", F.lit(1), "bigint"))], F.lit(False).alias("is_dir"))

    return event("created", 0, new, F.lit(None), 10).unionByName(event("moved", 3, new, old, None)).unionByName(
        event("created", 5, new, F.lit(None), 20))


def report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file events again, on report files that may be moved aside."""
    e = file_events(spark, sf_dir)
    name = F.concat(F.lit("/final_summary_"), F.col("ino"), F.lit(".txt"))
    return e.select("event_type", F.concat(F.lit("/r/new"), name).alias("src_path"),
                    F.when(F.col("event_type") == "moved", F.concat(F.lit("/r/kept"), name)).alias("dest_path"), "ts")


def shallow_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing with a file for each part that lies too high in the tree to have a sample."""
    p = table(spark, sf_dir, "part")
    date = ts(CATALOG_TIME)
    shallow = p.select(
        F.concat(F.lit("/loose/"), F.col("p_partkey"), F.lit(".pod5")).alias("filepath"),
        *_stat(date, F.col("p_size").cast("bigint"), F.col("p_partkey")),
        F.lit(True).alias("is_file"), F.lit(False).alias("is_dir"), F.lit(False).alias("is_symlink"), ts(NOW).alias("observed_at"))
    return inventory(spark, sf_dir).unionByName(shallow)


def untimed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file events, every fifth without a time."""
    return file_events(spark, sf_dir).withColumn("ts", F.when(F.col("event_id") % 5 != 0, F.col("ts")))


def renaming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's file written under a temporary name and renamed twice, all in one batch.

    Files of urgent orders are renamed once more, to a name whose file is then lost; those of medium priority begin as
    files that the catalog has.
    """
    o = _orders(spark, sf_dir)
    key, date, status, priority = (F.col(c) for c in ("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"))
    known = (priority == "3-MEDIUM") & (date < ts(CATALOG_TIME))
    folder = F.concat(F.lit("/src/S"), F.col("o_custkey"), F.lit("/"), F.date_format(date, "yyyyMMdd"), F.lit("_1200_P1_B"),
                      key % 40, F.lit("/raw/"))
    stored = F.concat(folder, key, F.lit("."), _ext(status))
    names = [F.concat(folder, F.lit(p), key, F.lit(".pod5")) for p in ("part1-", "part2-", "done-", "lost-")]
    none = F.lit(None).cast("string")
    size = _bytes(F.col("o_totalprice"))
    at = [(ts(NOW) + F.make_dt_interval(mins=F.lit(m))) for m in range(6)]

    def event(kind, src, dest, when, with_stat=False):
        stat = _stat(date, size, key)
        kinds = ("bigint", "timestamp", "timestamp", "bigint", "bigint", "bigint")
        cells = stat if with_stat else [F.lit(None).cast(k).alias(n) for k, n in zip(kinds, ("size", "ctime", "mtime", "dev", "ino", "nlink"))]
        return [F.lit(kind).alias("event_type"), src.alias("src_path"), dest.alias("dest_path"), when.alias("ts"), *cells]

    parts = [
        o.filter(~known).select(*event("created", names[0], none, at[0], True)),
        o.filter(~known).select(*event("moved", names[0], names[1], at[1])),
        o.filter(known).select(*event("moved", stored, names[1], at[1])),
        o.select(*event("moved", names[1], names[2], at[2])),
        o.filter(priority == "1-URGENT").select(*event("moved", names[2], names[3], at[3])),
        o.filter(priority == "1-URGENT").select(*event("deleted", names[3], none, at[4])),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.withColumn("is_dir", F.lit(False))
