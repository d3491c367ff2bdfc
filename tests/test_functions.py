"""Column functions on small literal inputs."""

import fnmatch
from datetime import datetime, timezone
from hashlib import blake2s, sha256

import pytest
from pyspark.sql import functions as F, types as T

from stowage.functions import documents, durations, fingerprints, paths, predicates, states, templates
from stowage.schemas import TASK_DATA


def column(spark, values, build, dtype="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in frame.orderBy("i").select(build(F.col("v"))).collect()]


def test_path_parts(spark):
    given = ["/a/S1/20240101_1200_P1_B_7/raw/x.1.fastq.gz", "/S1/r_1_2/raw/.fast5", "/run/raw/x.pod5", "/x.FAST5"]
    assert column(spark, given, paths.sample_name) == ["S1", "S1", "", ""]
    assert column(spark, given, paths.batch_name) == ["B_7", "", "", ""]
    assert column(spark, given, lambda c: paths.extension(paths.file_name(c))) == ["fastq", None, "pod5", None]
    assert column(spark, given, lambda c: paths.basename(paths.file_name(c))) == ["x", "", "x", "x"]
    assert column(spark, given, lambda c: paths.link_folder(paths.file_name(c))) == [
        "fastq", "unknown_extension", "pod5", "unknown_extension"]
    assert column(spark, given, paths.directory)[0] == "/a/S1/20240101_1200_P1_B_7/raw"


def test_first_source_suffix_wins(spark):
    assert column(spark, ["a.fq.fast5", "a.tar.pod5.gz", "a.fastqx"], paths.extension) == ["fq", "pod5", None]


def test_clean_path(spark):
    given = ["file:/a//b", "file:///a/b", "hdfs://host:1/a/b", "/a///b/"]
    assert column(spark, given, paths.clean_path) == ["/a/b", "/a/b", "/a/b", "/a/b/"]


def test_report_type(spark):
    given = ["x_final_summary_B1.txt", "sequencing_summary.txt", "final_summary.csv", "notes.txt"]
    assert column(spark, given, paths.report_type) == ["final_summary", "sequencing_summary", None, None]


def test_identity_of_rows(spark):
    row = paths.with_identity(
        spark.createDataFrame([("/a/S1/1_2_3_B/raw/x.pod5",)], "filepath string"), "/links/").first()
    assert row["symlink"] == "/links/pod5/B:S1:x.pod5"
    assert row["name"] == "B:S1:x.pod5" and row["symlink_dir"] == "/links/pod5"


def test_timeouts(spark):
    given = ["3-00:00", "04:05", "1-2:3", "", "x", "1:2:3", "1-2-3:4", "-1:00", None, "1234567:00", "9999999-0:1", "0" * 40 + "5:1",
             "9" * 25 + ":0", "9" * 60 + "-1:1"]
    most = (1 << 63) - 1
    assert column(spark, given, durations.timeout_minutes) == [
        4320, 245, 1563, 0, 0, 0, 0, 0, 0, 1234567 * 60, 9999999 * 1440 + 1, 301, most, most]


def test_hms(spark):
    given = [0.0, 0.9, 1.0, 59.99, 3600.0, 360000.0, -5.0, None]
    assert column(spark, given, durations.hms, "double") == [
        "00:00:00", "00:00:00", "00:00:01", "00:00:59", "01:00:00", "100:00:00", "00:00:00", "00:00:00"]


def test_ratio_without_timeout_is_null(spark):
    row = spark.range(1).select(
        durations.priority_ratio(F.lit(10), F.lit("bad")).alias("a"),
        durations.priority_ratio(F.lit(10), F.lit("00:05")).alias("b")).first()
    assert row["a"] is None and row["b"] == 2.0


def test_submitted_job_id(spark):
    given = ["Submitted batch job 42", "x\n  Submitted batch job 7  \ny", "Submitted batch job 7 on c",
             "Submitted batch job\n7", "Submitted batch job x", "", None]
    assert column(spark, given, states.submitted_job_id) == [42, 7, 0, 0, 0, 0, 0]


def test_parent_job_id(spark):
    assert column(spark, ["parent_job_id 12", "", None, "12", "parent"], states.parent_job_id) == [12, 0, 0, 12, 0]


def test_exit_states(spark):
    assert column(spark, [0, 124, 1, None], states.exit_status, "int") == ["COMPLETED", "TIMEOUT", "FAILED", "UNKNOWN"]


@pytest.mark.parametrize("mask", ["*.html", "a?c", "*_x.*", "[ab]*", "[!ab]*", "x[", "a.b", "a+b(1).txt", "*", "[]]x", "[!]]x", "[^a]*", "[a-c]?", "[!a", "*$", "a[b", "[&&]", "[a&&b]*"])
def test_masks_are_globs(spark, mask):
    names = ["^x", "$", "c$", "&", "a[b", "[!a", "a.html", "abc", "a_x.txt", "b", "zz", "x[", "a.b", "axb", "a+b(1).txt", "]x", ".hidden", "A.HTML"]
    expected = [fnmatch.fnmatchcase(n, mask) for n in names]
    assert column(spark, names, lambda c: predicates.matches_mask(c, mask)) == expected
    assert column(spark, names, lambda c: predicates.matches_mask_column(c, F.lit(mask))) == expected


def test_conditions_follow_document_semantics(spark):
    frame = spark.createDataFrame(
        [("a", ["x", "y"], {"k": "1"}), (None, [], None)], "s string, l array<string>, m map<string,string>")

    def matches(*condition):
        test = predicates.compile_condition(*condition, schema=frame.schema)
        return [r[0] for r in frame.select(test).collect()]

    assert matches("s", "eq", "a") == [True, False]
    assert matches("s", "ne", "a") == [False, True]
    assert matches("s", "ne", ["a", "b"]) == [False, True]
    assert matches("s", "nin", [None]) == [True, False]
    assert matches("l", "eq", "y") == [True, False]
    assert matches("l", "ne", "y") == [False, True]
    assert matches("m.k", "exists", True) == [True, False]
    assert matches("m.k", "exists", False) == [False, True]
    assert matches("s", "gte", "a") == [True, False]
    with pytest.raises(ValueError):
        matches("s", "near", 1)


def test_two_conditions_on_one_field_both_apply(spark):
    frame = spark.createDataFrame([(i,) for i in range(5)], "n int")
    rules = [{"field": "n", "type": "gt", "value": 1}, {"field": "n", "type": "lt", "value": 4}]
    assert frame.filter(predicates.compile_conditions(rules, frame.schema)).count() == 2


def test_unknown_requirement(spark):
    with pytest.raises(ValueError):
        predicates.compile_requirements(["readable"])


def test_event_patterns_ignore_case(spark):
    given = ["/A/B.POD5", "/a/b.pod5.tmp", "/a/c.fast5"]
    assert column(spark, given, lambda c: predicates.matches_event_patterns(c, ["*.pod5", "*.fast5"])) == [True, False, True]
    assert column(spark, ["/a/x$", "/a/x", "/b/a/x$"], lambda c: predicates.matches_event_patterns(c, ["a/*$"])) == [True, False, True]


def test_template_fills_once_and_keeps_unknown(spark):
    text = "run {{ A }} {{B}} {{ C }} {{A}}"
    build = templates.render(text, {"A": F.lit("{{B}}$1\\"), "B": F.lit(None).cast("string")})
    assert spark.range(1).select(build).first()[0] == "run {{B}}$1\\  {{ C }} {{B}}$1\\"


def test_file_fingerprints(spark):
    at = datetime(2024, 5, 1, 12, 0, 0, 250000, tzinfo=timezone.utc)
    frame = spark.createDataFrame([(10, 2, 3, at)], "size long, dev long, ino long, mtime timestamp")
    cells = [F.col(c) for c in frame.columns]
    row = frame.select(fingerprints.file_fingerprint(*cells).alias("a"),
                       fingerprints.file_fingerprint_blake2s()(*cells).alias("b")).first()
    micros = int(at.timestamp() * 1_000_000)
    assert row["a"] == sha256(f"10|2|3|{micros}|".encode()).hexdigest()
    assert row["b"] == blake2s(f"10|2|3|{at.timestamp()}|".encode()).hexdigest()


def test_set_fingerprint_ignores_order_but_not_members(spark):
    def of(prints, partitions):
        frame = spark.createDataFrame([(p,) for p in prints], "fp string").repartition(partitions)
        words = frame.agg(F.count(F.lit(1)).alias("n"), *fingerprints.sum_words(F.col("fp")))
        return words.select(fingerprints.set_fingerprint(F.col("n"))).first()[0]

    members = [sha256(str(i).encode()).hexdigest() for i in range(50)]
    same = of(members, 1)
    assert of(members[::-1], 7) == same
    assert of(members[:-1], 3) != same
    assert of(members + members[:1], 3) != same


def test_map_edits(spark):
    frame = spark.createDataFrame([({"a": "1"},), (None,)], "m map<string,string>")
    put = documents.put_key(F.col("m"), F.lit("a"), F.lit("2"))
    assert [r[0] for r in frame.select(put).collect()] == [{"a": "2"}, {"a": "2"}]
    dropped = documents.drop_key(F.col("m"), F.lit("a"))
    assert [r[0] for r in frame.select(dropped).collect()] == [{}, None]


def test_overlay_maps(spark):
    kind = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))
    frame = spark.createDataFrame(
        [({"q": {"a": "1", "b": "2"}, "d": {"x": "0"}}, {"q": {"b": "9", "c": "3"}, "n": {"y": "5"}})],
        T.StructType([T.StructField("o", kind), T.StructField("n", kind)]))
    assert frame.select(documents.overlay_maps(F.col("o"), F.col("n"))).first()[0] == {
        "q": {"a": "1", "b": "9", "c": "3"}, "d": {"x": "0"}, "n": {"y": "5"}}


def test_documents_are_canonical_and_public(spark):
    frame = spark.createDataFrame([(["b", "a", "b"], "x")], "tags array<string>, _secret string")
    assert documents.to_documents(frame).first()[0] == '{"tags":["a","b"]}'


def test_declared_document_schema_reads_nested_values(spark):
    text = '{"input_data": {"fast5": ["/b", "/a"]}, "input_files_size": 5}'
    row = documents.from_documents(spark.createDataFrame([(text,)], "t string"), "t", TASK_DATA).first()
    assert row["input_data"] == {"fast5": ["/b", "/a"]} and row["work_dir"] is None
