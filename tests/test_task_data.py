"""A task's data document and the search for its outputs."""

import json

import pytest

from stowage.functions import documents
from stowage.operators import outputs
from stowage.schemas import TASK_DATA, TASK_DATA_DEFAULTS

# Every field filled, with values that tell the fields apart.
DOCUMENT = {
    field: {
        "input_data": {"signal": ["s3://b/one.pod5", "s3://b/two.pod5"], "empty": []},
        "expected_output_data": {"tables": {"counts": "*[0-9].tsv"}, "plots": {"page": "?.svg"}},
        "output_data": {"tables": {"counts": ["t/9.tsv"]}},
        "input_files_size": 77, "output_files_size": 5_000_000_000,
    }.get(field, f"<{field}>")
    for field in TASK_DATA.names
}


def read(spark, text):
    frame = spark.createDataFrame([(text,)], "doc string")
    return documents.from_documents(frame, "doc", TASK_DATA, TASK_DATA_DEFAULTS)


@pytest.mark.parametrize("text", ["{}", '{"not_a_field": [1]}'])
def test_absent_fields_have_their_defaults(spark, text):
    assert read(spark, text).first().asDict() == TASK_DATA_DEFAULTS


def test_every_field_is_read(spark):
    assert read(spark, json.dumps(DOCUMENT)).first().asDict() == DOCUMENT


@pytest.mark.parametrize("field", TASK_DATA.names)
def test_one_field_leaves_the_others_at_their_defaults(spark, field):
    row = read(spark, json.dumps({field: DOCUMENT[field]})).first().asDict()
    assert row == {**TASK_DATA_DEFAULTS, field: DOCUMENT[field]}


@pytest.mark.parametrize("document", [{}, DOCUMENT])
def test_written_document_reads_back_the_same(spark, document):
    rows = read(spark, json.dumps(document))
    again = documents.from_documents(documents.to_documents(rows, "doc"), "doc", TASK_DATA, TASK_DATA_DEFAULTS)
    assert again.first() == rows.first()


MASKS = {"tables": {"counts": "*[0-9].tsv", "dollar": "*.$"}, "plots": {"page": "[!x]?.svg"}}
LISTED = [
    ("deep", "/out/a/b/run7.tsv", 40, True), ("deep", "/out/run.tsv", 40, True), ("deep", "/out/q8.tsv", 2, True),
    ("deep", "/out/price.$", 3, True), ("deep", "/out/x1.svg", 4, True), ("deep", "/out/y1.svg", 5, True),
    ("deep", "/out/z1.svg", 0, True), ("deep", "/out/w1.svg", 6, False), ("other", "/out/v1.svg", 7, True),
]


@pytest.mark.parametrize("literal", [True, False])
def test_files_are_found_by_mask_kind_size_and_task(spark, literal):
    """Masks of the configuration and masks of the rows find the same: the last component, usable files, own task."""
    tasks = spark.createDataFrame([("deep", MASKS), ("none", MASKS)], "task_id string, expected_output_data map<string,map<string,string>>")
    expected = outputs.expected_rows(tasks)
    listing = spark.createDataFrame(LISTED, "task_id string, filepath string, size long, is_file boolean")
    masks = sorted({m for kinds in MASKS.values() for m in kinds.values()})
    found = outputs.match_outputs(expected, listing, masks if literal else None)
    assert sorted((r["type"], r["filepath"]) for r in found.collect()) == [
        ("counts", "/out/a/b/run7.tsv"), ("counts", "/out/q8.tsv"), ("dollar", "/out/price.$"), ("page", "/out/y1.svg")]
    totals = {(r["task_id"], r["type"]): (r["n_files"], r["size"]) for r in outputs.output_totals(expected, found).collect()}
    assert totals == {("deep", "counts"): (2, 42), ("deep", "dollar"): (1, 3), ("deep", "page"): (1, 5),
                      ("none", "counts"): (0, 0), ("none", "dollar"): (0, 0), ("none", "page"): (0, 0)}


def test_overlay_prefers_the_shaper(spark):
    kind = "task_id string, group string, type string, value string"
    found = spark.createDataFrame([("t", "plots", "a", "1"), ("t", "plots", "b", "2")], kind)
    shaped = spark.createDataFrame([("t", "plots", "b", None), ("t", "x", "c", "3")], kind)
    rows = {(r["group"], r["type"]): r["value"] for r in outputs.overlay(found, shaped).collect()}
    assert rows == {("plots", "a"): "1", ("plots", "b"): None, ("x", "c"): "3"}
