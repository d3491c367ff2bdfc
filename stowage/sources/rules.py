"""Processing rules: configuration given as dictionaries, used as a small table."""

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PIPELINES


def _text(value):
    return None if value is None else str(value)


def normalise_rules(configured: dict[str, dict]) -> list[dict]:
    """One entry per ``name_version`` id with every absent field at its default."""
    rules = []
    for pipeline_id, body in configured.items():
        rules.append({
            "pipeline_id": pipeline_id,
            "name": body.get("name", ""), "version": body.get("version", ""),
            "sorting": body.get("sorting", ""), "timeout": body.get("timeout", "00:00"),
            "conditions": [{k: c.get(k) for k in ("field", "type", "value")} for c in body.get("conditions", [])],
            "input_data": body.get("input_data", {}),
            "expected_output": body.get("expected_output_data", {}),
            "environment": body.get("environment_variables", {}),
            "command_template": body.get("command_template", ""),
        })
    return rules


def load_rules(spark: SparkSession, configured: dict[str, dict]) -> DataFrame:
    """The same as rows; its size is that of the configuration."""
    rows = []
    for r in normalise_rules(configured):
        sources = [
            (group, s.get("source"), s.get("attributes"), s.get("file_mask", []),
             s.get("requirements", []), s.get("condition"))
            for group, specs in r["input_data"].items() for s in specs]
        outputs = [(g, t, m) for g, kinds in r["expected_output"].items() for t, m in kinds.items()]
        conditions = [(c["field"], c["type"], _text(c["value"])) for c in r["conditions"]]
        rows.append((r["pipeline_id"], r["name"], r["version"], r["sorting"], r["timeout"], conditions,
                     sources, outputs, {k: _text(v) for k, v in r["environment"].items()}, r["command_template"]))
    return spark.createDataFrame(rows, PIPELINES)


def masks_of(rules: list[dict]) -> list[str]:
    """The distinct expected-output masks of the configuration."""
    return sorted({m for r in rules for kinds in r["expected_output"].values() for m in kinds.values()})
