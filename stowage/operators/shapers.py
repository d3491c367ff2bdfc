"""User code per processing rule: shaping a task's input and its output.

An input shaper is a ``DataFrame -> DataFrame`` function over tasks that adds ``command``,
``n_groups``, ``input_files_size`` and ``n_expected``; an output shaper maps finished tasks to long
rows (task_id, group, type, value). Shapers are registered by the program; files are never imported.
"""

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from .work import validate

INPUT_CONTRACT = {
    "command": T.StringType, "n_groups": T.IntegralType, "input_files_size": T.IntegralType,
    "n_expected": T.IntegralType,
}
OUTPUT_CONTRACT = {
    "task_id": T.StringType, "group": T.StringType, "type": T.StringType, "value": T.StringType,
}


class ContractError(ValueError):
    """A shaper's result does not have the agreed columns."""


class Shapers:
    """The registered functions by ``pipeline_id``."""

    def __init__(self):
        self._functions: dict[str, tuple[Callable, Callable]] = {}

    def register(self, pipeline_id: str, shape_input: Callable, shape_output: Callable) -> None:
        for name, function in (("shape_input", shape_input), ("shape_output", shape_output)):
            if not callable(function):
                raise TypeError(f"{name} of {pipeline_id} is not callable")
        self._functions[pipeline_id] = (shape_input, shape_output)

    def __contains__(self, pipeline_id: str) -> bool:
        return pipeline_id in self._functions

    def get(self, pipeline_id: str) -> tuple[Callable, Callable]:
        if pipeline_id not in self._functions:
            raise KeyError(f"no shaper registered for {pipeline_id}")
        return self._functions[pipeline_id]

    def _per_rule(self, tasks, which, contract):
        parts = []
        for pipeline_id in sorted(self._functions):
            mine = tasks.filter(F.col("pipeline_id") == pipeline_id)
            parts.append(check_contract(self._functions[pipeline_id][which](mine), contract, pipeline_id))
        if not parts:
            raise KeyError("no shapers registered")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def shape_inputs(self, tasks: DataFrame) -> DataFrame:
        """Tasks of every registered rule, shaped and judged; a rule without a shaper is disprepared."""
        shaped = validate(self._per_rule(tasks, 0, INPUT_CONTRACT))
        orphans = self.unshaped(tasks).withColumns({"status": F.lit("disprepared"), "reasons": F.array("reason")}).drop("reason")
        return shaped.unionByName(orphans, allowMissingColumns=True)

    def unshaped(self, tasks: DataFrame) -> DataFrame:
        """Tasks that no registered rule shapes, those without a rule among them, with the ``reason``."""
        known = F.coalesce(F.col("pipeline_id").isin(*self._functions), F.lit(False))
        return tasks.filter(~known).withColumn("reason", F.lit("no shaper"))

    def shape_outputs(self, tasks: DataFrame) -> DataFrame:
        """Long rows of the outputs of tasks of registered rules; ``unshaped`` has the others."""
        return self._per_rule(tasks, 1, OUTPUT_CONTRACT).select(*OUTPUT_CONTRACT)


def check_contract(shaped, contract: dict, owner: str) -> DataFrame:
    """Fail early, before any job runs, when columns are missing or of another kind."""
    if not isinstance(shaped, DataFrame):
        raise ContractError(f"the shaper of {owner} must return a DataFrame")
    types = {f.name: f.dataType for f in shaped.schema.fields}
    wrong = [n for n, kind in contract.items() if not isinstance(types.get(n), kind)]
    if wrong:
        raise ContractError(f"the shaper of {owner} returned missing or mistyped columns: {wrong}")
    return shaped


def row_shaper(function: Callable, schema: str) -> Callable[[DataFrame], DataFrame]:
    """Lift a pandas function over batches of tasks to a shaper; batches stay where they are."""
    def shape(tasks: DataFrame) -> DataFrame:
        return tasks.mapInPandas(lambda frames: (function(frame) for frame in frames), schema)
    return shape
