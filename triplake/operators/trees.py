"""Fitted tree ensembles as SQL, for engines that cannot load a Spark model."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    GBTRegressionModel,
    RandomForestRegressionModel,
)

_CONDITION = re.compile(r"(?:If|Else) \(feature (\d+) (<=|>|in|not in) (\{.*\}|\S+)\)")


def _number(text: str | float) -> str:
    """A literal that is a double everywhere; digits alone would be a decimal."""
    text = str(text)
    return text if "e" in text.lower() else f"{text}E0"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _category_test(column: str, labels: list[str], chosen: set[int]) -> str:
    """Is a category's index among the chosen ones? The index behind the last label
    stands for NULL and for categories that were not seen."""
    if len(labels) in chosen:
        others = [_quoted(x) for i, x in enumerate(labels) if i not in chosen]
        return f"coalesce({column} NOT IN ({', '.join(others)}), TRUE)" if others else "TRUE"
    named = [_quoted(x) for i, x in enumerate(labels) if i in chosen]
    return f"coalesce({column} IN ({', '.join(named)}), FALSE)" if named else "FALSE"


def _index_value(column: str, labels: list[str]) -> str:
    whens = " ".join(f"WHEN {_quoted(x)} THEN {_number(float(i))}" for i, x in enumerate(labels))
    return f"CASE {column} {whens} ELSE {_number(float(len(labels)))} END"


def _tree_sql(lines: Iterator[str], test: Callable[[str], str]) -> str:
    """A tree's printed form, a line for each branch and leaf, as nested conditions."""
    line = next(lines).strip()
    if line.startswith("Predict:"):
        return _number(line.removeprefix("Predict:").strip())
    condition = test(line)
    left = _tree_sql(lines, test)
    next(lines)  # the same condition, denied
    return f"CASE WHEN {condition} THEN {left} ELSE {_tree_sql(lines, test)} END"


def ensemble_sql(model: PipelineModel) -> str:
    """A pipeline of optional category indexes, an assembler and trees as one SQL
    expression over the columns that go in.

    It uses CASE, IN and arithmetic of doubles alone. Where a number that goes in
    is NULL the result is NULL; the pipeline itself stops there.
    """
    *before, trees = model.stages
    categories: dict[str, tuple[str, list[str]]] = {}
    inputs: list[str] | None = None
    for stage in before:
        if isinstance(stage, StringIndexerModel):
            if stage.getHandleInvalid() != "keep":
                raise ValueError("only indexers that keep unseen categories have an SQL form")
            columns = zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray)
            categories |= {out: (name, list(labels)) for name, out, labels in columns}
        elif isinstance(stage, VectorAssembler):
            inputs = stage.getInputCols()
        else:
            raise ValueError(f"no SQL form of {type(stage).__name__}")
    if inputs is None:
        raise ValueError("the pipeline has no assembler")
    if isinstance(trees, DecisionTreeRegressionModel):
        members, weights, share = [trees], [1.0], 1
    elif isinstance(trees, RandomForestRegressionModel):
        members, weights, share = trees.trees, trees.treeWeights, len(trees.trees)
    elif isinstance(trees, GBTRegressionModel):
        members, weights, share = trees.trees, trees.treeWeights, 1
    else:
        raise ValueError(f"no SQL form of {type(trees).__name__}")

    def test(line: str) -> str:
        feature, relation, value = _CONDITION.fullmatch(line).groups()
        name = inputs[int(feature)]
        if relation in ("in", "not in"):
            chosen = {int(float(x)) for x in value.strip("{}").split(",") if x}
            column, labels = categories[name]
            found = _category_test(column, labels, chosen)
            return found if relation == "in" else f"NOT {found}"
        number = _index_value(*categories[name]) if name in categories else f"CAST({name} AS DOUBLE)"
        return f"{number} {relation} {_number(value)}"

    terms = []
    for tree, weight in zip(members, weights):
        # The first line only names the tree.
        lines = [x for x in tree.toDebugString.splitlines() if x.strip()][1:]
        terms.append(f"{_number(float(weight))} * ({_tree_sql(iter(lines), test)})")
    total = f"({' + '.join(terms)}) / {_number(float(share))}"
    missing = " OR ".join(f"{c} IS NULL" for c in inputs if c not in categories)
    return f"CASE WHEN {missing} THEN NULL ELSE {total} END" if missing else total
