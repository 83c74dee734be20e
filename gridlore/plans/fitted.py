"""Pipelines of steps, some of which are fitted."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from gridlore.operators.bayes import NaiveBayes
from gridlore.operators.stored import load_facts
from gridlore.operators.tagging import Tagger
from gridlore.plans.annotations import Step, text_features
from gridlore.sources.shared import materialize

Model = NaiveBayes | Tagger
_KINDS = {kind.KIND: kind for kind in (NaiveBayes, Tagger)}


def load_model(spark: SparkSession, path: str) -> Model:
    """The model saved at ``path``, of whatever kind."""
    kind = load_facts(spark, path)["kind"]
    if kind not in _KINDS:
        raise ValueError(f"the model at {path} is of the unknown kind {kind}")
    return _KINDS[kind].load(spark, path)


@dataclass(frozen=True)
class Fit:
    """A step that is trained: ``train(docs)`` gives a model, ``apply(docs, model)`` uses it.

    ``apply`` is also given rows that lack the label, so it should keep
    ``docs.columns``, whatever they are.
    """

    train: Callable[[DataFrame], Model]
    apply: Callable[[DataFrame, Model], DataFrame]


@dataclass(frozen=True)
class FittedPipeline:
    """Steps with the models of those that are fitted, in order."""

    steps: tuple[Step | Fit, ...]
    models: tuple[Model, ...]

    def transform(self, docs: DataFrame) -> DataFrame:
        """Apply all steps."""
        models = iter(self.models)
        ready = [
            partial(step.apply, model=next(models)) if isinstance(step, Fit) else step
            for step in self.steps
        ]
        return text_features(docs, ready)

    def save(self, path: str) -> None:
        """Write the models; functions can't be written."""
        for place, model in enumerate(self.models):
            model.save(f"{path}/{place}")


def fit_pipeline(docs: DataFrame, steps: Sequence[Step | Fit]) -> FittedPipeline:
    """Fit the steps in order, each on what those before it make of ``docs``.

    What a fitted step gives is written before the next one is trained on it, so
    that no model is applied twice. The last fitted step and those after it are
    not applied to ``docs``.
    """
    models: list[Model] = []
    wanted = sum(isinstance(step, Fit) for step in steps)
    for step in steps:
        if len(models) == wanted:
            break
        if not isinstance(step, Fit):
            docs = text_features(docs, [step])
            continue
        models.append(step.train(docs))
        if len(models) < wanted:
            docs = materialize(step.apply(docs, models[-1]), "fitted")
    return FittedPipeline(tuple(steps), tuple(models))


def load_pipeline(spark: SparkSession, path: str, steps: Sequence[Step | Fit]) -> FittedPipeline:
    """A pipeline saved at ``path``; ``steps`` are those it was fitted with."""
    wanted = sum(isinstance(step, Fit) for step in steps)
    models = tuple(load_model(spark, f"{path}/{place}") for place in range(wanted))
    return FittedPipeline(tuple(steps), models)
