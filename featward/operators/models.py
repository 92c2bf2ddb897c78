"""Model parameters: plain data, read from JSON, never unpickled."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LogisticModel:
    """P = 1 / (1 + exp(-(intercept + weights . features)))."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float = 0.0

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features))
        object.__setattr__(self, "weights", tuple(float(w) for w in self.weights))
        if len(self.features) != len(self.weights):
            raise ValueError("one weight per feature is needed")


@dataclass(frozen=True)
class TreeEnsemble:
    """Boosted trees: the leaf values reached are summed onto ``base_margin``, then a sigmoid.

    A tree is a nested dict as boosted-tree libraries dump it to JSON. A split has ``nodeid``,
    ``split`` (feature), ``split_condition``, ``yes``, ``no``, ``missing`` (node ids) and
    ``children``; a leaf has ``nodeid`` and ``leaf``. ``x < split_condition`` goes to yes; NULL and
    NaN go to missing. ``single_precision`` compares as 32-bit floats, which is how trees trained
    on such floats split.
    """

    features: tuple[str, ...]
    trees: tuple[dict[str, Any], ...]
    base_margin: float = 0.0
    single_precision: bool = False

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features))
        object.__setattr__(self, "trees", tuple(self.trees))
        unknown = {n["split"] for n in self.nodes() if "leaf" not in n} - set(self.features)
        if unknown:
            raise ValueError(f"trees split on unknown features: {sorted(unknown)}")

    def nodes(self) -> Iterator[dict[str, Any]]:
        waiting = list(self.trees)
        while waiting:
            node = waiting.pop()
            yield node
            waiting.extend(node.get("children", ()))


@dataclass(frozen=True)
class MlClassifier:
    """A fitted ``pyspark.ml`` classifier and its features in training order."""

    features: tuple[str, ...]
    model: Any

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features))


_KINDS = {"logistic": LogisticModel, "trees": TreeEnsemble}

# A model is read by the driver and sent to every executor; a larger one is refused by default.
MAX_MODEL_BYTES = 256 * 1024 * 1024


def model_bytes(model: LogisticModel | TreeEnsemble | MlClassifier) -> int:
    """Size of a model: of its parameters as JSON, or of a fitted classifier in the JVM's memory."""
    if isinstance(model, MlClassifier):
        java = model.model._java_obj
        return SparkSession.active()._jvm.org.apache.spark.util.SizeEstimator.estimate(java)
    return len(json.dumps(asdict(model)))


def save_model(spark: SparkSession, model: LogisticModel | TreeEnsemble, path: str) -> None:
    """Write a model's parameters as one JSON text."""
    kind = next(k for k, cls in _KINDS.items() if isinstance(model, cls))
    text = json.dumps({"kind": kind, **asdict(model)})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _json_file(spark: SparkSession, path: str, max_model_bytes: int):
    sizes = spark.read.format("binaryFile").load(path).agg(F.sum("length"), F.count("*")).first()
    if sizes[1] != 1 or sizes[0] > max_model_bytes:
        raise ValueError(f"{path} is not one model file of at most {max_model_bytes} bytes")
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def load_model(
    spark: SparkSession, path: str, max_model_bytes: int = MAX_MODEL_BYTES
) -> LogisticModel | TreeEnsemble:
    """Read a model written by :func:`save_model`; an unreadable model is an error."""
    fields = _json_file(spark, path, max_model_bytes)
    return _KINDS[fields.pop("kind")](**fields)


def load_tree_dump(
    spark: SparkSession,
    path: str,
    features: Iterable[str],
    base_margin: float = 0.0,
    single_precision: bool = True,
    max_model_bytes: int = MAX_MODEL_BYTES,
) -> TreeEnsemble:
    """The JSON dump of a boosted-tree library: a list of trees, whose splits name a feature or give
    its number as ``f0``, ``f1``, …. ``features`` are the columns in training order. A dump holds
    neither them nor the base margin, which is the log-odds of the library's base score."""
    features = tuple(features)
    numbers = {f"f{i}": name for i, name in enumerate(features)}

    def renamed(node: dict[str, Any]) -> dict[str, Any]:
        if "leaf" in node:
            return node
        split = node["split"] if node["split"] in features else numbers.get(node["split"], node["split"])
        return {**node, "split": split, "children": [renamed(c) for c in node["children"]]}

    trees = _json_file(spark, path, max_model_bytes)
    if not isinstance(trees, list):
        raise ValueError(f"{path} is not a list of trees")
    return TreeEnsemble(features, tuple(renamed(t) for t in trees), base_margin, single_precision)
