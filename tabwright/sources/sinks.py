"""Sinks: validated predictions and stored models."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scalar import target_pair
from tabwright.models.front import Design, predict, predict_wide
from tabwright.operators import learned as L
from tabwright.operators import shape as S


def checked(df: DataFrame, pred: str) -> DataFrame:
    """Fails the job on a missing, NaN or non-positive prediction.

    The test is part of the projection, so writing validates without reading the rows twice, and a
    failed write is never committed.
    """
    p = F.col(pred)
    bad = p.isNull() | F.isnan(p) | (p <= 0)
    error = F.raise_error(F.concat(F.lit(f"{pred} must be a positive number, got "), F.coalesce(p.cast("string"), F.lit("null"))))
    return df.withColumn(pred, F.when(bad, error.cast("double")).otherwise(p))


def write_predictions(df: DataFrame, folder: str, name: str, transform: str, key: str = "row_id", pred: str = "pred",
                      fmt: str = "csv") -> str:
    """Writes `{folder}/{name}_results_{transform}` as CSV part files with a header (or Parquet)."""
    path = f"{folder}/{name}_results_{transform}"
    writer = checked(df.select(key, pred), pred).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


class LinearScorer:
    """A fitted linear model as tables: the design and one coefficient row per fit."""

    def __init__(self, design: Design, coefs: DataFrame, transform: str, final_fit: int) -> None:
        self.design, self.coefs, self.transform, self.final_fit = design, coefs, transform, final_fit

    def save(self, path: str) -> None:
        d = self.design
        spec = {"continuous": d.continuous, "categorical": d.categorical, "ordinal": d.ordinal, "levels": d.levels,
                "group_of": d.group_of, "transform": self.transform, "final_fit": self.final_fit}
        spark = self.coefs.sparkSession
        spark.createDataFrame([(json.dumps(spec),)], "spec string").write.mode("overwrite").parquet(f"{path}/design")
        self.coefs.write.mode("overwrite").parquet(f"{path}/coefficients")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearScorer:
        spec = json.loads(spark.read.parquet(f"{path}/design").first()["spec"])
        design = Design(spec["continuous"], spec["categorical"], spec["ordinal"], spec["levels"], spec["group_of"])
        return cls(design, spark.read.parquet(f"{path}/coefficients"), spec["transform"], spec["final_fit"])

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Predictions of the final fit: stateless, so the frame may also be a stream."""
        final = self.coefs.filter(F.col(L.FIT) == self.final_fit)
        return predict(df.withColumn("__final", F.lit(self.final_fit)), self.design, final, keep, "__final", target_pair(self.transform)[1])


class EnsembleScorer(LinearScorer):
    """Base models and what combines them as one artefact: loaded once, scored in one map over the rows.

    `parts` names the combinations in the order in which they are made; each is a dict with `kind` and `weights`
    by base model or earlier part: `stack` adds weighted transformed predictions to an `intercept`, `vote` averages them,
    `blend` weighs the logarithms of predictions that are at least 1. `best` is the model or part that compared best.
    """

    def __init__(self, design: Design, coefs: DataFrame, transform: str, final_fit: int, parts: Mapping[str, Mapping], best: str) -> None:
        super().__init__(design, coefs, transform, final_fit)
        self.parts, self.best = dict(parts), best
        known = {r["model"] for r in coefs.select("model").distinct().collect()}
        for name, part in self.parts.items():
            missing = set(part["weights"]) - known
            if part["kind"] not in ("stack", "vote", "blend") or missing or name in known:
                raise ValueError(f"part {name!r}: unknown kind or members {sorted(missing)}, or a name that is taken")
            known.add(name)
        if best not in known:
            raise ValueError(f"best is {best!r}, which is no model or part")

    def save(self, path: str) -> None:
        super().save(path)
        spec = json.dumps({"parts": self.parts, "best": self.best})
        self.coefs.sparkSession.createDataFrame([(spec,)], "spec string").write.mode("overwrite").parquet(f"{path}/ensemble")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EnsembleScorer:
        base = LinearScorer.load(spark, path)
        spec = json.loads(spark.read.parquet(f"{path}/ensemble").first()["spec"])
        return cls(base.design, base.coefs, base.transform, base.final_fit, spec["parts"], spec["best"])

    def wide(self, df: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """One column per base model and part, in the transformed target."""
        final = self.coefs.filter(F.col(L.FIT) == self.final_fit)
        out, names = predict_wide(df.withColumn("__final", F.lit(self.final_fit)), self.design, final, list(keep), "__final")
        for name, part in self.parts.items():
            out = out.withColumn(name, combined(part, *target_pair(self.transform)))
        return out, [*names, *self.parts]

    def score(self, df: DataFrame, keep: Sequence[str], models: Sequence[str] | None = None) -> DataFrame:
        """`(keep..., model, z, pred)` for the named models and parts, by default the best; stateless."""
        wide, names = self.wide(df, keep)
        chosen = [self.best] if models is None else list(models)
        if unknown := set(chosen) - set(names):
            raise ValueError(f"unknown models {sorted(unknown)}")
        cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("z")) for m in chosen])
        return wide.select(*keep, F.inline(cells)).withColumn("pred", target_pair(self.transform)[1](F.col("z")))


def combined(part: Mapping, forward, inverse):
    """The expression of one part over the columns of its members."""
    weights = part["weights"]
    if part["kind"] == "vote":
        return sum((F.col(m) for m in weights), F.lit(0.0)) / len(weights)
    if part["kind"] == "stack":
        return sum((F.col(m) * w for m, w in weights.items()), F.lit(float(part["intercept"])))
    return sum((forward(S.clip_floor(inverse(F.col(m)))) * w for m, w in weights.items()), F.lit(0.0))
