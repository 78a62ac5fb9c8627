"""Training, choosing, blending, keeping and applying match classifiers on feature tables."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.operators import metrics as M


class Learner(NamedTuple):
    """What a classifier is trained with. Boosted trees may stop early, at the round after which the loss on the held rows no longer falls by ``tolerance``."""

    kind: str = "boosted"
    trees: int = 20
    depth: int = 5
    step: float = 0.15
    rows: float = 0.85
    columns: str = "0.85"
    least_rows: int = 30
    tolerance: float = 0.001


#: The usual classifiers: quick ones, and those of many small steps that rely on the early stop.
QUICK = (Learner(), Learner("forest"))
THOROUGH = (Learner(trees=600, depth=8, step=0.04), Learner("forest", trees=300, depth=8))


def train(rows: DataFrame, features: list[str], kind: str = "boosted", trees: int = 20, depth: int = 5, seed: int = 42, validation: str | None = None, learner: Learner | None = None) -> PipelineModel:
    """A classifier of ``label`` (0 or 1). Boosted trees stop early on rows where the column ``validation`` is true."""
    l = learner or Learner(kind, trees, depth, least_rows=1)
    common = {"featuresCol": "features", "labelCol": "label", "maxDepth": l.depth, "seed": seed, "maxMemoryInMB": 512, "subsamplingRate": l.rows, "minInstancesPerNode": l.least_rows}
    if l.kind == "boosted":
        made = GBTClassifier(maxIter=l.trees, stepSize=l.step, featureSubsetStrategy=l.columns, validationTol=l.tolerance, **common)
        if validation:
            made = made.setValidationIndicatorCol(validation)
    else:
        made = RandomForestClassifier(numTrees=l.trees, **common)
    rows = rows.withColumn("label", F.col("label").cast("double"))
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), made]).fit(rows)


def probability(model: PipelineModel, rows: DataFrame, out: str = "prob") -> DataFrame:
    """``rows`` with the probability of a match."""
    kept = rows.columns
    return model.transform(rows).select(*kept, vector_to_array("probability")[1].alias(out))


def blend(rows: DataFrame, a: str, b: str, weight: float, out: str = "prob") -> DataFrame:
    return rows.withColumn(out, weight * F.col(a) + (1 - weight) * F.col(b))


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    """Features by their share of the gain, the largest first."""
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, values)), key=lambda x: (-x[1], x[0]))


class Decision(NamedTuple):
    """How scores become matches: weight of the first classifier, thresholds, and how far below an entity's best a match may lie.

    The threshold of a pair is that of its country and source, else of its country, else the general one.
    """

    name: str
    weight: float
    general: float
    by_country: dict[str, float]
    by_source: dict[str, float]
    gap: float | None
    f05: float

    def threshold(self, country: str = "country", source: str = "source"):
        # a few entries, as many as countries and sources
        of = lambda m, key: F.get(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(v)).alias("v")) for k, v in m.items()]), lambda e: e["k"] == key), F.lit(0))["v"] if m else F.lit(None)
        return F.coalesce(of(self.by_source, F.concat_ws("|", country, source)), of(self.by_country, F.col(country)), F.lit(self.general))


def save(path: str, spark: SparkSession, models: dict[str, PipelineModel], features: list[str], decision: Decision) -> None:
    """Models and everything needed to apply them, on any file system; what was there before is replaced."""
    at = path.rstrip("/")
    for name, m in models.items():
        m.write().overwrite().save(f"{at}/{name}")
    text = json.dumps({"models": sorted(models), "features": features, "decision": decision._asdict()}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/config")


def load(path: str, spark: SparkSession) -> tuple[dict[str, PipelineModel], list[str], Decision]:
    """What ``save`` wrote."""
    at = path.rstrip("/")
    config = json.loads(spark.read.text(f"{at}/config").first()["value"])
    return {n: PipelineModel.load(f"{at}/{n}") for n in config["models"]}, config["features"], Decision(**config["decision"])


GRID = (0.20, 0.01, 76)


def _swept(scored: DataFrame, truth: DataFrame, entities: DataFrame, by: list[str]) -> list:
    """Best thresholds by the columns ``by``: a row a group."""
    steps = scored.withColumn("step", M.step_of(F.col("prob"), *GRID))
    return M.best_step(M.sweep(steps.select("s1", "tgt", "step"), truth, entities, GRID[2], by), *by).collect()


def choose(scored: DataFrame, truth: DataFrame, entities: DataFrame, weights: tuple[float, ...] = (0.5, 0.7, 1.0), gaps: tuple[float, ...] = (0.35,)) -> tuple[Decision, list[Decision]]:
    """(the winner, all decisions tried) on held-out entities.

    ``scored(s1, tgt, source, p1, p2)`` are their candidates with the probabilities of two classifiers, ``truth(s1, tgt)`` their matches,
    ``entities(s1, country)`` all of them. Tried are: each weight with one threshold; the best of these with thresholds by country, then also by source;
    and with a gap to an entity's best match. Something less plain wins only if it is strictly better by mean F0.5.
    """
    theta = lambda r: round(GRID[0] + (r["step"] - 1) * GRID[1], 2)
    tried: list[Decision] = []
    for w in weights:
        best = _swept(blend(scored, "p1", "p2", w).select("s1", "tgt", "prob"), truth, entities, [])[0]
        tried.append(Decision(f"weight {w:g}", w, theta(best), {}, {}, None, float(best["f05"])))
    winner = max(tried, key=lambda d: d.f05)
    pairs = blend(scored, "p1", "p2", winner.weight).join(entities, "s1")

    def measured(d: Decision) -> Decision:
        kept = pairs.withColumn("t", d.threshold())
        kept = M.within_margin(kept, F.col("t"), d.gap) if d.gap is not None else kept.where(F.col("prob") >= F.col("t"))
        return d._replace(f05=float(M.macro(M.entity_scores(kept.select("s1", "tgt"), truth, entities)).first()["f05"]))

    countries = {r["country"]: theta(r) for r in _swept(pairs.select("s1", "tgt", "prob"), truth, entities, ["country"]) if r["country"] is not None}
    sources = {}
    for r in pairs.select("source").where("source is not null").distinct().collect():  # a row a source
        of = pairs.where(F.col("source") == r["source"])
        part = truth.where(F.col("tgt").startswith(f"{r['source']}-"))
        sources |= {f"{x['country']}|{r['source']}": theta(x) for x in _swept(of.select("s1", "tgt", "prob"), part, entities, ["country"]) if x["country"] is not None}
    more = [winner._replace(name="by country", by_country=countries), winner._replace(name="by country and source", by_country=countries, by_source=sources)]
    more += [d._replace(name=f"{d.name}, gap {g:g}", gap=g) for d in [winner, *more] for g in gaps]
    for d in map(measured, more):
        tried.append(d)
        if d.f05 > winner.f05:
            winner = d
    return winner, tried


def decide(scored: DataFrame, decision: Decision) -> DataFrame:
    """The rows of ``scored(s1, tgt, country, source, p1, p2)`` that count as matches, with ``prob``."""
    rows = blend(scored, "p1", "p2", decision.weight).withColumn("_t", decision.threshold())
    kept = M.within_margin(rows, F.col("_t"), decision.gap) if decision.gap is not None else rows.where(F.col("prob") >= F.col("_t"))
    return kept.drop("_t")
