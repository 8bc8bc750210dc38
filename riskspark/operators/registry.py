"""Model registry and audit as append-only tables.

Three tables over one commit log (``sources/commitlog.py``):

- ``runs(run_id, kind, key, value, logged_at)``: parameters, metrics, tags;
- ``versions(model_name, model_version, run_id, created_at, path)``;
- ``aliases(model_name, alias, model_version, set_at, seq)``: alias *events*;
  the holder of an alias is the latest event, so a promotion or a rollback is
  one commit and history is kept. ``seq`` follows the log, not a clock.

The reads are DataFrame functions, so the same logic also runs on registry
tables derived from data (see ``plans/q_registry.py``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.sources.commitlog import CommitLog


# ---------------------------------------------------------------------------
# Reads (pure DataFrame functions)
# ---------------------------------------------------------------------------
def latest_versions(versions: DataFrame) -> DataFrame:
    """Newest version per model (by creation time, then number)."""
    return versions.groupBy("model_name").agg(
        F.max_by("model_version", F.struct("created_at", "model_version")).alias("model_version"))


def current_aliases(aliases: DataFrame, order: tuple[str, ...] = ("set_at", "seq")) -> DataFrame:
    """Holder of each (model, alias): the latest alias event (of a registry's
    own table, by ``("seq",)``)."""
    return aliases.groupBy("model_name", "alias").agg(
        F.max_by("model_version", F.struct(*order)).alias("model_version"))


def version_by_alias(aliases: DataFrame, versions: DataFrame, alias: str = S.PRODUCTION,
                     order: tuple[str, ...] = ("set_at", "seq")) -> DataFrame:
    """The version rows that currently hold ``alias``."""
    cur = current_aliases(aliases, order).filter(F.col("alias") == alias)
    return cur.join(versions, ["model_name", "model_version"], "inner")


def promotion_events(best: DataFrame, period: str = "period", model: str = "model_name",
                     version: str = "model_version") -> DataFrame:
    """R3 from a table of promoted versions per period: each promotion sets
    ``production`` and moves the model's previous production version to
    ``previous-production``. One window per model over its promotions."""
    w = Window.partitionBy(model).orderBy(period)
    p = best.withColumn("_prev", F.lag(version).over(w))
    prod = p.select(F.col(model).alias("model_name"), F.lit(S.PRODUCTION).alias("alias"),
                    F.col(version).alias("model_version"), F.col(period).alias("set_at"),
                    F.lit(1).alias("_o"))
    prev = p.filter(F.col("_prev").isNotNull()).select(
        F.col(model).alias("model_name"), F.lit(S.PREVIOUS_PRODUCTION).alias("alias"),
        F.col("_prev").alias("model_version"), F.col(period).alias("set_at"), F.lit(0).alias("_o"))
    ev = prev.unionByName(prod)
    return ev.withColumn("seq", F.col("_o").cast("long")).drop("_o")


def audit(predictions: DataFrame, versions: DataFrame, runs: DataFrame,
          metrics: list[str] | None = None) -> DataFrame:
    """Each prediction with the version, run and run metrics behind it."""
    m = runs.filter(F.col("kind") == "metric")
    if metrics:
        m = m.filter(F.col("key").isin(metrics))
    wide = m.groupBy("run_id").pivot("key", metrics).agg(F.first(F.col("value").cast("double")))
    return (predictions.join(versions, ["model_name", "model_version"], "left")
            .join(wide, "run_id", "left"))


# ---------------------------------------------------------------------------
# The registry itself (writes are commits)
# ---------------------------------------------------------------------------
class Registry:
    """Runs, versions and aliases as actions of one commit log. Numbers are
    given and gates judged inside the commit, so concurrent trainings get
    different versions and a promotion is one atomic step."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log")

    def runs(self) -> DataFrame:
        return self.log.table().filter("action = 'run'").select("run_id", "kind", "key", "value", F.col("at").alias("logged_at"))

    def versions(self) -> DataFrame:
        return self.log.table().filter("action = 'version'").select(
            "model_name", "model_version", "run_id", F.col("at").alias("created_at"), "path")

    def aliases(self) -> DataFrame:
        return self.log.table().filter("action = 'alias'").select(
            "model_name", "alias", "model_version", F.col("at").alias("set_at"), "seq")

    # R1
    def log_run(self, params: dict | None = None, metrics: dict | None = None,
                tags: dict | None = None, run_id: str | None = None) -> str:
        run_id = run_id or uuid.uuid4().hex
        rows = [("param", k, None if v is None else str(v)) for k, v in (params or {}).items()]
        rows += [("metric", k, None if v is None else repr(float(v))) for k, v in (metrics or {}).items()]
        rows += [("tag", k, str(v)) for k, v in (tags or {}).items()]
        if rows:
            self.log.commit(lambda _: [{"action": "run", "run_id": run_id, "kind": kind, "key": k, "value": v}
                                       for kind, k, v in rows])
        return run_id

    # R2
    def register_version(self, model_name: str, run_id: str, path: str | None = None) -> int:
        def decide(state):
            taken = [a["model_version"] for a in state if a["action"] == "version" and a["model_name"] == model_name]
            return [{"action": "version", "model_name": model_name, "model_version": max(taken, default=0) + 1,
                     "run_id": run_id, "path": path}]
        return self.log.commit(decide)[0]["model_version"]

    def set_alias(self, model_name: str, alias: str, version: int | None) -> None:
        self.log.commit(lambda _: [_alias(model_name, alias, version)])

    def alias_version(self, model_name: str, alias: str = S.PRODUCTION) -> int | None:
        self.log.refresh()
        return _holder([a for c in self.log.commits for a in c], model_name, alias)

    # R3 (C1: ``require_improvement`` gives the documented gate)
    def promote(self, model_name: str, version: int, metric: str = "roc_auc",
                require_improvement: bool = False) -> bool:
        """Give ``version`` the production alias and its predecessor
        previous-production, in one commit. With the gate, a version that is
        not better than the model now in production changes nothing."""
        def decide(state):
            current = _holder(state, model_name, S.PRODUCTION)
            serving = _production(state)
            if require_improvement and serving is not None:
                new, old = _metric(state, model_name, version, metric), _metric(state, *serving, metric)
                if new is None or (old is not None and new <= old):
                    return None
            moved = [_alias(model_name, S.PREVIOUS_PRODUCTION, current)] if current not in (None, version) else []
            return [*moved, _alias(model_name, S.PRODUCTION, version)]
        return self.log.commit(decide) is not None

    # R4
    def rollback(self, model_name: str | None = None) -> int | None:
        """Back to the model's previous production version; without a name,
        back to whatever model and version served before the newest promotion."""
        back: list = []

        def decide(state):
            if model_name is None:
                served = [(a["model_name"], a["model_version"]) for a in state
                          if a["action"] == "alias" and a["alias"] == S.PRODUCTION]
                earlier = [s for s in served if s != served[-1]]
                if not earlier:
                    return None
                name, version = earlier[-1]
            else:
                name, version = model_name, _holder(state, model_name, S.PREVIOUS_PRODUCTION)
                if version is None:
                    return None
            back[:] = [version]
            current = _holder(state, name, S.PRODUCTION)
            moved = [_alias(name, S.PREVIOUS_PRODUCTION, current)] if current not in (None, version) else []
            return [_alias(name, S.PRODUCTION, version), *moved]
        return back[0] if self.log.commit(decide) is not None else None

    def production_model(self) -> tuple[str, int] | None:
        """The model and version of the newest production event."""
        self.log.refresh()
        return _production([a for c in self.log.commits for a in c])

    def production(self) -> tuple[str, int, str] | None:
        """(model, version, path of its bundle) in production."""
        serving = self.production_model()
        if serving is None:
            return None
        path = next((a["path"] for c in self.log.commits for a in c if a["action"] == "version"
                     and (a["model_name"], a["model_version"]) == serving), None)
        return None if not path else (*serving, path)


def _alias(model_name: str, alias: str, version: int | None) -> dict:
    return {"action": "alias", "model_name": model_name, "alias": alias, "model_version": version}


def _holder(state: list[dict], model_name: str, alias: str) -> int | None:
    held = [a["model_version"] for a in state
            if a["action"] == "alias" and a["model_name"] == model_name and a["alias"] == alias]
    return held[-1] if held else None


def _production(state: list[dict]) -> tuple[str, int] | None:
    held = [(a["model_name"], a["model_version"]) for a in state
            if a["action"] == "alias" and a["alias"] == S.PRODUCTION and a["model_version"] is not None]
    return held[-1] if held else None


def _metric(state: list[dict], model_name: str, version: int, metric: str) -> float | None:
    run = next((a["run_id"] for a in state if a["action"] == "version"
                and (a["model_name"], a["model_version"]) == (model_name, version)), None)
    found = [a["value"] for a in state if a["action"] == "run" and a["kind"] == "metric"
             and a["run_id"] == run and a["key"] == metric]
    return None if not found or found[-1] is None else float(found[-1])
