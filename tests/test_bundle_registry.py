"""Scoring bundle, commit log, prediction log and readers (M12, M20, R1-R4,
S1-S12, T1, T6, M14)."""
import glob
import threading

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import make_raw
from riskspark import schemas as S
from riskspark.operators import bundle as B
from riskspark.operators import prep as P
from riskspark.operators.calibrate import apply_isotonic, fit_isotonic
from riskspark.operators.clean import apply_clip
from riskspark.operators.features import engineer
from riskspark.operators.models import fit, score
from riskspark.operators.registry import Registry, current_aliases
from riskspark.operators.tuning import tune
from riskspark.plans.training import TrainingConfig, run_training
from riskspark.sources import readers as RD
from riskspark.sources import sinks as SK
from riskspark.sources.commitlog import CommitLog, publish
from riskspark.streaming import jobs as J

BOUNDS = {"lower": 100.0, "upper": 4000.0}


@pytest.fixture(scope="module")
def trained(spark):
    raw = make_raw(spark, 300, 0.3).withColumn(
        "transaction_amount", F.when(F.col("is_fraud") == 1, F.col("transaction_amount") + 3000).otherwise(F.col("transaction_amount")))
    f = P.split(engineer(apply_clip(raw, BOUNDS))).checkpoint()
    train, val = f.filter("split = 'train'"), f.filter("split = 'val'")
    num, cat = P.feature_columns(f)
    prep, names = P.fit_preprocessor(train, num, cat)
    out = {}
    for model, kw in (("LogisticRegression", {}), ("RandomForest", {"numTrees": 5, "maxDepth": 4})):
        m = fit(model, prep, train, **kw)
        iso = fit_isotonic(score(m, val, keep=[S.TARGET]), "score", S.TARGET)
        out[model] = (m, iso, B.build(m, BOUNDS, names, B.training_mean(m, train), iso, 0.3))
    return raw, f, out


def by_id(df, *cols):
    return {r["transaction_id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("model", ["LogisticRegression", "RandomForest"])
def test_bundle_equals_the_calibrated_evaluation(spark, tmp, trained, model):
    raw, f, models = trained
    m, iso, bundle = models[model]
    expected = by_id(apply_isotonic(iso, score(m, f, keep=["transaction_id"]), threshold=0.3), "score", "predicted_label")
    back = B.load(B.save(bundle, f"{tmp}/b"))
    got = by_id(B.score(back, raw.drop(S.TARGET), keep=["transaction_id"]), "score", "predicted_label")
    assert got.keys() == expected.keys()
    assert all(abs(got[k][0] - expected[k][0]) < 1e-12 and got[k][1] == expected[k][1] for k in got)
    assert len({s for s, _ in got.values()}) < len({r["score"] for r in score(m, f).collect()})    # calibrated: steps
    with pytest.raises(Exception, match="exist"):
        B.save(bundle, f"{tmp}/b")


@pytest.mark.parametrize("model", ["LogisticRegression", "RandomForest"])
def test_reasons_with_every_score(trained, model):
    raw, f, models = trained
    bundle = models[model][2]
    out = B.score(bundle, raw, keep=["transaction_id"], reasons=True).collect()
    assert len(out) == raw.count() and all(r["available"] and r["reason"] is None for r in out)
    assert all(len(r["top_reasons"]) == 10 for r in out)
    for r in out:
        size = [abs(x["impact"]) for x in r["top_reasons"]]
        assert size == sorted(size, reverse=True)
        assert all(x["direction"] == ("toward_fraud" if x["impact"] > 0 else "away_from_fraud")
                   for x in r["top_reasons"] if x["impact"])
    if model == "LogisticRegression":       # contributions add up to the margin less its mean
        clf = B.classifier(bundle)
        w, mean = clf.coefficients.toArray(), bundle.stages[-1].getOrDefault("background")
        x = {r["transaction_id"]: r["v"] for r in bundle.transform(raw).select(
            "transaction_id", vector_to_array("features").alias("v")).collect()}
        for r in out[:20]:
            parts = sorted((float(a * (b - c)) for a, b, c in zip(w, x[r["transaction_id"]], mean, strict=True)), key=abs, reverse=True)
            assert [round(p, 3) for p in parts[:10]] == pytest.approx([round(t["impact"], 3) for t in r["top_reasons"]], abs=2e-3)


def test_unknown_model_is_reported_not_raised(trained):
    from pyspark.ml.classification import NaiveBayes
    raw, f, models = trained
    fitted, _, _ = models["LogisticRegression"]
    pre = fitted.stages[:-1]
    from pyspark.ml import PipelineModel
    data = PipelineModel(pre).transform(f).withColumn("label", F.col(S.TARGET).cast("double"))
    nb = NaiveBayes(modelType="gaussian").fit(data)
    bundle = B.build(PipelineModel([*pre, nb]), BOUNDS, [], [])
    out = B.score(bundle, raw, keep=["transaction_id"], reasons=True).collect()
    assert len(out) == raw.count()
    assert all(not r["available"] and r["reason"] == B.NOT_EXPLAINED and r["top_reasons"] is None for r in out)


# ------------------------------------------------------------------ the log
def test_two_writers_get_different_versions(spark, tmp):
    def work(i):
        reg = Registry(spark, tmp)
        for k in range(15):
            run = reg.log_run({"writer": i}, {"roc_auc": 0.5})
            got[i].append(reg.register_version("fraud-m", run, f"p{i}-{k}"))

    got = {0: [], 1: [], 2: []}
    threads = [threading.Thread(target=work, args=(i,)) for i in got]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v for vs in got.values() for v in vs) == list(range(1, 46))
    assert all(vs == sorted(vs) for vs in got.values())
    reg = Registry(spark, tmp)
    assert reg.versions().count() == 45 and reg.versions().select("model_version").distinct().count() == 45
    assert reg.runs().count() == 90
    paths = {r["model_version"]: r["path"] for r in reg.versions().collect()}
    assert all(paths[v] == f"p{i}-{k}" for i, vs in got.items() for k, v in enumerate(vs))
    assert not glob.glob(f"{tmp}/log/_*")


def test_decisions_rest_on_the_newest_state(spark, tmp):
    """A gate judged on a state that has passed is judged again."""
    a, b = CommitLog(spark, f"{tmp}/log"), CommitLog(spark, f"{tmp}/log")
    seen = []

    def late(state):
        seen.append(len(state))
        if len(seen) == 1:
            b.commit(lambda s: [{"action": "run", "key": "first"}])
        return [{"action": "run", "key": f"after {len(state)}"}]
    a.commit(late)
    assert seen == [0, 1]
    assert [r["key"] for r in a.table().orderBy("seq").collect()] == ["first", "after 1"]
    assert a.commit(lambda s: None) is None and len(a.commits) == 2


def test_publish_never_replaces(spark, tmp):
    for name in ("one", "two", "three"):
        spark.range(3).write.parquet(f"{tmp}/{name}")
    assert publish(spark, f"{tmp}/one", f"{tmp}/place/x")
    assert not publish(spark, f"{tmp}/two", f"{tmp}/place/x")
    assert not SK.path_exists(spark, f"{tmp}/two") and spark.read.parquet(f"{tmp}/place/x").count() == 3
    with pytest.raises(Exception, match="does not exist|not found|NotFound"):
        publish(spark, f"{tmp}/absent", f"{tmp}/place/y")


def test_promotion_rollback_and_serving(spark, tmp):
    reg = Registry(spark, tmp)
    for name, auc in (("fraud-a", 0.8), ("fraud-b", 0.9), ("fraud-a", 0.7)):
        v = reg.register_version(name, reg.log_run(metrics={"roc_auc": auc}), f"{name}/{auc}")
        if auc != 0.7:
            assert reg.promote(name, v)
    assert reg.production() == ("fraud-b", 1, "fraud-b/0.9")        # the newest promotion, whatever its name
    before = len(reg.log.commits)
    assert not reg.promote("fraud-a", 2, require_improvement=True)
    reg.log.refresh()
    assert len(reg.log.commits) == before and reg.production_model() == ("fraud-b", 1)
    assert reg.rollback() == 1 and reg.production_model() == ("fraud-a", 1)
    assert reg.promote("fraud-a", 2) and reg.alias_version("fraud-a", S.PREVIOUS_PRODUCTION) == 1
    assert reg.rollback("fraud-a") == 1 and reg.production() == ("fraud-a", 1, "fraud-a/0.8")
    held = {(r["model_name"], r["alias"]): r["model_version"] for r in current_aliases(reg.aliases(), ("seq",)).collect()}
    assert held == {("fraud-a", S.PRODUCTION): 1, ("fraud-a", S.PREVIOUS_PRODUCTION): 2, ("fraud-b", S.PRODUCTION): 1}
    assert Registry(spark, f"{tmp}/new").rollback() is None and Registry(spark, f"{tmp}/new").production() is None


def test_training_twice_keeps_versions_and_a_rejected_one_changes_nothing(spark, tmp):
    raw = make_raw(spark, 300, 0.3).withColumn(
        "transaction_amount", F.col("transaction_amount") + 2500 * F.col("is_fraud"))
    cfg = TrainingConfig("q", models=["LogisticRegression"], do_tuning=True, n_trials=2, require_improvement=True)
    one = run_training(spark, raw, cfg, tmp)
    reg = Registry(spark, f"{tmp}/registry")
    name = S.MODEL_PREFIX + "LogisticRegression"
    assert one.promoted and reg.production_model() == (name, 1)
    scores = by_id(B.score(B.load(reg.production()[2]), raw, keep=["transaction_id"]), "score", "predicted_label")
    # the tuned model is a version of its own, calibrated and scored like the others
    assert one.tuned["model"] == f"{name}-tuned" and one.tuned["version"] == 1
    assert B.score(B.load(one.tuned["path"]), raw).count() == raw.count()
    run = reg.versions().filter(F.col("model_name") == one.tuned["model"]).first()["run_id"]
    keys = {r["key"] for r in reg.runs().filter(F.col("run_id") == run).collect()}
    assert {"tuned_roc_auc", "best_C", "regParam", "kind", "roc_auc"} <= keys
    # worse data: the candidate is registered, production and baseline stay
    baseline = spark.read.parquet(f"{tmp}/baseline").agg(F.sum("transaction_amount")).first()[0]
    noise = raw.withColumn("is_fraud", (F.crc32("transaction_id") % 3 == 0).cast("int")).withColumn("transaction_amount", F.lit(50.0) + F.rand(1))
    two = run_training(spark, noise, TrainingConfig("q", models=["LogisticRegression"], require_improvement=True, explain=False), tmp)
    assert not two.promoted and two.versions["LogisticRegression"] == 2 and reg.production_model() == (name, 1)
    assert by_id(B.score(B.load(reg.production()[2]), raw, keep=["transaction_id"]), "score", "predicted_label") == scores
    assert spark.read.parquet(f"{tmp}/baseline").agg(F.sum("transaction_amount")).first()[0] == baseline
    assert B.load(two.paths["LogisticRegression"]).stages[0].getOrDefault("upper") < 100     # bounds go with the version


def test_tuning_on_balanced_rows(spark, trained, monkeypatch):
    from riskspark.operators import tuning
    raw, f, models = trained
    prep = models["LogisticRegression"][0]
    from pyspark.ml import PipelineModel
    seen, inner = [], tuning.training_rows

    def rows(*a):
        out = inner(*a)
        seen.append({r["label"]: r["count"] for r in out.groupBy("label").count().collect()})
        return out
    monkeypatch.setattr(tuning, "training_rows", rows)
    r = tune("LogisticRegression", PipelineModel(prep.stages[:-1]), f.filter("split = 'train'"), f.filter("split = 'val'"),
             3, balance=True)
    assert len(seen) == 1 and seen[0][0.0] == seen[0][1.0]
    assert r.best_score == max(a for _, _, a in r.trials) and r.best_params in [p for _, p, _ in r.trials]


def test_stream_waits_for_a_model_and_follows_promotions(spark, tmp, trained):
    raw, f, models = trained
    reg = Registry(spark, f"{tmp}/registry")
    req = raw.drop(S.TARGET)
    req.write.parquet(f"{tmp}/in")

    def run():
        q = J.score_stream(J.read_stream(spark, f"{tmp}/in", req.schema), J.ModelCache(reg.production), f"{tmp}/out", f"{tmp}/ck")
        q.awaitTermination()
    with pytest.raises(Exception, match="no production model"):
        run()
    for name in ("LogisticRegression", "RandomForest"):
        path = B.save(models[name][2], f"{tmp}/runs/{name}/bundle")
        reg.promote(S.MODEL_PREFIX + name, reg.register_version(S.MODEL_PREFIX + name, reg.log_run({"m": name}), path))
        if name == "LogisticRegression":
            run()                       # the kept batch, scored once a model is there
            assert spark.read.parquet(f"{tmp}/out").count() == req.count()
            req.write.mode("append").parquet(f"{tmp}/in")
    run()
    out = spark.read.parquet(f"{tmp}/out")
    assert {(r["model_name"], r["count"]) for r in out.groupBy("model_name").count().collect()} == {
        (S.MODEL_PREFIX + "LogisticRegression", req.count()), (S.MODEL_PREFIX + "RandomForest", req.count())}
    for name in ("LogisticRegression", "RandomForest"):
        got = by_id(out.filter(F.col("model_name") == S.MODEL_PREFIX + name), "confidence_score", "predicted_label")
        assert got == by_id(B.score(models[name][2], req, keep=["transaction_id"]), "score", "predicted_label")


# ------------------------------------------------------------ sinks, readers
def test_prediction_log_survives_retries(spark, tmp):
    df = spark.createDataFrame([("a", 1, 0.9), ("b", 0, 0.1), ("b", 0, 0.1), ("c", None, None)],
                               "transaction_id string, predicted_label int, confidence_score double")
    first = SK.log_predictions(df, f"{tmp}/log", "m", "1")
    assert SK.log_predictions(df.repartition(3), f"{tmp}/log", "m", "1") == first
    assert spark.read.parquet(f"{tmp}/log").count() == 4 and not glob.glob(f"{tmp}/log/_side*")
    assert SK.log_predictions(df, f"{tmp}/log", "m", "2") != first
    assert SK.log_predictions(df.limit(0), f"{tmp}/log", "m", "2") != first
    SK.log_predictions(df, f"{tmp}/log", "m", "1", batch_id="again")
    log = spark.read.parquet(f"{tmp}/log")
    assert log.count() == 12 and log.filter(F.col("predicted_at").isNull()).count() == 0


def test_snapshot_reads_its_input_once(spark, tmp):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    df = make_raw(spark, 40).coalesce(2)
    m = SK.snapshot(df.mapInArrow(count, df.schema), f"{tmp}/s", "csv", "s1").first()
    assert reads.value == 40 and m["row_count"] == 40
    stored = spark.read.parquet(m["path"])
    again = SK.snapshot(stored.repartition(5), f"{tmp}/s", "csv", "s2").first()
    by_hand = stored.agg(F.sum(F.xxhash64(*stored.columns).cast("decimal(38,0)")).cast("string")).first()[0]
    assert m["content_hash"] == again["content_hash"] == by_hand
    assert spark.read.parquet(f"{tmp}/s/manifest").count() == 2
    other = SK.snapshot(stored.limit(39), f"{tmp}/s", "csv").first()
    assert other["content_hash"] != m["content_hash"]


def test_bounds_are_not_lost_to_an_error(spark, tmp):
    assert SK.load_bounds(spark, f"{tmp}/none")["upper"] == float("inf")
    (open(f"{tmp}/broken", "w")).write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        SK.load_bounds(spark, f"{tmp}/broken")


def test_where_reaches_the_parquet_scan(spark, tmp):
    spark.createDataFrame([(1, 50.0), (2, 150.0), (3, float("nan")), (4, None)], "id int, value double").coalesce(1).write.parquet(f"{tmp}/p")
    df = RD.read_parquet(spark, f"{tmp}/p", where=[("value", ">", 100.0)])
    assert [r["id"] for r in df.collect()] == [2]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in plan
    assert [r["id"] for r in RD.read_parquet(spark, f"{tmp}/p", where=[("value", "<", 100.0), ("id", "=", 1)]).collect()] == [1]
    assert {r["id"]: r["value"] for r in RD.read_parquet(spark, f"{tmp}/p").collect()} == {1: 50.0, 2: 150.0, 3: None, 4: None}
    with pytest.raises(ValueError, match="like"):
        RD.read_parquet(spark, f"{tmp}/p", where=[("value", "like", "x")])


def test_database_extract_binds_its_parameters(spark, monkeypatch):
    import datetime as dt
    seen = {}

    def read(spark, url, query=None, **kw):
        seen.update(url=url, query=query, **kw)
        return spark.range(1)
    monkeypatch.setattr(RD, "read_jdbc", read)
    sql = "SELECT * FROM t WHERE created_at > :start AND name = :name AND note = ':name ''quoted''' AND n < :n"
    df = RD.extract(spark, "postgres", sql, url="jdbc:x", user="u", params={"start": dt.datetime(2024, 1, 2, 3), "name": "O'Hara", "n": 5})
    assert df.count() == 1 and seen["url"] == "jdbc:x" and seen["user"] == "u"
    assert seen["query"] == ("SELECT * FROM t WHERE created_at > TIMESTAMP '2024-01-02 03:00:00' AND name = 'O''Hara' "
                             "AND note = ':name ''quoted''' AND n < 5")
    with pytest.raises(ValueError, match=":missing"):
        RD.bind("SELECT :missing", {})
    with pytest.raises(ValueError, match="query"):
        RD.extract(spark, "jdbc", " ", url="jdbc:x")


def test_warehouse_falls_back_only_without_a_connector(spark, monkeypatch):
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").createOrReplaceTempView("wh_t")
    got = RD.extract(spark, "warehouse", "SELECT * FROM wh_t WHERE id = :id", params={"id": 2}).collect()
    assert [r["name"] for r in got] == ["b"]
    assert RD.read_warehouse(spark, table="wh_t").count() == 2
    with pytest.raises(Exception, match="(?i)path|does not exist"):     # an installed connector's own error is raised
        RD.read_warehouse(spark, table="/no/such/place", fmt="parquet")


def test_csv_table_with_detected_types(spark, tmp):
    with open(f"{tmp}/t.csv", "w") as f:
        f.write("id,amount,name\n1,2.5,x\n2,,y\n")
    t = RD.load_csv_table(spark, f"{tmp}/t.csv", f"{tmp}/t")
    assert t.dtypes == [("id", "int"), ("amount", "double"), ("name", "string")] and t.count() == 2
