"""Quality rules, the dataset graph, sinks, the run log and the model."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomcast.config import ForecastSpec, SplitSpec
from loomcast.operators import hurdle, metrics
from loomcast.plans import training
from loomcast.plans.forecast import SOURCES, forecast_graph
from loomcast.plans.graph import Graph, GraphError
from loomcast.plans.quality import Expectation, ExpectationFailed, drop_failed, enforce, guard, report
from loomcast.sources import tables
from loomcast.sources.runlog import RunLog


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(1,), (2,), (None,)], "x int")


def test_rules_warn_drop_fail_and_null_counts_as_failed(numbers):
    rules = [Expectation("big", "x > 1", "warn"), Expectation("known", "x IS NOT NULL", "drop")]
    assert {r["name"]: (r["n_rows"], r["n_failed"]) for r in report(numbers, rules).collect()} == {"big": (3, 2), "known": (3, 1)}
    kept, _ = enforce(numbers, rules)
    assert kept.count() == 2 == drop_failed(numbers, rules).count()
    fail = [Expectation("big", "x > 1", "fail")]
    with pytest.raises(ExpectationFailed):
        enforce(numbers, fail)
    with pytest.raises(Exception, match="expectation big failed"):
        guard(numbers, fail).collect()
    with pytest.raises(ValueError):
        Expectation("odd", "true", "shrug")


def test_graph_orders_and_refuses(spark, numbers):
    g = Graph()
    g.source("raw", lambda s: numbers)
    g.dataset("b", name="c")(lambda b: b)
    g.dataset("raw", name="b")(lambda r: r.filter("x is not null"))
    assert g.order() == ["b", "c"] and g.plan(spark, "c").count() == 2
    with pytest.raises(GraphError, match="twice"):
        g.dataset("raw", name="b")(lambda r: r)
    g.dataset("nothing", name="d")(lambda n: n)
    with pytest.raises(GraphError, match="not defined"):
        g.order(["d"])
    h = Graph()
    h.dataset("q", name="p")(lambda q: q)
    h.dataset("p", name="q")(lambda p: p)
    with pytest.raises(GraphError, match="cycle"):
        h.order()


SPLITS = SplitSpec("2024-07", "2024-08", "2024-09", "2024-10")


def raw_tables(spark, leak=False):
    weeks = [f"2024-{w:02d}" for w in range(1, 9 if not leak else 10)]
    sales = [(w, 1, a, (i * a) % 4) for i, w in enumerate(weeks) for a in (1, 2)] + [(None, 1, 1, 3)]
    return {
        "bronze_ventes": spark.createDataFrame(sales, "semaine string, code_agence long, code_article long, quantite long"),
        "bronze_ventes_test": spark.createDataFrame([(w, 1, a) for w in ("2024-09", "2024-10") for a in (1, 2)], "semaine string, code_agence long, code_article long"),
        "bronze_agences": spark.createDataFrame([(1, "N")], "code_agence long, ag_region string"),
        "bronze_articles": spark.createDataFrame([(1, 1, "s", "f", "m"), (1, 1, "s", "f", "z"), (1, 2, "t", None, "m")], "code_agence long, code_article long, specialite string, famille string, marque string"),
        "bronze_facturation": spark.createDataFrame([(1, 1, 2023, 12, 8.0, 2.0, 4)], "code_agence long, code_article long, annee int, mois int, sum_montant double, sum_quantite double, nb_achats long"),
    }


def test_forecast_graph_materialises_and_leaks_abort(spark, tmp_path):
    data = raw_tables(spark)
    assert set(data) == set(SOURCES)
    g = forecast_graph(lambda s, n: data[n], ForecastSpec(splits=SPLITS))
    reports = g.materialize(spark, str(tmp_path / "a"))
    g.register_tables(spark, str(tmp_path / "a"))
    assert tables.read_table(spark, "gold_train").count() == 12 and spark.table("gold_validation").count() == 4 and spark.table("gold_test_features").count() == 4
    gold = spark.table("gold_feature_table")
    assert gold.filter("art_mdd_enc = -1").count() == gold.count() == 20 and len(gold.columns) == 64
    assert gold.filter("semaine = '2024-06' and code_article = 1").first()["fac_prix_unit"] == 4.0
    assert {r["name"]: r["n_failed"] for r in reports["silver_ventes"]}["semaine_not_null"] == 1
    assert g.datasets["gold_feature_table"].partition_by == ("annee",) and g.datasets["gold_train"].properties == {"quality": "gold"}
    leaked = raw_tables(spark, leak=True)
    with pytest.raises(ExpectationFailed):
        forecast_graph(lambda s, n: leaked[n], ForecastSpec(splits=SPLITS)).materialize(spark, str(tmp_path / "b"))


def test_sinks(spark, tmp_path, numbers):
    tables.write_partitioned(numbers.withColumn("p", F.lit(1)), str(tmp_path / "p"), ["p"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3 and (tmp_path / "p" / "p=1").exists()
    tables.write_csv(numbers.filter("x is not null"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    tables.save_table(numbers, "kept_numbers", {"quality": "gold"})
    assert tables.read_table(spark, "kept_numbers").count() == 3
    spark.sql("DROP TABLE kept_numbers")
    assert tables.scalar(numbers.agg(F.max("x"))) == 2 and tables.scalar(numbers.filter("false")) is None
    assert len(tables.small_pandas(numbers)) == 3
    with pytest.raises(ValueError):
        tables.small_pandas(numbers, 2)
    assert tables.local_rows(spark, [("2024-01", 1, 2, 3, 0.1, 2.0, 2.0)], tables.VALIDATION_SCHEMA).count() == 1


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    with pytest.raises(LookupError):
        log.latest("demand")
    with pytest.raises(LookupError):
        log.latest_version("zero")
    log.log("demand", "train", {"t": 0.5}, {"wape": 1.5}, "zero", started=datetime(2024, 1, 1))
    log.log("demand", "train", {"t": 0.6}, {"wape": 1.2}, "zero", started=datetime(2024, 1, 2))
    assert log.latest("demand")["params"] == {"t": 0.6} and log.latest_version("zero") == "2"


def test_hurdle_trains_scores_and_reloads(spark, tmp_path):
    rows = [(0 if i % 5 == 0 else i % 7 + 1, float(i % 5), float(i % 7) if i % 9 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "quantite long, a double, b double")
    spec = hurdle.HurdleSpec(zero_rounds=2, quantity_rounds=2, depth=3)
    model = hurdle.train_hurdle(df.filter("a < 4"), df.filter("a >= 4 or b is null"), ["a", "b"], spec)
    scored = model.score(df)
    assert scored.filter("p_zero between 0 and 1 and qty_pred >= 0").count() == 200
    assert scored.filter("a = 0").agg(F.avg("p_zero")).first()[0] > scored.filter("a = 1").agg(F.avg("p_zero")).first()[0]
    assert model.importance(spark).count() == 4
    model.save(str(tmp_path / "m"))
    again = hurdle.load_model(str(tmp_path / "m"))
    assert again.names == ["a", "b"] and again.score(df).count() == 200


def test_training_run_writes_models_reports_and_predictions(spark, tmp_path):
    data = raw_tables(spark)
    g = forecast_graph(lambda s, n: data[n], ForecastSpec(splits=SPLITS))
    log, path = RunLog(spark, str(tmp_path / "log")), str(tmp_path / "t")
    spec = hurdle.HurdleSpec(zero_rounds=1, quantity_rounds=1, depth=2)
    final = training.run(spark, g, path, log, ["lag_1", "pair_mean", "art_specialite_enc", "ag_region_enc"], spec)
    assert final.columns == ["semaine", "code_agence", "code_article", "prediction"] and final.count() == 4 and final.filter("prediction < 0").count() == 0
    stored = spark.read.parquet(f"{path}/val_predictions")
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in tables.VALIDATION_SCHEMA] and stored.count() == 4
    trained = log.latest(training.EXPERIMENT, "train")
    assert trained["model"] == training.MODEL and trained["version"] == "1" and trained["params"]["n_features"] == 4 and trained["metrics"]["val_wape"] >= 0
    assert log.artifact(trained["run_id"], "threshold_sweep").count() == 11 and log.artifact(trained["run_id"], "importance").count() == 8
    assert hurdle.load_model(log.model_path(training.MODEL, "1")).codes == {"art_specialite_enc": 2, "ag_region_enc": 1}
    assert log.latest(training.EXPERIMENT, "inference")["metrics"]["n_test_rows"] == 4
    g.register_catalog(spark, path)
    assert spark.table("default.gold_train").count() == 12 and spark.table("default.gold_feature_table").count() == 20
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES default.gold_train").collect()}
    assert shown["quality"] == "gold"
    for name in g.datasets:
        spark.sql(f"DROP TABLE default.{name}")


def test_a_broken_rule_leaves_the_earlier_dataset(spark, tmp_path):
    good = raw_tables(spark)
    forecast_graph(lambda s, n: good[n], ForecastSpec(splits=SPLITS)).materialize(spark, str(tmp_path / "k"))
    leaked = raw_tables(spark, leak=True)
    with pytest.raises(ExpectationFailed):
        forecast_graph(lambda s, n: leaked[n], ForecastSpec(splits=SPLITS)).materialize(spark, str(tmp_path / "k"))
    assert spark.read.parquet(str(tmp_path / "k/gold_test_features")).count() == 4 and not list(tmp_path.glob("k/_new_*"))


def test_versions_are_claimed_once(spark, tmp_path):
    path = str(tmp_path / "v" / "1")
    assert tables.claim(spark, path) and not tables.claim(spark, path)
    assert metrics.wape_feval([1.0, 2.0], [1.0, 4.0]) == ("wape", pytest.approx(0.4), False)
    link = tables.download_link(spark.range(2), "a.csv")
    assert 'download="a.csv"' in link and "aWQKMAoxCg==" in link
