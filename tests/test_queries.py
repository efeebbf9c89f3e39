"""Each query of the library against its SQL on the smallest data; and that all works without the training-data operators."""

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from loomcast.queries import QUERIES
from loomcast.sql import SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
#: The others take longer and are made of the same parts.
CHECKED = [
    "weekly_panel", "week_minus_years", "calendar_features", "lags", "trend_yoy", "pair_expanding", "agency_expanding", "agency_means", "clean_sales", "panel_union", "encode_articles",
    "label_encoder_map", "billing_joined", "gold_test", "expectation_report", "expect_drop", "baseline_wape", "wape_by_slice", "confusion_matrix", "threshold_sweep", "impute_short_horizon",
    "final_predictions", "val_predictions", "profile_brand", "gold_train", "article_expanding", "profile_target", "pareto_articles", "coverage_antijoin", "lag_correlation",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    return "" if v is None else str(v)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    listed = ", ".join(f'"{n}"' for n in names)
    want = sorted(tuple(map(plain, r)) for r in con.execute(f"select {listed} from ({SQL[name]})").fetchall())
    assert sorted(tuple(map(plain, r)) for r in df.select(*names).collect()) == want


def test_all_queries_but_the_model_have_sql():
    assert set(QUERIES) - set(SQL) == {"hurdle_gbt"} and not set(SQL) - set(QUERIES)


def test_entry_imports_without_the_training_data_operators(tmp_path):
    root = Path(__file__).resolve().parent.parent
    (tmp_path / "loomcast").mkdir()
    for p in (root / "loomcast").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "loomcast" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'gold_features' in q and not any(n.startswith('op') for n in q); print(len(q), len(s))"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr


def test_a_missing_library_of_the_training_data_operators_leaves_the_rest():
    root = Path(__file__).resolve().parent.parent
    code = "import sys; sys.modules['zstandard'] = sys.modules['regex'] = None; import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'gold_features' in q and 'pipeline' not in q and not any(n.startswith('op') for n in [*q, *s])"
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr


def test_the_model_query_trains_on_all_features_with_the_default_budget(spark, monkeypatch):
    from loomcast import queries
    from loomcast.config import all_features

    class Seen(Exception):
        pass

    def seen(train, validation, names, spec):
        raise Seen(names, spec, set(names) - set(train.columns))

    monkeypatch.setattr(queries.hurdle, "train_hurdle", seen)
    with pytest.raises(Seen) as found:
        QUERIES["hurdle_gbt"](spark, FOLDER)
    assert found.value.args == (all_features(), queries.hurdle.HurdleSpec(), set())


def test_the_model_query_trains_on_stored_rows(spark, monkeypatch):
    """Neither the feature table's plan nor cached blocks of it are in the driver while the trees grow."""
    from loomcast import queries

    class Seen(Exception):
        pass

    def seen(train, validation, names, spec):
        raise Seen(*(x._jdf.queryExecution().optimizedPlan().toString() for x in (train, validation)))

    monkeypatch.setattr(queries.hurdle, "train_hurdle", seen)
    with pytest.raises(Seen) as found:
        QUERIES["hurdle_gbt"](spark, FOLDER)
    assert all("parquet" in plan and "InMemoryRelation" not in plan and "Window" not in plan for plan in found.value.args)


def test_training_runs_few_tasks_over_small_rows(spark):
    from loomcast.operators import hurdle

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 1000, 1, 100)
    assert hurdle.few_tasks(rows).rdd.getNumPartitions() == cores
    assert hurdle.few_tasks(rows, each=800).rdd.getNumPartitions() == 10 and hurdle.few_tasks(rows, each=8).rdd.getNumPartitions() == 100
    assert hurdle.few_tasks(rows).count() == 1000
