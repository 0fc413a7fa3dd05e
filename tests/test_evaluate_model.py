import datetime
import random

import numpy as np
import pytest

from tallyline.contracts import ContractError
from tallyline.operators import evaluate, model, sketches
from tallyline.operators.quantiles import exact_quantiles
from tallyline.schemas import MODEL_FEATURES, UNCERTAINTY_COLUMNS

DAY = datetime.date(2025, 4, 1)


def results(frame, pairs, sds=None):
    rows = [
        dict(strikeouts=float(y), predicted_strikeouts=float(p), strikeouts_stddev_last10=s)
        for (y, p), s in zip(pairs, sds or [None] * len(pairs), strict=True)
    ]
    df = frame(rows, "strikeouts double, predicted_strikeouts double, strikeouts_stddev_last10 double")
    return evaluate.prediction_results(df)


def test_metrics_against_numpy(frame):
    rng = random.Random(2)
    pairs = [(rng.randrange(12), rng.random() * 10) for _ in range(200)]
    got = evaluate.regression_metrics(results(frame, pairs)).first()
    e = np.array([p - y for y, p in pairs])
    assert got.mae == pytest.approx(np.abs(e).mean()) and got.rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert got.bias == pytest.approx(e.mean())
    assert got.abs_error_p75 == pytest.approx(np.quantile(np.abs(e), 0.75))
    assert got.abs_error_p90 == pytest.approx(np.quantile(np.abs(e), 0.9))


@pytest.mark.parametrize("kind", ["spread", "ties", "heavy"])
def test_exact_quantiles_by_bracketing(spark, kind):
    rng = random.Random(7)
    draw = {
        "spread": lambda: rng.gauss(0, 1),
        "ties": lambda: float(rng.randrange(5)),
        "heavy": lambda: rng.paretovariate(0.5),
    }[kind]
    data = [draw() for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "x double")
    probabilities = [0.0, 0.25, 0.5, 0.8, 0.9, 1.0]
    got = exact_quantiles(df, "x", probabilities, max_rows=300)
    assert got == pytest.approx(list(np.quantile(data, probabilities)))


def test_interval_fit(frame):
    pairs = [(5, 6), (5, 4), (5, 7), (5, 5.5), (5, 9)]
    got = evaluate.fit_intervals(results(frame, pairs, [1.0, 2.0, 1.0, None, 0.0]))
    assert got["calibration_rows"] == 3
    assert got["interval_multiplier"] == pytest.approx(np.quantile([1.0, 0.5, 2.0], 0.8))
    none = evaluate.fit_intervals(results(frame, pairs, [0.0] * 5))
    assert (none["interval_multiplier"], none["calibration_rows"]) == (1.0, 0)


def test_intervals(frame):
    df = frame([dict(predicted_strikeouts=6.8, strikeouts_stddev_last10=1.25)],
               "predicted_strikeouts double, strikeouts_stddev_last10 double")
    plain = evaluate.apply_intervals(evaluate.add_base_uncertainty(df))
    row = plain.first()
    assert (row.lower_bound, row.upper_bound) == (pytest.approx(5.55), pytest.approx(8.05))
    config = {"interval_multiplier": 1.6, "nominal_coverage": 0.8}
    once = evaluate.apply_intervals(plain, config)
    for df in (once, evaluate.apply_intervals(once, config)):
        row = df.first()
        assert (row.lower_bound, row.upper_bound) == (pytest.approx(4.8), pytest.approx(8.8))
        assert row.interval_coverage_target == 0.8
    meta = evaluate.apply_metadata_intervals(plain, {"uncertainty_model": config}).first()
    assert meta.std_dev == pytest.approx(2.0)
    assert evaluate.apply_metadata_intervals(plain, {}) is plain


def test_coverage_and_buckets(frame):
    df = results(frame, [(6, 5), (5, 5), (9, 5), (1, 8), (4, 4.5)], [1.0] * 5)
    got = evaluate.interval_coverage(df).first()
    assert (got.empirical_coverage, got.miss_rate_above_upper_bound, got.miss_rate_below_lower_bound) == (0.6, 0.2, 0.2)
    assert got.mean_half_width == 1.0 and got.rows == 5
    buckets = [(r.error_bucket, r.rows) for r in evaluate.error_buckets(df).collect()]
    assert buckets == [("<=4.5", 1), ("4.5-5.5", 3), ("7.5+", 1)]


def table(spark, n=400):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        features = [rng.random() for _ in MODEL_FEATURES]
        label = 3 * features[0] + 2 * features[5] + rng.random() / 10
        rows.append((DAY + datetime.timedelta(days=i), i, i % 20, f"N{i % 20}", label, *features, 1.0, None, 2.0))
    ddl = "game_date date, game_pk long, pitcher long, player_name string, strikeouts double, " + ", ".join(
        f"{c} double" for c in (*MODEL_FEATURES, *UNCERTAINTY_COLUMNS)
    )
    return spark.createDataFrame(rows, ddl)


def test_model_table_columns_and_missing(spark):
    df = table(spark, 3)
    got = model.model_table(df.withColumn("extra", df.game_pk))
    assert got.columns == [*model.ID_COLUMNS, "strikeouts", *MODEL_FEATURES, *UNCERTAINTY_COLUMNS]
    assert got.count() == 3
    from pyspark.sql import functions as F

    broken = df.withColumn("k_rate_last10", F.when(df.game_pk == 0, F.lit(float("inf"))).otherwise(F.lit(1.0)))
    assert model.model_table(broken).count() == 2


def test_split_needs_both_sides(spark):
    with pytest.raises(ContractError):
        model.time_split(table(spark, 3), "2030-01-01")
    train, test = model.time_split(table(spark, 10), "2025-04-05")
    assert (train.count(), test.count()) == (4, 6)


def test_training_learns(spark):
    train, test = model.time_split(table(spark), "2026-01-01")
    fitted = model.train_model(train, params=model.BoostParams(rounds=30, step_size=0.2))
    scored = evaluate.prediction_results(model.score(fitted, test))
    mean = train.agg({"strikeouts": "avg"}).first()[0]
    rows = scored.collect()
    baseline = sum(abs(r.actual_strikeouts - mean) for r in rows)
    assert sum(r.abs_error for r in rows) < baseline / 2
    assert model.feature_importance(fitted).first().feature == MODEL_FEATURES[0]
    assert model.score_latest(fitted, table(spark)).count() == 20


def test_error_by_round(spark):
    train, test = model.time_split(table(spark), "2026-01-01")
    fitted = model.train_model(train, params=model.BoostParams(rounds=12, step_size=0.2))
    got = model.error_by_round(fitted, {"train": train, "test": test, "none": test.limit(0)}).collect()
    assert [r["round"] for r in got] == list(range(1, 13)) and {r["none"] for r in got} == {None}
    for name, rows in (("train", train), ("test", test)):
        scored = evaluate.prediction_results(model.score(fitted, rows))
        assert got[-1][name] == pytest.approx(evaluate.regression_metrics(scored).first().rmse)
        assert got[0][name] > got[-1][name]
    tree = fitted.stages[-1].trees[0]
    rows = fitted.stages[0].transform(test).select("features", "strikeouts").collect()
    errors = [(tree.predict(r["features"]) - r["strikeouts"]) ** 2 for r in rows]
    assert got[0]["test"] == pytest.approx(np.sqrt(np.mean(errors)))


def test_early_stopping(spark):
    """Labels without a pattern: the held-out error stops falling, and boosting with it."""
    from pyspark.sql import functions as F

    noise = table(spark).withColumn("strikeouts", F.rand(3)).withColumn("held", F.col("game_pk") % 4 == 0)
    params = model.BoostParams(rounds=40, step_size=0.3)
    stopped = model.train_model(noise, params=params, validation="held").stages[-1].getNumTrees
    assert stopped < 40 == model.train_model(noise, params=params).stages[-1].getNumTrees


def test_sketches_of_days_merge_into_any_range(spark):
    rng = random.Random(9)
    data = [(DAY + datetime.timedelta(days=rng.randrange(30)), rng.paretovariate(1.5)) for _ in range(6000)]
    df = spark.createDataFrame([*data, (DAY, None), (None, 1.0), (DAY, float("nan"))], "game_date date, x double")
    stored = sketches.daily_sketches(df, "x")
    for start, end in ((None, None), ("2025-04-05", "2025-04-09"), ("2025-04-30", None)):
        values = sorted(x for d, x in data if (not start or str(d) >= start) and (not end or str(d) <= end))
        got = sketches.range_quantiles(stored.filter("game_date is not null"), (0.05, 0.5, 0.95), start=start, end=end).collect()
        assert {r["n"] for r in got} == {len(values)}
        for r in got:
            rank = np.searchsorted(values, r["quantile"], side="right") / len(values)
            assert abs(rank - r["probability"]) <= 2 * sketches.RANK_ERROR
    assert sketches.range_quantiles(stored, (0.5,), start="2031-01-01").count() == 0
    whole = sketches.rank_shares(df, "x", spark.createDataFrame([(0.5, 2.0), (0.9, 0.0)], "probability double, quantile double"))
    shares = {r["probability"]: (r["below"], r["up_to"]) for r in whole.collect()}
    values = [x for _, x in data] + [1.0, float("inf")]  # NaN sorts above all numbers
    assert shares[0.9] == (0.0, 0.0) and shares[0.5][0] == pytest.approx(sum(v < 2 for v in values) / len(values))
