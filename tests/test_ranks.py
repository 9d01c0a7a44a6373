"""Order statistics against pandas, at several sizes of brackets and numbers of ranges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlake.operators import ranks


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame({
        "id": np.arange(n), "hot": np.where(rng.random(n) < 0.4, 5.0, rng.normal(size=n)),
        "few": rng.integers(0, 4, n).astype(float), "group": rng.choice(["a", "b"], n, p=[0.9, 0.1])})
    pdf.loc[::17, "hot"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("hot", F.nanvl("hot", F.lit(None))).cache()


#: values ordered at once, accuracy of the sketch: the last one misses and is cut again and again
WAYS = [(ranks.INSIDE, ranks.ACCURACY), (40, 100), (40, 1)]


@pytest.mark.parametrize(("inside", "accuracy"), WAYS)
def test_quantiles(frame, inside, accuracy):
    pdf, df = frame
    found = {(row["name"], row["p"]): row["value"]
             for row in ranks.quantiles(df, ["hot", "few"], [0, 0.25, 0.5, 0.99, 1], inside=inside, accuracy=accuracy).collect()}
    for (name, p), value in found.items():
        assert value == pytest.approx(pdf[name].quantile(p))
    assert len(found) == 10


@pytest.mark.parametrize(("inside", "accuracy"), WAYS[:2])
def test_quantiles_by_group(frame, inside, accuracy):
    pdf, df = frame
    df = df.withColumn("group", F.when(F.col("group") == "a", "a"))
    rows = ranks.quantiles(df, ["hot", "few"], [0.1, 0.75], by=["group"], inside=inside, accuracy=accuracy).collect()
    assert len(rows) == 8
    for row in rows:
        assert row["value"] == pytest.approx(pdf[pdf["group"] == (row["group"] or "b")][row["name"]].quantile(row["p"]))


@pytest.mark.parametrize("values", [[], [None], [2.0], [1.0, 2.0], [3.0, None, float("nan"), 1.0, 2.0], [5.0] * 9, [1.0] * 5 + [2.0]])
def test_quantiles_of_few_values(spark, values):
    df = spark.createDataFrame([(value,) for value in values], "v double")
    series = pd.Series(values, dtype=float).dropna()
    found = {row["p"]: row["value"] for row in ranks.quantiles(df, ["v"], [0, 0.3, 0.5, 1]).collect()}
    assert found == pytest.approx({p: series.quantile(p) for p in (0, 0.3, 0.5, 1)} if len(series) else {})


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_percentile_rank(spark, frame, parts):
    pdf, df = frame
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = ranks.percentile_rank(df, ["hot", "few"]).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = found.sort_values("id").reset_index(drop=True)
    assert len(found) == len(pdf)
    for name in ("hot", "few"):
        np.testing.assert_allclose(found[f"{name}_percentile"], pdf[name].rank(pct=True), equal_nan=True)


def test_shuffles_do_not_grow_with_the_columns(spark, frame):
    _, df = frame
    wide = df.select("id", *[(F.col("few") + at).alias(f"c{at}") for at in range(12)])

    def exchanges(columns):
        plan = ranks.percentile_rank(wide, columns)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange")
    assert exchanges([f"c{at}" for at in range(12)]) == exchanges(["c0"])


@pytest.mark.parametrize("block", [7, 50, 100_000])
def test_rolling_rows(frame, block):
    pdf, df = frame
    found = ranks.rolling_rows(df.select("id", "few"), "few", ["few", "id"], 7, block).toPandas()
    want = pdf.sort_values(["few", "id"])
    rolled = want["few"].rolling(7, min_periods=1)
    want = want.assign(m=rolled.mean(), s=rolled.std().fillna(0)).sort_values("id")
    found = found.sort_values("id")
    np.testing.assert_allclose(found["few_rolling_mean_7"], want["m"])
    np.testing.assert_allclose(found["few_rolling_std_7"], want["s"], atol=1e-9)


def test_ordered_index(frame):
    pdf, df = frame
    found = ranks.ordered_index(df.select("few", "id"), ["few", "id"]).toPandas().sort_values("_index")
    assert found["_index"].tolist() == list(range(len(pdf)))
    assert found["id"].tolist() == pdf.sort_values(["few", "id"])["id"].tolist()


def test_dense_rank_of_counts(spark):
    stats = spark.createDataFrame([("a", 9), ("b", 4), ("c", 9), ("d", 1)], "k string, n bigint")
    found = {row["k"]: row["r"] for row in ranks.dense_rank_of_counts(stats, "n", "r").collect()}
    assert found == {"a": 1.0, "c": 1.0, "b": 2.0, "d": 3.0}


def test_duplicate_flags(frame):
    pdf, df = frame
    found = ranks.duplicate_flags(df, ["few", "group", "hot"], ["id"]).toPandas().sort_values("id")
    for name in ("few", "group", "hot"):
        assert found[f"{name}_duplicate"].tolist() == pdf[name].duplicated().tolist()


def test_keep_first(frame):
    pdf, df = frame
    found = ranks.keep_first(df, ["few", "group"], ["id"]).toPandas()
    assert sorted(found["id"]) == sorted(pdf.drop_duplicates(["few", "group"])["id"])


def test_split_is_exact_per_label(frame):
    pdf, df = frame
    found = ranks.hash_rank_split(df, "group", F.col("id").cast("string"), 0.8, buckets=16).toPandas()
    assert len(found) == len(pdf)
    for _, part in found.groupby("group"):
        assert part["is_train"].sum() == int(np.ceil(0.8 * len(part)))


def test_correlations_with_gaps(spark):
    from reviewlake.operators.summaries import correlation_matrix
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(500, 12)) + 1e6, columns=[f"c{at}" for at in range(12)])
    pdf["c1"] = pdf["c0"] * 2 + rng.normal(size=500)
    pdf["same"], pdf["none"], pdf["half"] = 0.1, np.nan, np.where(np.arange(500) % 2, 3.3, np.nan)
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    df = spark.createDataFrame(pdf).repartition(7)
    want = pdf.corr()
    rows = correlation_matrix(df).collect()
    assert len(rows) == 15 * 14 // 2
    for row in rows:
        expected = want.loc[row.feature_a, row.feature_b]
        constant = {row.feature_a, row.feature_b} & {"same", "none", "half"}
        assert row.correlation is None if constant else row.correlation == pytest.approx(expected, abs=1e-8)
    assert correlation_matrix(df, ["c0"]).count() == 0
    assert [row.correlation for row in correlation_matrix(df.limit(0), ["c0", "c1"]).collect()] in ([None], [])


def test_a_thousand_columns_plan_in_seconds(spark):
    import time
    from reviewlake.operators.summaries import correlation_matrix
    wide = spark.range(50).select(*[((F.col("id") * (at + 3)) % 17).cast("double").alias(f"c{at}") for at in range(1000)])
    began = time.monotonic()
    assert correlation_matrix(wide, wide.columns).count() == 499_500
    assert time.monotonic() - began < 60


def test_ranks_of_many_columns_are_read_once(spark):
    rows = spark.range(40).select("id", *[F.when(F.col("id") % (at + 2) > 0, (F.col("id") * (at + 3)) % 7).alias(f"c{at}") for at in range(12)])
    columns = [f"c{at}" for at in range(12)]
    ranked = ranks.percentile_rank(rows, columns)
    assert ranked.columns == ["id", *columns, *[f"{name}_percentile" for name in columns]]
    found, plain = ranked.toPandas(), rows.toPandas()
    for name in columns:
        expected = plain.set_index("id")[name].rank(pct=True)
        np.testing.assert_allclose(found.set_index("id")[f"{name}_percentile"].sort_index(), expected)
    # one value for each column and row, not a conditional maximum for each column
    assert "CASE WHEN" not in ranked._jdf.queryExecution().optimizedPlan().toString().split("map_from_entries")[0]


def test_runs_in_small_chunks_and_cells(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": np.arange(900), "many": rng.normal(size=900), "few": rng.integers(0, 4, 900).astype(float),
                        "ends": rng.choice([-np.inf, -0.0, 0.0, 1.5, np.inf], 900), "none": np.nan})
    pdf.loc[::7, ["many", "few"]] = np.nan
    rows = ranks.numbered(spark.createDataFrame(pdf).repartition(5))
    names = ["many", "few", "ends", "none"]
    runs = ranks.Runs(rows, names, chunk=64, cell=40)
    assert runs.cells.count() > 10  # the values of one column lie in several cells
    found = ranks.by_number(rows, runs.ranks()).toPandas().sort_values("id")
    for name in names:
        np.testing.assert_allclose(found[f"{name}_percentile"], pdf[name].rank(pct=True), equal_nan=True)
    quantiles = runs.quantiles([0, 0.25, 0.5, 0.99, 1])
    assert quantiles["none"] == {}
    for p, value in quantiles["many"].items():
        assert value == pytest.approx(pdf["many"].quantile(p))
    assert quantiles["few"] == {p: pdf["few"].quantile(p) for p in (0.0, 0.25, 0.5, 0.99, 1.0)}


def test_only_what_is_needed_is_ordered(spark):
    rows = spark.range(50).select("id", (F.col("id") % 5).alias("v"), F.repeat(F.lit("long text "), 50).alias("text"))
    for found in (ranks.rolling_rows(rows, "v", ["id"]), ranks.percentile_rank(rows, ["v"])):
        lines = found.select("id", "text")._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert "text" in found.columns and not any("text" in line for line in lines if "Window" in line or "MapInArrow" in line)
    # rows meet what was found for them by their number: texts stand in no window
    plan = ranks.rolling_rows(rows, "v", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "text" not in window


def test_chunks_are_rows_that_are_stored_together(spark):
    rows = ranks.numbered(spark.range(400).select("id", (F.col("id") % 9).cast("double").alias("v")))
    mixed = ranks.materialize(rows.orderBy(F.xxhash64("id")).coalesce(1).withColumn("_place", F.monotonically_increasing_id()), "mixed")
    runs = ranks.Runs(mixed, ["v"], chunk=100)
    assert runs.numbers.select("chunk").distinct().count() == runs.pieces.count() <= 7  # one column: a piece for each chunk
    found = ranks.by_number(mixed, runs.ranks()).toPandas()
    np.testing.assert_allclose(found["v_percentile"], found["v"].rank(pct=True))
