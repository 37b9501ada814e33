"""Tree growth: training sets, quantile lines for each species, prediction, scores, mature width."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenlake.operators import linkage
from greenlake.sources.scratch import written

# Quantiles, bounds of measures, head starts of nursery sizes in years, and mature age labels.
QUANTILES = (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))
MOST = {"width_m": 30.0, "height_m": 50.0, "dbh_cm": 500.0}
SIZE_YEARS = {"S": 0, "M": 5, "L": 10}
MATURE = ("mature", "over mature", "over-mature", "overmature")
FEWEST = 30
TARGETS = ("canopy_m2", "height_m", "dbh_cm")
LINES = "species string, target string, n int, p10_a double, p10_b double, p50_a double, p50_b double, p90_a double, p90_b double, max_age double"


def training_set(trees: DataFrame) -> DataFrame:
    """Trees with a species, an age and a crown width that can teach growth; species with at least 30 of them."""
    x = trees.where("species is not null and year_planted is not null and observed_on is not null and canopy_width_m is not null")
    x = x.withColumns({"age": F.year("observed_on") - F.col("year_planted"), "width_m": F.col("canopy_width_m").cast("double")})
    x = x.where(~F.col("species").rlike(r" sp\.$|^to define$"))
    x = x.where(~((F.col("width_m") == 1) & F.col("height_m").isNull() & F.col("dbh_cm").isNull()))
    x = x.where((F.col("year_planted") >= 1950) & (F.col("age") >= 0) & (F.col("width_m") > 0) & (F.col("width_m") <= MOST["width_m"]))
    x = x.withColumn("canopy_m2", F.pi() * (F.col("width_m") / 2) ** 2)
    return enough(x)


def fit_all_lines(train: DataFrame, cells: int = 64) -> DataFrame:
    """Lines of every target that the table has."""
    return reduce(DataFrame.unionByName, (fit_lines(train, t, cells) for t in TARGETS if t in train.columns))


def enough(x: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """Rows of species with enough rows, counted and joined back."""
    n = x.groupBy("species").agg(F.count("*").alias("_n")).where(F.col("_n") >= fewest)
    return x.join(n.select("species"), "species", "left_semi")


def polygon_training_set(hits: DataFrame) -> DataFrame:
    """Lone trees with their canopy polygon's area: planted 2003 to 2020, three years old or more in 2021."""
    x = hits.withColumn("age", 2021 - F.col("year_planted")).where(F.col("year_planted").between(2003, 2020) & (F.col("age") >= 3))
    return enough(x.where((F.col("area_m2") > 0) & (F.col("area_m2") <= 200)))


def split(df: DataFrame, id_col: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """``df`` with is_train: the first ``share`` of each species in an order set by a hash of the id, then by id.

    The hash is cut into ranges that are counted first; only the range in which a species' share ends is ranked, so
    no species is gathered.
    """
    ranges = 4096
    x = df.withColumn("_b", F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(ranges)).cast("int"))
    n = x.groupBy("species", "_b").agg(F.count("*").alias("_n"))
    up = Window.partitionBy("species").orderBy("_b")  # over counts, ``ranges`` rows at most
    n = n.withColumns({"_to": F.sum("_n").over(up), "_all": F.sum("_n").over(Window.partitionBy("species"))})
    n = n.withColumn("_room", F.ceil(F.col("_all") * share) - (F.col("_to") - F.col("_n"))).select("species", "_b", "_n", "_room")
    x = x.join(n, ["species", "_b"])
    at_end = (F.col("_room") > 0) & (F.col("_room") < F.col("_n"))
    rank = F.row_number().over(Window.partitionBy("species", "_b").orderBy(F.xxhash64(id_col, F.lit(seed)), id_col))
    return x.withColumn("is_train", F.when(at_end, rank <= F.col("_room")).otherwise(F.col("_room") > 0)).drop("_b", "_n", "_room")


def fit_lines(train: DataFrame, target: str, cells: int = 64) -> DataFrame:
    """Lines ln(target) = a + b ln(age + 1) at p10, p50 and p90 for each species that has 30 rows or more.

    Ages are whole years, so a species' rows are first counted by age and by value in ``1/cells`` of a unit of
    ln(target); a group then holds a bounded table of weighted points however many trees it has. Species
    whose lines do not all grow, or cross at some age in the data, get none.
    """
    bound = MOST.get(target, float("inf"))
    oldest = train.agg(F.max("age").alias("_oldest"))
    x = train.where((F.col(target) > 0) & (F.col(target) <= bound)).withColumn("y", F.round(F.log(F.col(target).cast("double")) * cells) / cells)
    points = x.groupBy("species", "age", "y").agg(F.count("*").alias("n")).join(F.broadcast(oldest), F.lit(True))

    def fit(df: pd.DataFrame) -> pd.DataFrame:
        n = df["n"].to_numpy()
        if n.sum() < FEWEST:
            return pd.DataFrame(columns=[c.split()[0] for c in LINES.split(", ")])
        x, y = np.log1p(df["age"].to_numpy(float)), df["y"].to_numpy(float)
        lines = {name: _weighted_line(x, y, n, q) for name, q in QUANTILES}
        grid = np.log1p(np.arange(0, df["_oldest"].iloc[0] + 1))
        low, mid, high = (lines[k][0] + lines[k][1] * grid for k, _ in QUANTILES)
        if not (all(b > 1e-3 for _, b in lines.values()) and np.all(low <= mid) and np.all(mid <= high)):
            return pd.DataFrame(columns=[c.split()[0] for c in LINES.split(", ")])
        row = {"species": df["species"].iloc[0], "target": target, "n": int(n.sum()), "max_age": float(df["age"].max())}
        return pd.DataFrame([row | {f"{k}_{p}": v for k, ab in lines.items() for p, v in zip("ab", ab)}])[[c.split()[0] for c in LINES.split(", ")]]

    return points.groupBy("species").applyInPandas(fit, LINES)


def _weighted_line(x: np.ndarray, y: np.ndarray, n: np.ndarray, q: float, rounds: int = 300) -> tuple[float, float]:
    """Intercept and slope that minimise the pinball loss of counted points, by iteratively reweighted least squares."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.linalg.lstsq(a * np.sqrt(n)[:, None], y * np.sqrt(n), rcond=None)[0]
    for _ in range(rounds):
        r = y - a @ b
        aw = a * (n * np.where(r > 0, q, 1 - q) / np.maximum(np.abs(r), 1e-6))[:, None]
        new = np.linalg.solve(a.T @ aw + 1e-9 * np.eye(2), aw.T @ y)
        if np.max(np.abs(new - b)) < 1e-9:
            return float(new[0]), float(new[1])
        b = new
    return float(b[0]), float(b[1])


def predict(requests: DataFrame, lines: DataFrame) -> DataFrame:
    """Ranges of crown area and width, height and trunk for requests of species, years, and a size or a start width.

    Species meet their lines whatever their case. A target without a line is null; the crown's width is the
    diameter of its area. ``status`` says why a request has no answer: unknown species, bad years, not exactly one
    of size and width, or an age beyond the training range.
    """
    key = F.lower(F.trim("species"))
    named = lines.withColumn("_key", key).drop("species", "n")
    crown = named.where("target = 'canopy_m2'").select("_key", "max_age", F.col("p50_a").alias("_a"), F.col("p50_b").alias("_b"))
    r = requests.withColumns({"species": key, "_key": key}).join(crown, "_key", "left")
    start = F.when(F.upper("size") == "S", 0.0).when(F.upper("size") == "M", 5.0).when(F.upper("size") == "L", 10.0)
    t = (math.log(math.pi / 4) + 2 * F.log("start_width_m") - F.col("_a")) / F.col("_b")
    age0 = F.when(F.col("size").isNotNull(), start).otherwise(F.greatest(F.lit(0.0), F.expm1(F.least(t, F.lit(50.0)))))
    age = age0 + F.col("years")
    status = (
        F.when(F.col("_a").isNull(), "unknown_species").when(~F.coalesce((F.col("years") >= 0) & ~F.isnan("years"), F.lit(False)), "bad_years")
        .when(F.col("size").isNull() == F.col("start_width_m").isNull(), "not_one_of_size_and_width")
        .when(F.col("size").isNotNull() & start.isNull(), "unknown_size").when((F.col("start_width_m") <= 0) | F.isnan("start_width_m"), "bad_start_width")
        .when(age > F.col("max_age"), "beyond_training_ages").otherwise("ok")
    )
    r = r.withColumns({"status": status, "age": F.when(status == "ok", age)}).drop("_a", "_b", "max_age")
    out = r
    for target in TARGETS:
        own = named.where(F.col("target") == target).drop("target", "max_age")
        at = {k: F.exp(F.col(f"{k}_a") + F.col(f"{k}_b") * F.log1p(F.col("age"))) for k, _ in QUANTILES}
        told = {f"{target}_{k}": F.round(v, 1) for k, v in at.items()}
        if target == "canopy_m2":
            told |= {f"crown_width_m_{k}": F.round(2 * F.sqrt(v / math.pi), 1) for k, v in at.items()}
        out = out.join(own, "_key", "left").withColumns(told).drop(*own.columns[:-1])
    return out.withColumn("age", F.round("age", 1)).drop("_key")


def pinball(y, predicted, q: float) -> Column:
    d = F.col(y) - F.col(predicted)
    return F.avg(F.greatest(q * d, (q - 1) * d))


def scores(df: DataFrame, y: str, *by: str) -> DataFrame:
    """Pinball losses, coverage of p10 to p90, R2 and mean absolute error of predictions p10, p50 and p90."""
    err = F.col(y) - F.col("p50")
    return df.groupBy(*by).agg(
        *(pinball(y, k, q).alias(f"pinball_{k}") for k, q in QUANTILES),
        F.avg(((F.col(y) >= F.col("p10") - 1e-4) & (F.col(y) <= F.col("p90") + 1e-4)).cast("double")).alias("coverage"),
        F.avg(F.abs(err)).alias("mae"), (1 - F.sum(err * err) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))).alias("r2"),
    )


def mature_rows(trees: DataFrame) -> DataFrame:
    """One row for each mature tree with a plausible crown, its species by the first name it has."""
    pos = lambda c: F.when((F.col(c) > 0) & ~F.isnan(c), F.col(c).cast("double"))
    name = F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in ("scientific_name", "common_name") if c in trees.columns))
    x = trees.withColumns({"width_m": pos("canopy_width_m"), "height_m": pos("height_m"), "dbh_cm": pos("dbh_cm"), "species": name})
    x = x.where(F.lower(F.trim("age_description")).isin(*MATURE)).where("width_m <= 50 and species is not null and (height_m is not null or dbh_cm is not null)")
    x = x.where("coalesce(height_m, 0) <= 80 and coalesce(dbh_cm, 0) <= 500")
    return x.groupBy("source_tree_id").agg(F.min_by(F.struct("species", "width_m", "height_m", "dbh_cm"), "row_number").alias("r")).select("source_tree_id", "r.*")


def mature_width_model(rows: DataFrame, features: list[str], iterations: int = 40, seed: int = 42):
    """A boosted-tree model of mature crown width with its scores: R2 on seen species, and on species held out whole.

    Trained by MLlib over all rows; species are split by hash, and rows within seen species by hash of the id. Of the rows that train it, a
    fifth are a validation part of their own: boosting stops where a further tree no longer lowers their error, ``iterations`` at most.
    ``trees`` tells how many there are; a score is null where its part has no rows. Rows of a part with the same species and measures are
    one point of their number's weight, so what boosting goes over again and again grows with different trees, not with their copies.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import Imputer, StringIndexerModel, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    unseen = F.pmod(F.xxhash64("species", F.lit(seed)), F.lit(10)) == 0
    part = F.pmod(F.xxhash64("source_tree_id", F.lit(seed)), F.lit(5))
    points = rows.groupBy("species", *features, "width_m", unseen.alias("_unseen"), part.alias("_part")).agg(F.count("*").cast("double").alias("_weight"))
    points = written(points, "width-points")
    seen = points.where("not _unseen")
    kinds = seen.select("species").distinct().count()
    train = seen.where("_part != 0").withColumn("_validation", F.col("_part") == 1)
    # Labels as the indexer orders them, by rows and then by name; and for the imputer one row that holds the means of all.
    labels = [r[0] for r in train.where("species is not null").groupBy("species").agg(F.sum("_weight").alias("n")).orderBy(F.desc("n"), "species").select("species").collect()]
    known = lambda f: F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    means = train.agg(*((F.sum(F.when(known(f), F.col(f) * F.col("_weight"))) / F.sum(F.when(known(f), F.col("_weight")))).alias(f) for f in features))
    stages = [
        StringIndexerModel.from_labels(labels, inputCol="species", outputCol="_species", handleInvalid="keep"),
        Imputer(inputCols=features, outputCols=[f"_{f}" for f in features]).fit(means),
        VectorAssembler(inputCols=["_species", *(f"_{f}" for f in features)], outputCol="features"),
        GBTRegressor(labelCol="width_m", weightCol="_weight", maxIter=iterations, maxDepth=5, maxBins=max(32, kinds + 2), seed=seed, validationIndicatorCol="_validation", validationTol=0.001),
    ]
    model = Pipeline(stages=stages).fit(train)
    score = RegressionEvaluator(labelCol="width_m", metricName="r2", weightCol="_weight")
    of = lambda x: None if x.isEmpty() else score.evaluate(model.transform(x))
    return model, {"seen_r2": of(seen.where("_part = 0")), "unseen_r2": of(points.where("_unseen")), "trees": model.stages[-1].getNumTrees}


def added_area(current, mature) -> Column:
    """Crown area that a tree still gains, never below 0."""
    area = lambda w: F.pi() * (w / 2) ** 2
    return F.greatest(F.lit(0.0), area(F.col(mature)) - area(F.col(current)))


def fill_from_profile(requests: DataFrame, trees: DataFrame, values: list[str]) -> DataFrame:
    """Requests by species with each missing value filled by the median of that species' trees, and which were filled."""
    key = F.lower(F.trim("species"))
    medians = trees.groupBy(key.alias("_key")).agg(*(F.percentile(v, F.lit(0.5)).alias(f"_{v}") for v in values))
    x = requests.withColumn("_key", key).join(medians, "_key", "left")
    filled = F.array_compact(F.array(*(F.when(F.col(v).isNull() & F.col(f"_{v}").isNotNull(), F.lit(v)) for v in values)))
    x = x.withColumn("filled", F.array_join(filled, ","))
    return x.withColumns({v: F.coalesce(v, f"_{v}") for v in values}).drop("_key", *(f"_{v}" for v in values))


def name_suggestions(requests: DataFrame, names: DataFrame, limit: int = 5, least: float = 0.6) -> DataFrame:
    """Known names like each request: equal first, then by edit distance."""
    r = requests.select("request_id", F.lower(F.trim("request")).alias("_r"))
    near = linkage.similar_names(r.select("_r"), names.select(F.lower(F.trim("name"))), least)
    x = r.join(near, F.col("_r") == F.col("left")).select("request_id", F.col("right").alias("name"), "similarity")
    w = Window.partitionBy("request_id").orderBy(F.desc("similarity"), "name")
    return x.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).select("request_id", "name", "similarity", "rank")
