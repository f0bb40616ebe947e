"""Jobs on Spark ML. Every fit and every transform is distributed; the driver holds only what a
fitted model holds (coefficients, centres, trees)."""

from __future__ import annotations

from functools import reduce
from random import Random

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import IDF, PCA, HashingTF, Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.functions.numbers import ratio
from featherloom.operators import isotonic, knn, spectral, textspace
from featherloom.operators.ordered import running
from featherloom.operators.splits import hash_uniform, poisson_count
from featherloom.operators.stats import with_stats
from featherloom.session import materialize


def _assembled(cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error")


def positive(col: str = "probability") -> Column:
    return vector_to_array(col)[1]


# classifiers -----------------------------------------------------------------------------


def logistic_with_medians(cols: list[str], label: str, weight: str | None = None) -> Pipeline:
    """Missing numbers become the column median, then logistic regression."""
    filled = [f"{c}_filled" for c in cols]
    model = LogisticRegression(featuresCol="features", labelCol=label, maxIter=50)
    if weight:
        model = model.setWeightCol(weight)
    return Pipeline(stages=[Imputer(strategy="median", inputCols=cols, outputCols=filled), _assembled(filled), model])


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Row weight n / (2 n_class) for a 0/1 label."""
    d = with_stats(df, name="__s", n=F.count("*"), n1=F.count_if(F.col(label) == 1))
    s = F.col("__s")
    size = F.when(F.col(label) == 1, s["n1"]).otherwise(s["n"] - s["n1"])
    return d.withColumn(out, s["n"] / (2 * size)).drop("__s")


def scaled_logistic(df: DataFrame, cols: list[str], label: str) -> PipelineModel:
    """Standardised columns and class-balanced logistic regression."""
    stages = [_assembled(cols, "raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
              LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=50)]
    return Pipeline(stages=stages).fit(balanced_weights(df, label))


def char_ngrams(text: Column, low: int, high: int) -> Column:
    """All substrings of ``low`` to ``high`` characters."""
    def of_length(n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))

    return F.concat(*[of_length(n) for n in range(low, high + 1)])


def word_classifier(label: str, features: int = 1 << 14) -> Pipeline:
    """TF-IDF over a token column ``grams`` and multinomial logistic regression."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc"),
        HashingTF(inputCol="grams", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label_index", maxIter=20, regParam=1e-4)])


# text clusters ---------------------------------------------------------------------------


def text_clusters(df: DataFrame, key: str, text: str, clusters: int, stop_words: list[str], terms: int = 10_000, seed: int = 1) -> DataFrame:
    """Word 1-2-gram TF-IDF over the ``terms`` most frequent grams, two principal components, Gaussian mixture cluster and its probability."""
    rows, _ = textspace.text_components(df, key, text, 2, stop_words, terms)
    rows = materialize(rows.withColumn("__p", array_to_vector("components")), "components")
    out = GaussianMixture(featuresCol="__p", k=clusters, seed=seed, maxIter=20, predictionCol="cluster").fit(rows).transform(rows)
    return out.select(key, "cluster", F.array_max(vector_to_array("probability")).alias("cluster_probability"))


def neighbour_graph(df: DataFrame, key: str, vector: str, k: int = 5) -> DataFrame:
    """Undirected edges (src, dst, weight) to the k nearest neighbours; nearer ones weigh more."""
    nn = knn.nearest(df, df, key, vector, k, exclude=key)
    return nn.select(F.least(key, "neighbour").alias("src"), F.greatest(key, "neighbour").alias("dst"),
                     (1 / (1 + F.col("distance"))).alias("weight")).groupBy("src", "dst").agg(F.max("weight").alias("weight"))


def graph_clusters(df: DataFrame, key: str, vector: str, clusters: int, k: int = 5, seed: int = 1) -> DataFrame:
    """Spectral clusters of the k-nearest-neighbour graph: k-means over the leading eigenvectors of the normalised graph, scaled by degree."""
    rows, values = spectral.leading_eigenvectors(neighbour_graph(df, key, vector, k), clusters)
    if len(values) == 0:
        return rows.select(F.col("id").alias(key), F.lit(None).cast("int").alias("cluster"))
    rows = materialize(rows.select("id", array_to_vector(F.transform("vector", lambda v: v / F.sqrt("degree"))).alias("__v")), "spectral")
    model = KMeans(featuresCol="__v", predictionCol="cluster", k=clusters, seed=seed, maxIter=30).fit(rows)
    return model.transform(rows).select(F.col("id").alias(key), "cluster")


def principal_components(df: DataFrame, cols: list[str], k: int, prefix: str = "pca") -> DataFrame:
    """Scores on the first k components of the standardised columns; missing values count as 0, and each
    component's largest loading is positive."""
    d = df.fillna(0, subset=cols)
    stages = [_assembled(cols, "__raw"), StandardScaler(inputCol="__raw", outputCol="__z", withMean=True), PCA(k=k, inputCol="__z", outputCol="__p")]
    model = Pipeline(stages=stages).fit(d)
    loadings = model.stages[-1].pc.toArray()  # len(cols) x k
    signs = [1.0 if max(loadings[:, i], key=abs) >= 0 else -1.0 for i in range(k)]
    scores = vector_to_array("__p")
    return model.transform(d).withColumns({f"{prefix}_{i}": scores[i] * signs[i] for i in range(k)}).drop("__raw", "__z", "__p")


def cluster_profile(df: DataFrame, cols: list[str], clusters: int, seed: int = 1) -> DataFrame:
    """k-means clusters of (error) rows: size and column means."""
    model = Pipeline(stages=[_assembled(cols, "__v"), StandardScaler(inputCol="__v", outputCol="__z", withMean=True),
                             KMeans(featuresCol="__z", predictionCol="cluster", k=clusters, seed=seed, maxIter=20)]).fit(df)
    return model.transform(df).groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


# base models and ensembles -----------------------------------------------------------------


def regressors(label: str, depth: int = 5, trees: int = 20, seed: int = 1) -> dict[str, Estimator]:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "ridge": LinearRegression(**common, regParam=1.0, elasticNetParam=0.0), "lasso": LinearRegression(**common, regParam=1.0, elasticNetParam=1.0, maxIter=50),
        "elastic_net": LinearRegression(**common, regParam=1.0, elasticNetParam=0.5, maxIter=50),
        "forest": RandomForestRegressor(**common, numTrees=trees, maxDepth=depth, seed=seed), "boosted": GBTRegressor(**common, maxIter=trees, maxDepth=depth, seed=seed)}


def classifiers(label: str, depth: int = 5, trees: int = 20, seed: int = 1) -> dict[str, Estimator]:
    common = {"featuresCol": "features", "labelCol": label}
    return {"svm": LinearSVC(**common, maxIter=20, regParam=0.01), "forest": RandomForestClassifier(**common, numTrees=trees, maxDepth=depth, seed=seed),
            "boosted": GBTClassifier(**common, maxIter=trees, maxDepth=depth, seed=seed)}


def fit_on(cols: list[str], model: Estimator, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=[_assembled(cols, model.getOrDefault(model.featuresCol)), model]).fit(df)


BINS = 32  # Spark's default for trees


def tree_cells(df: DataFrame, cols: list[str], label: str, bins: int = BINS) -> DataFrame:
    """All rows of ``df`` as cells of equal binned features, at most twice ``bins`` to the power of columns however many rows there are.

    A column with more than twice ``bins`` values is cut at its quantiles, as Spark's trees do. Columns: per feature the lower edge of the
    bin, the mean label, ``n`` (rows), ``__s`` and ``__ss`` (sums of the label and its square). The squares inside a cell do not depend on
    a split, so regression trees weighted by ``n`` gain the same by a split as on the rows. A forest's bags draw cells, not rows.
    """
    known = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    shares = [i / bins for i in range(1, bins)]
    wide = [c for c in cols if known[c] > 2 * bins]
    edges = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in wide]).first() if wide else {}

    def low(c: str) -> Column:
        if c not in wide:
            return F.col(c).cast("double")
        cuts = F.array(*[F.lit(float(x)) for x in sorted(set(edges[c]))])
        return F.when(F.col(c).isNotNull(), F.coalesce(F.array_max(F.filter(cuts, lambda x: x <= F.col(c))), F.lit(float(min(edges[c])) - 1.0)))

    y = F.col(label).cast("double")
    sums = df.groupBy(*[low(c).alias(c) for c in cols]).agg(F.count(label).cast("double").alias("n"), F.sum(y).alias("__s"), F.sum(y * y).alias("__ss"))
    return sums.where("n > 0").withColumn(label, F.col("__s") / F.col("n"))


def rmse_of_cells(cells: DataFrame, guess: Column) -> Column:
    """Root mean squared error over all rows in the cells, one guess a cell."""
    mean = F.col("__s") / F.col("n")
    inside = F.greatest(F.col("__ss") - F.col("__s") * mean, F.lit(0.0))
    return F.sqrt(F.sum(inside + F.col("n") * (mean - guess) * (mean - guess)) / F.sum("n"))


def _mean(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols]) / len(cols)


def feature_subset_bagging(train: DataFrame, df: DataFrame, cols: list[str], label: str, models: int = 14, share: float = 0.78,
                           seed: int = 1, out: str = "score") -> DataFrame:
    """Mean score of models that each see a random subset of the columns."""
    rng, size, d, names = Random(seed), max(1, round(len(cols) * share)), df, []
    for i in range(models):
        model = fit_on(sorted(rng.sample(cols, size)), LogisticRegression(featuresCol="__f", labelCol=label, probabilityCol="__p", rawPredictionCol="__r", predictionCol="__y", maxIter=20), train)
        names.append(f"__s{i}")
        d = model.transform(d).withColumn(names[-1], positive("__p")).drop("__f", "__p", "__r", "__y")
    return d.withColumn(out, _mean(names)).drop(*names)


def bootstrap_bagging(train: DataFrame, df: DataFrame, key: str, cols: list[str], label: str, models: int = 5, seed: int = 1, out: str = "score",
                      base: Estimator | None = None) -> DataFrame:
    """Mean score of models fitted on bootstrap samples; a sample is a weight column, so no row is copied.

    ``base`` is any estimator that takes weights (default: logistic regression, whose score is the probability of class 1).
    """
    base = base or LogisticRegression(maxIter=20)
    own = {base.featuresCol: "__f", base.labelCol: label, base.weightCol: "__w", base.predictionCol: "__y"}
    extra = [c for c in ("probabilityCol", "rawPredictionCol") if base.hasParam(c)]
    own |= {base.getParam(c): f"__{c}" for c in extra}
    score = positive("__probabilityCol") if extra else F.col("__y")
    d, names = df, []
    for i in range(models):
        sample = train.withColumn("__w", poisson_count([key], seed + i).cast("double")).where("__w > 0")
        model = fit_on(cols, base.copy(own), sample)
        names.append(f"__s{i}")
        d = model.transform(d).withColumn(names[-1], score).drop("__f", "__y", *[f"__{c}" for c in extra])
    return d.withColumn(out, _mean(names)).drop(*names)


def out_of_fold(df: DataFrame, cols: list[str], model: Estimator, fold: str, folds: int, score: Column, out: str) -> DataFrame:
    """Each row scored by a model that did not see its fold."""
    parts = []
    for i in range(folds):
        fitted = fit_on(cols, model, df.where(F.col(fold) != i))
        parts.append(fitted.transform(df.where(F.col(fold) == i)).withColumn(out, score).select(*df.columns, out))
    return reduce(DataFrame.unionByName, parts)


def stack(df: DataFrame, cols: list[str], models: dict[str, Estimator], label: str, fold: str, folds: int) -> DataFrame:
    """Out-of-fold scores of every base model, and a logistic meta-model over them."""
    d = df
    for name, model in models.items():
        # written out, or every later model would score all earlier ones again
        d = materialize(out_of_fold(d, cols, model, fold, folds, positive(), f"oof_{name}"), "out-of-fold")
    names = [f"oof_{n}" for n in models]
    meta = LogisticRegression(featuresCol="__m", labelCol=label, probabilityCol="__p", rawPredictionCol="__r", predictionCol="__y")
    return fit_on(names, meta, d).transform(d).withColumn("meta", positive("__p")).select(*d.columns, "meta")


def soft_vote(df: DataFrame, cols: list[str], out: str = "vote", weights: list[float] | None = None) -> DataFrame:
    """Weighted mean of the models' probabilities; a model without a score for a row has no say in it."""
    w = weights or [1.0] * len(cols)
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c) * x, F.lit(0.0)) for c, x in zip(cols, w)])
    said = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), x).otherwise(0.0) for c, x in zip(cols, w)])
    return df.withColumn(out, ratio(total, said))


def knn_out_of_fold(df: DataFrame, key: str, vector: str, label: str, fold: str, k: int = 5, out: str = "guess") -> DataFrame:
    """Mean label of the k nearest rows of other folds."""
    near = knn.nearest(df, df, key, vector, k, exclude=fold)
    mean = knn.with_neighbour_values(near, df, key, [label]).groupBy(key).agg(F.avg(f"n_{label}").alias(out))
    return df.join(mean, key, "left")


def calibrate(df: DataFrame, score: str, label: str, out: str = "calibrated") -> DataFrame:
    """Isotonic mapping of a score to a probability, fitted on the rows themselves (see :func:`isotonic.out_of_fold`)."""
    return isotonic.predict(isotonic.fit(df, score, label), df, score, out)


def segmented(df: DataFrame, rule: Column, cols: list[str], label: str, model: Estimator, score: Column, out: str = "score") -> DataFrame:
    """One model per side of a rule; the scores of both sides in one table."""
    sides = [df.where(rule), df.where(~F.coalesce(rule, F.lit(False)))]
    return reduce(DataFrame.unionByName, [fit_on(cols, model, s).transform(s).withColumn(out, score).select(*df.columns, out) for s in sides])


def bagged_sample(df: DataFrame, key: str, cols: list[str], row_share: float, column_share: float, seed: int) -> DataFrame:
    """A random share of the rows and of the feature columns."""
    chosen = sorted(Random(seed).sample(cols, max(1, int(len(cols) * column_share))), key=cols.index)
    return df.where(hash_uniform([key], seed) < row_share).select(key, *chosen)


# split search ----------------------------------------------------------------------------


def _impurity(kind: str, n: Column, parts: list[Column]) -> Column:
    if kind == "mse":
        mean = ratio(parts[0], n)
        return ratio(parts[1], n) - mean * mean
    shares = [ratio(p, n) for p in parts]
    if kind == "gini":
        return F.lit(1.0) - reduce(lambda a, b: a + b, [s * s for s in shares])
    return -reduce(lambda a, b: a + b, [s * F.ln(s + F.lit(1e-6)) for s in shares])


def impurity(df: DataFrame, label: str, kind: str, classes: list | None = None) -> DataFrame:
    """Impurity of a label column; entropy adds 1e-6 inside the logarithm."""
    return df.agg(_impurity(kind, F.count(label).cast("double"), _parts(label, kind, classes or [])).alias("impurity"))


def _parts(label: str, kind: str, classes: list) -> list[Column]:
    y = F.col(label).cast("double")
    if kind == "mse":
        return [F.sum(y), F.sum(y * y)]
    return [F.sum((F.col(label) == c).cast("double")) for c in classes]


def best_splits(df: DataFrame, features: list[str], label: str, kind: str = "gini", classes: list | None = None) -> DataFrame:
    """Per numeric feature, the threshold with the largest impurity drop (ties: the lowest threshold).

    All features are searched in one pass: equal values are counted first, and running sums give both
    sides of every threshold, which lies halfway between neighbouring values.
    """
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])
    long = df.select(label, F.inline(cells)).where(F.col("x").isNotNull())
    parts = _parts(label, kind, classes or [])
    names = [f"p{i}" for i in range(len(parts))]
    counts = long.groupBy("feature", "x").agg(F.count(F.lit(1)).cast("double").alias("n"), *[p.alias(c) for p, c in zip(parts, names)])
    aggs = {f"l_{c}": ("sum", F.col(c)) for c in ["n", *names]} | {"prev": ("max", F.col("x"))}
    d = running(counts, ["feature"], ["x"], aggs, exclusive=True, totals=True).where(F.col("prev").isNotNull())
    n, left = F.col("l_n_total"), F.col("l_n")
    if kind == "mse":
        # the drop is the variance between the two sides; as a difference of two variances a small one would be lost in their rounding
        gap = F.col("l_p0") / left - (F.col("l_p0_total") - F.col("l_p0")) / (n - left)
        gain = left / n * ((n - left) / n) * gap * gap
    else:
        rest = [F.col(f"l_{c}_total") - F.col(f"l_{c}") for c in names]
        gain = (_impurity(kind, n, [F.col(f"l_{c}_total") for c in names])
                - left / n * _impurity(kind, left, [F.col(f"l_{c}") for c in names]) - (n - left) / n * _impurity(kind, n - left, rest))
    d = d.select("feature", ((F.col("prev") + F.col("x")) / 2).alias("threshold"), gain.alias("gain"))
    return d.groupBy("feature").agg(F.min_by("threshold", F.struct(-F.round("gain", 12), F.col("threshold"))).alias("threshold"), F.max("gain").alias("gain"))
