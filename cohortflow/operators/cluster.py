"""Patient clustering on measurement rows: pivot, standardise, cluster, project, score, name."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.exprs import clean_double, round_even
from cohortflow.operators import spectral, ward
from cohortflow.operators.relational import require_columns
from cohortflow.session import stage

# functions of this module travel to the Python workers by value, so they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Names of three clusters, ranked by ascending mean score.
RISK_NAMES = ("Low Risk", "Moderate Risk", "High Risk")
SEVERITY_NAMES = ("Low Severity", "Moderate Severity", "High Severity")

MAX_MEASURES = 65_535
SEED = 42
RESTARTS = 10
PARALLEL_FITS = 10


@dataclass(frozen=True)
class ClusterResult:
    """``patients``: one row per person; ``sizes``: rows per cluster; ``explained_variance``: the
    shares of the two components."""

    patients: DataFrame
    sizes: DataFrame
    explained_variance: tuple[float, float]


def person_means(df: DataFrame) -> DataFrame:
    """Mean value per person and measurement name; persons without any value drop out."""
    value = clean_double(df, "value_as_number")
    return (
        df.select("person_id", F.col("measurement_source_value").alias("measure"), value.alias("v"))
        .dropna()
        .groupBy("person_id", "measure")
        .agg(F.avg("v").alias("v"))
    )


def patient_features(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The features that clustering works on (``person_id``, ``z``, ...) and the measures behind ``z``."""
    means = stage(person_means(df), "person-means")
    return _features(means), sorted(r[0] for r in means.select("measure").distinct().collect())


def instrument_scores(df: DataFrame) -> DataFrame:
    """Per person: ham_d_total and psqi_total (sums of means), cdr_score (mean of means)."""
    require_columns(df, ["person_id", "measurement_source_value", "value_as_number"])
    return _instrument_scores(person_means(df))


def _instrument_scores(means: DataFrame) -> DataFrame:
    name, v = F.col("measure").cast("string"), F.col("v")
    # Name parts that mark the three instruments.
    ham_d = name.contains("ham_d")
    psqi = name.contains("psqi") & ~name.contains("cumulative")
    cdr = name.contains("cdr")

    def total(test: Column) -> Column:
        return round_even(F.coalesce(F.sum(F.when(test, v)), F.lit(0.0)), 2)

    return means.groupBy("person_id").agg(
        total(ham_d).alias("ham_d_total"),
        total(psqi).alias("psqi_total"),
        round_even(F.avg(F.when(cdr, v)), 2).alias("cdr_score"),
    )


def range_scores(df: DataFrame) -> DataFrame:
    """Per person: abnormality_score, deficiency_score, out_of_range_count from the row's limits.

    Rows without both limits do not count; a limit of 0 yields no deviation.
    """
    require_columns(df, ["person_id", "value_as_number", "range_low", "range_high"])
    return df.groupBy("person_id").agg(*_range_sums(df))


def _range_sums(df: DataFrame) -> list[Column]:
    v, low, high = (clean_double(df, c) for c in ("value_as_number", "range_low", "range_high"))
    both = low.isNotNull() & high.isNotNull()

    def deviation(amount: Column, limit: Column) -> Column:
        share = F.greatest(F.try_divide(amount, limit), F.lit(0.0))
        return F.when(both & amount.isNotNull() & (limit != 0), share).otherwise(0.0)

    above, below = deviation(v - high, high), deviation(low - v, low)
    outside = (above > 0) | (below > 0)
    return [
        round_even(F.sum(above) * 100, 2).alias("abnormality_score"),
        round_even(F.sum(below) * 100, 2).alias("deficiency_score"),
        F.count(F.when(outside, 1)).alias("out_of_range_count"),
    ]


def cluster_patients(
    df: DataFrame,
    n_clusters: int = 3,
    algorithm: str = "kmeans",
    scoring: str = "range",
    restarts: int = RESTARTS,
) -> ClusterResult:
    """Cluster persons by their standardised mean measurements.

    Algorithms: ``kmeans``; ``spectral`` (nearest-neighbour affinity); ``agglomerative`` (Ward).
    Scoring ``range`` names clusters by risk from reference ranges, ``instrument`` by HAM-D total.
    """
    needed = ["person_id", "measurement_id", "measurement_source_value", "value_as_number"]
    if scoring not in ("range", "instrument"):
        raise ValueError(f"Unknown scoring {scoring!r}; expected 'range' or 'instrument'")
    if algorithm not in ("kmeans", "agglomerative", "spectral"):
        raise ValueError(
            f"Unknown algorithm {algorithm!r}; expected 'kmeans', 'agglomerative' or 'spectral'"
        )
    if int(n_clusters) < 1:
        raise ValueError("n_clusters must be at least 1")
    require_columns(df, needed + (["range_low", "range_high"] if scoring == "range" else []))

    means = stage(person_means(df), "person-means")
    features = stage(_features(means), "features")
    labelled = _label(features, int(n_clusters), algorithm, restarts)
    model = PCA(k=2, inputCol="features", outputCol="_pca").fit(features)
    pca = vector_to_array("_pca")
    signs = [float(np.sign(c[np.argmax(np.abs(c))])) for c in model.pc.toArray().T]
    placed = (
        model.transform(labelled)
        .withColumn("pca_x", round_even(pca[0] * signs[0], 4))
        .withColumn("pca_y", round_even(pca[1] * signs[1], 4))
    )

    counted = F.count("measurement_id").alias("num_measurements")
    if scoring == "range":
        per_person = df.groupBy("person_id").agg(*_range_sums(df), counted)
        scores = ["abnormality_score", "deficiency_score", "out_of_range_count"]
    else:
        per_person = (
            df.groupBy("person_id").agg(counted).join(_instrument_scores(means), "person_id")
        )
        scores = ["ham_d_total", "psqi_total", "cdr_score"]
    # both sides have one row per person
    people = stage(
        placed.join(per_person, "person_id").select(
            "person_id", "pca_x", "pca_y", "cluster", "_level", *scores, "num_measurements"
        ),
        "patients",
    )

    if scoring == "range":
        flagged = people.agg(F.max("out_of_range_count")).first()[0]
        risk = F.col("out_of_range_count") + F.col("abnormality_score") / 100
        if not flagged:
            risk = F.col("_level")
        names = RISK_NAMES
    else:
        risk, names = F.col("ham_d_total"), SEVERITY_NAMES
    facts = people.groupBy("cluster").agg(F.avg(risk).alias("level"), F.count(F.lit(1)).alias("n"))
    facts = sorted(facts.collect(), key=lambda r: (r["level"], r["cluster"]))
    label = F.lit(None).cast("string")
    for position, fact in enumerate(facts):
        name = names[position] if n_clusters == 3 else f"Cluster {position}"
        label = F.when(F.col("cluster") == fact["cluster"], F.lit(name)).otherwise(label)
    patients = people.select(
        "person_id", "pca_x", "pca_y", "cluster", label.alias("cluster_label"), *scores, "num_measurements"
    )
    sizes = df.sparkSession.createDataFrame(
        sorted((r["cluster"], r["n"]) for r in facts), "cluster int, n long"
    )
    return ClusterResult(patients, sizes, tuple(float(s) for s in model.explainedVariance))


def _features(means: DataFrame) -> DataFrame:
    """Mean-imputed, standardised vectors: person_id, z, features, _level (mean of the row).

    Imputing a column's mean gives 0 after standardising, so only observed cells are computed and
    the wide matrix never exists as columns. The population std counts the imputed persons too.
    """
    persons = means.select("person_id").distinct().count()
    facts = means.groupBy("measure").agg(
        F.avg("v").alias("mean"), F.var_pop("v").alias("var"), F.count("v").alias("n")
    )
    if facts.count() > MAX_MEASURES:
        raise ValueError(f"More than {MAX_MEASURES} different measurements")
    facts = sorted(facts.collect(), key=lambda r: r["measure"])
    if len(facts) < 2:
        raise ValueError("Clustering needs at least 2 different measurements with values")
    rows = [
        (r["measure"], i, r["mean"], (r["var"] * r["n"] / persons) ** 0.5 or 1.0)
        for i, r in enumerate(facts)
    ]
    kind = means.schema["measure"].dataType.simpleString()
    fitted = means.sparkSession.createDataFrame(rows, f"measure {kind}, i int, mean double, std double")
    cells = means.join(F.broadcast(fitted), "measure").select(
        "person_id", "i", ((F.col("v") - F.col("mean")) / F.col("std")).alias("z")
    )
    width = len(rows)
    known = F.map_from_entries(F.collect_list(F.struct("i", "z")))
    z = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.coalesce(F.try_element_at(F.col("_cells"), i), F.lit(0.0)),
    )
    return (
        cells.groupBy("person_id")
        .agg(known.alias("_cells"), (F.sum("z") / F.lit(width)).alias("_level"))
        .select("person_id", z.alias("z"), "_level")
        .withColumn("features", array_to_vector("z"))
    )


def _label(features: DataFrame, k: int, algorithm: str, restarts: int) -> DataFrame:
    if algorithm == "kmeans":
        model = _best_kmeans(features, k, restarts)
        return model.setPredictionCol("cluster").transform(features)
    if algorithm == "spectral":
        placed, columns = spectral.embedding(features, k)
        placed = stage(placed.select("z", F.array(*columns).alias("e")), "embedding")
        rows = placed.withColumn("features", array_to_vector("e"))
        found = _best_kmeans(rows, k, restarts).setPredictionCol("cluster").transform(rows)
        return features.join(found.select("z", "cluster"), "z")

    return features.join(ward.labels(features, k), "z")


def _best_kmeans(features: DataFrame, k: int, restarts: int) -> KMeansModel:
    """The fit with the lowest inertia over several seeds; fits share the cluster's idle tasks."""

    # all centres together may still move by a hundredth of a standard deviation
    tol = 0.01 / k**0.5

    def fit(seed: int) -> KMeansModel:
        return KMeans(k=k, seed=seed, maxIter=300, tol=tol, featuresCol="features").fit(features)

    features = features.persist()
    try:
        with ThreadPool(min(restarts, PARALLEL_FITS)) as pool:
            in_session = inheritable_thread_target(features.sparkSession)(fit)
            fits = pool.map(in_session, range(SEED, SEED + restarts))
    finally:
        features.unpersist()
    return min(fits, key=lambda m: m.summary.trainingCost)
