"""K-means over location profiles.

``kmeans_fit`` is a Lloyd loop on DataFrames: each round assigns every row to
its nearest centre (squared Euclidean, lowest index on ties) with the k
centres passed as array literals -- no join, and the compiled code is reused
from round to round -- and recomputes the centres with one aggregation of k
groups. Only the k centres reach the driver. No feature
scaling. An empty cluster keeps its previous centre.

``kmeans_ml`` is Spark ML's KMeans on the same features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from obsgrid.functions.geo import squared_distance
from obsgrid.session import shared_dir

_FEATURES = "_features_of_row"


def assign(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]],
           out: str = "cluster") -> DataFrame:
    """Label each row with the index of its nearest centre."""
    return df.withColumn(out, nearest_centre(features, centres))


def nearest_centre(features: Sequence[str] | Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre, lowest index on ties.

    Each centre is an array literal, so its values live in the expression tree
    rather than in generated code: every Lloyd round reuses the compiled code.
    The squared distance is summed left to right: 0 + d1^2 + d2^2 + ...
    """
    fv = features if isinstance(features, Column) else F.array(*[F.col(f).cast("double") for f in features])
    width = None if isinstance(features, Column) else len(features)
    cands = []
    for i, c in enumerate(centres):
        if width is not None and len(c) != width:
            raise ValueError(f"centre {i} has {len(c)} values for {width} features")
        d = squared_distance(fv, F.lit([float(x) for x in c]))
        cands.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*cands))["i"]


def initial_centres(df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int,
                    init: str = "first", seed: int = 0) -> list[list[float]]:
    """k distinct rows as first centres: the first k by key order, or k by a seeded hash."""
    if init == "first":
        order = [F.col(c) for c in keys]
    elif init == "random":
        # a hash that SQL engines share; numbers count by their millionths
        text = [F.round(F.col(c) * 1000000).cast("bigint").cast("string") if isinstance(df.schema[c].dataType, NumericType)
                else F.col(c).cast("string") for c in keys]
        order = [F.md5(F.concat_ws(":", F.lit(str(int(seed))), *text)), *[F.col(c) for c in keys]]
    else:
        raise ValueError("init must be 'first' or 'random'")
    rows = df.orderBy(*order).limit(k).select(*features).collect()
    if len(rows) < k:
        raise ValueError(f"k={k} is more than the {len(rows)} rows to cluster")
    return [[float(r[f]) for f in features] for r in rows]


def kmeans_fit(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("longitude", "latitude"),
               k: int = 3, rounds: int = 10, init: str = "first", seed: int = 0,
               centres: Sequence[Sequence[float]] | None = None) -> tuple[DataFrame, list[list[float]]]:
    """Lloyd's algorithm for a fixed number of rounds, no stopping test.

    Returns (rows with ``cluster``, the centres used for the last assignment).
    """
    if k < 1:
        raise ValueError("k must be positive")
    shared_dir(df.sparkSession)
    fv = F.array(*[F.col(f).cast("double") for f in features])
    # the profile is worked out once: the rounds and the labels read the kept copy
    data = df.withColumn(_FEATURES, fv).checkpoint(eager=True)
    cur = [list(c) for c in centres] if centres is not None else initial_centres(data, features, keys, k, init, seed)
    for _ in range(rounds):
        means = (data.withColumn("cluster", nearest_centre(F.col(_FEATURES), cur)).groupBy("cluster")
                 .agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]).collect())
        for r in means:
            cur[r["cluster"]] = [float(r[f]) for f in features]
    return data.withColumn("cluster", nearest_centre(features, cur)).drop(_FEATURES), cur


def clustering_cost(df: DataFrame, features: Sequence[str], label: str = "cluster") -> float:
    """Sum of squared distances of the rows to their cluster's mean, from one pass of sums."""
    x = [F.col(f).cast("double") for f in features]
    parts = df.groupBy(label).agg(F.count("*").alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)],
                                  *[F.sum(v * v).alias(f"q{i}") for i, v in enumerate(x)]).collect()
    return sum(r[f"q{i}"] - r[f"s{i}"] ** 2 / r["n"] for r in parts for i in range(len(x)))


def centres_frame(spark, features: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """The k centres as a DataFrame (cluster, features...)."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(centres)]
    schema = "cluster int, " + ", ".join(f"{f} double" for f in features)
    return spark.createDataFrame(rows, schema)


def kmeans_ml(df: DataFrame, features: Sequence[str], k: int = 3, rounds: int = 10, seed: int = 1) -> DataFrame:
    """Spark ML KMeans (random init, fixed iterations, no tolerance stop)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    vec = VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)
    model = KMeans(k=k, maxIter=rounds, tol=0.0, seed=seed, initMode="random",
                   featuresCol="_features", predictionCol="cluster").fit(vec)
    return model.transform(vec).drop("_features").withColumn("cluster", F.col("cluster").cast("int"))
