"""Matrix factorisation with biases: ALS on what user and item biases leave over."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingmill.functions import scalars as S
from ratingmill.operators.blocked import BlockPlan
from ratingmill.operators.mips import top_products
from ratingmill.operators.neighbours import seen_pairs
from ratingmill.operators.ranking import with_position
from ratingmill.operators.vectors import packed
from ratingmill.params import DEFAULTS
from ratingmill.session import shared_dir, stage

GRID_RANKS = (20, 50, 100, 200)
GRID_ITERATIONS = (20, 30)


def biases(train: DataFrame, damping: float = 5.0) -> tuple[float, DataFrame, DataFrame]:
    """Global mean, damped item biases, then damped user biases of what the items leave over."""
    mean = train.agg(F.avg("rating")).first()[0]
    off = F.col("rating") - F.lit(mean)
    items = stage(
        train.groupBy("movieId").agg((F.sum(off) / (F.count("*") + damping)).alias("item_bias")), "item_bias"
    )
    users = (
        train.join(items, "movieId")
        .groupBy("userId")
        .agg((F.sum(off - F.col("item_bias")) / (F.count("*") + damping)).alias("user_bias"))
    )
    return mean, stage(users, "user_bias"), items


def baseline_scores(pairs: DataFrame, mean: float, users: DataFrame, items: DataFrame) -> DataFrame:
    """Mean plus the known biases for every pair, unclipped, as ``cf_score``."""
    return (
        pairs.join(users, "userId", "left")
        .join(items, "movieId", "left")
        .withColumn(
            "cf_score",
            F.lit(mean) + F.coalesce("user_bias", F.lit(0.0)) + F.coalesce("item_bias", F.lit(0.0)),
        )
        .drop("user_bias", "item_bias")
    )


def index_ids(df: DataFrame, column: str) -> DataFrame:
    """Dense 0-based index of the distinct ids: (column, index)."""
    placed = with_position(df.select(column).distinct(), [column], "_pos")
    return placed.select(column, (F.col("_pos") - 1).cast("int").alias(f"{column}_index"))


BLOCK_RATINGS = 2_000_000
# ALS drops the shuffle files of the iterations before only when it checkpoints.
CHECKPOINT_EVERY = 1


class _FactorParams(Params):
    rank = Param(Params._dummy(), "rank", "number of factors", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "ALS iterations", TypeConverters.toInt)
    regParam = Param(Params._dummy(), "regParam", "regularisation", TypeConverters.toFloat)
    damping = Param(Params._dummy(), "damping", "pseudo-count of the biases", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    blocks = Param(Params._dummy(), "blocks", "ALS blocks per side; 0: one per BLOCK_RATINGS ratings, 10 at least", TypeConverters.toInt)


class BiasedFactors(Estimator, _FactorParams):
    """Estimator over (userId, movieId, rating)."""

    @keyword_only
    def __init__(
        self, *, rank: int = 100, maxIter: int = 20, regParam: float = 0.1, damping: float = 5.0, seed: int = 42, blocks: int = 0
    ):
        super().__init__()
        self._setDefault(rank=100, maxIter=20, regParam=0.1, damping=5.0, seed=42, blocks=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FactorModel:
        spark = dataset.sparkSession
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_dir(spark))
        train = stage(dataset.select("userId", "movieId", "rating"), "factor_train")
        mean, users, items = biases(train, self.getOrDefault(self.damping))
        # ALS takes int ids; dense indexes fit whatever the ids are.
        users = stage(users.join(index_ids(users, "userId"), "userId"), "user_index")
        items = stage(items.join(index_ids(items, "movieId"), "movieId"), "item_index")
        rest = (
            train.join(users, "userId")
            .join(items, "movieId")
            .select(
                "userId_index",
                "movieId_index",
                (F.col("rating") - F.lit(mean) - F.col("user_bias") - F.col("item_bias")).alias("rest"),
            )
        )
        blocks = self.getOrDefault(self.blocks) or max(10, -(-train.count() // BLOCK_RATINGS))
        als = ALS(
            numUserBlocks=blocks,
            numItemBlocks=blocks,
            userCol="userId_index",
            itemCol="movieId_index",
            ratingCol="rest",
            rank=self.getOrDefault(self.rank),
            maxIter=self.getOrDefault(self.maxIter),
            regParam=self.getOrDefault(self.regParam),
            seed=self.getOrDefault(self.seed),
            coldStartStrategy="nan",
            checkpointInterval=CHECKPOINT_EVERY,
        )
        # ALS blocks rows by hash and its start values by partition order: a sorted partitioning into as many parts on any
        # cluster makes the same seed give the same factors. Both ids are hashed, so a hot user is spread.
        fixed = rest.repartition(blocks, "userId_index", "movieId_index").sortWithinPartitions("userId_index", "movieId_index")
        return FactorModel(mean, users, items, als.fit(fixed))


class FactorModel(Model):
    def __init__(self, mean: float, users: DataFrame, items: DataFrame, als: ALSModel):
        super().__init__()
        self.mean, self.users, self.items, self.als = mean, users, items, als

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds ``prediction``; an unknown user or movie falls back to mean plus the known bias."""
        joined = dataset.join(self.users, "userId", "left").join(self.items, "movieId", "left")
        filled = joined.na.fill({"userId_index": -1, "movieId_index": -1})
        scored = self.als.setPredictionCol("_rest").transform(filled)
        estimate = (
            F.lit(self.mean)
            + F.coalesce("user_bias", F.lit(0.0))
            + F.coalesce("item_bias", F.lit(0.0))
            + F.nanvl(F.coalesce(F.col("_rest").cast("double"), F.lit(0.0)), F.lit(0.0))
        )
        return scored.withColumn("prediction", S.clip_rating(estimate)).select(*dataset.columns, "prediction")

    def user_vectors(self) -> DataFrame:
        """(id, feature, weight): factors, then 1 against the item bias, then mean + user bias."""
        rank = self.als.rank
        own = self.users.withColumn("_own", F.lit(self.mean) + F.col("user_bias"))
        return self._vectors(self.als.userFactors, own, "userId", {rank: F.lit(1.0), rank + 1: F.col("_own")})

    def item_vectors(self) -> DataFrame:
        rank = self.als.rank
        return self._vectors(
            self.als.itemFactors, self.items, "movieId", {rank: F.col("item_bias"), rank + 1: F.lit(1.0)}
        )

    @staticmethod
    def _vectors(factors: DataFrame, ids: DataFrame, key: str, extra: dict) -> DataFrame:
        tail = F.array(*[column.cast("double") for _, column in sorted(extra.items())])
        joined = factors.join(ids, F.col("id") == F.col(f"{key}_index")).select(
            F.col(key).alias("id"), F.concat(F.col("features").cast("array<double>"), tail).alias("_vector")
        )
        return joined.select("id", F.posexplode("_vector").alias("feature", "weight")).withColumn(
            "feature", F.col("feature").cast("bigint")
        )

    def recommend(
        self, train: DataFrame, users: DataFrame, top_n: int = DEFAULTS.top_n, plan: BlockPlan = BlockPlan()
    ) -> DataFrame:
        """Top-n unseen movies per user by estimated rating, all training movies considered."""
        wanted = users.select(F.col("userId").alias("id"))
        left = packed(self.user_vectors().join(wanted, "id", "left_semi"))
        found = top_products(left, packed(self.item_vectors()), top_n, skip=seen_pairs(train, users), plan=plan)
        return found.select(
            F.col("left_id").alias("userId"),
            "rank",
            F.col("right_id").alias("movieId"),
            S.clip_rating(F.col("score")).alias("predicted_rating"),
            F.lit("SVD").alias("method"),
        )

    def save(self, folder: str) -> None:
        self.users.write.mode("overwrite").parquet(f"{folder}/users")
        self.items.write.mode("overwrite").parquet(f"{folder}/items")
        self.als.write().overwrite().save(f"{folder}/als")
        spark = self.users.sparkSession
        spark.createDataFrame([(self.mean,)], "mean double").write.mode("overwrite").parquet(f"{folder}/mean")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> FactorModel:
        return cls(
            spark.read.parquet(f"{folder}/mean").first()[0],
            spark.read.parquet(f"{folder}/users"),
            spark.read.parquet(f"{folder}/items"),
            ALSModel.load(f"{folder}/als"),
        )


def _indexed(train: DataFrame, folds: int, damping: float) -> DataFrame:
    """The ratings once, with dense ids, a fold by hash, and the baseline of each row for each fold that is held out."""
    fold = F.pmod(F.xxhash64("userId", "movieId"), F.lit(folds)).cast("int").alias("fold")
    rows = stage(train.select("userId", "movieId", "rating", fold), "folded")
    for key in ("userId", "movieId"):
        rows = rows.join(stage(index_ids(rows, key), f"{key}_index"), key)
    for f in range(folds):
        mean, users, items = biases(rows.filter(F.col("fold") != f), damping)
        rows = baseline_scores(rows, mean, users, items).withColumnRenamed("cf_score", f"base_{f}")
    return stage(rows.select("userId_index", "movieId_index", "rating", "fold", *[f"base_{f}" for f in range(folds)]), "indexed")


def grid_search(
    train: DataFrame,
    ranks: Sequence[int] = GRID_RANKS,
    iterations: Sequence[int] = GRID_ITERATIONS,
    folds: int = 5,
    parallelism: int = 4,
) -> tuple[FactorModel, DataFrame]:
    """Cross-validated RMSE per setting, and the best setting refitted on all rows.

    All fits read one staged table: ids are indexed once, folds are a column, and the baselines of each fold are columns too. Fits of
    different settings and folds run side by side; a fit with more iterations is not derived from one with fewer.
    """
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    whole = BiasedFactors()
    rows = _indexed(train, folds, whole.getOrDefault(whole.damping))
    # Several fits share the cores, so one fit takes as few blocks as its ratings need.
    blocks = max(2, -(-rows.count() // BLOCK_RATINGS))

    def squared_error(setting: tuple[int, int, int]) -> tuple[float, int]:
        rank, steps, f = setting
        als = ALS(
            numUserBlocks=blocks, numItemBlocks=blocks, userCol="userId_index", itemCol="movieId_index", ratingCol="rest",
            rank=rank, maxIter=steps, regParam=whole.getOrDefault(whole.regParam), seed=whole.getOrDefault(whole.seed), coldStartStrategy="nan",
        )
        own = rows.select("userId_index", "movieId_index", "rating", "fold", F.col(f"base_{f}").alias("base"))
        kept = own.filter(F.col("fold") != f).withColumn("rest", F.col("rating") - F.col("base"))
        fixed = kept.repartition(blocks, "userId_index", "movieId_index").sortWithinPartitions("userId_index", "movieId_index")
        scored = als.fit(fixed).setPredictionCol("_rest").transform(own.filter(F.col("fold") == f))
        estimate = S.clip_rating(F.col("base") + F.nanvl(F.col("_rest").cast("double"), F.lit(0.0)))
        total = scored.agg(F.coalesce(F.sum(F.pow(F.col("rating") - estimate, F.lit(2.0))), F.lit(0.0)), F.count("*"))
        return tuple(total.first())

    settings = [(r, i, f) for r in ranks for i in iterations for f in range(folds)]
    with ThreadPool(parallelism) as pool:
        errors = dict(zip(settings, pool.map(inheritable_thread_target(spark)(squared_error), settings, chunksize=1)))
    table = []
    for r in ranks:
        for i in iterations:
            parts = [errors[r, i, f] for f in range(folds)]
            # Mean over the folds of their root mean squared errors.
            held = [(e / n) ** 0.5 for e, n in parts if n]
            table.append((r, i, sum(held) / len(held) if held else float("nan")))
    best = min(table, key=lambda row: (row[2], row[0], row[1]))
    model = BiasedFactors(rank=best[0], maxIter=best[1]).fit(train)
    return model, spark.createDataFrame(table, "rank int, max_iter int, rmse double")
