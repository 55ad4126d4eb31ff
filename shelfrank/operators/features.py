"""Feature pipeline for the content-based recommenders.

* one-hot of every string column (segment; category, brand): ``StringIndexer``
  with alphabetical level order and ``handleInvalid="keep"`` followed by
  ``OneHotEncoder(dropLast=True)`` - the dropped slot is the "unknown" one,
  so every real level keeps a slot and an unseen level becomes all zeros
  (P3 alignment comes for free from the fitted model).
* the encoders are fitted on the dimension tables (or a given training
  frame), never on the per-pair product.
* price standardisation (P4) uses mean and *population* std over the
  training interactions (log joined to items), one aggregate; the original
  price is kept next to it (P5).
* user and item parts are separate arrays, so linear models decompose into
  a per-user and a per-item term and pair vectors are only assembled for
  training rows (J1), never for all candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.session import sized


def columns_of(df: DataFrame, without) -> tuple[list[str], list[str]]:
    """(string columns, numeric columns) of a feature table but for ``without``, in its order."""
    fields = [f for f in df.schema.fields if f.name not in without]
    return ([f.name for f in fields if isinstance(f.dataType, T.StringType)],
            [f.name for f in fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))])


def onehot_pipeline(cols):
    stages = []
    for c in cols:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_ix", stringOrderType="alphabetAsc",
                                    handleInvalid="keep"))
        # the indexer's extra "unknown" index is the last category, dropped here
        stages.append(OneHotEncoder(inputCol=f"{c}_ix", outputCol=f"{c}_oh", dropLast=True))
    return Pipeline(stages=stages)


def onehot_slots(model, df: DataFrame, cols) -> DataFrame:
    """Expose the one-hot encoding as (slot, width) per column: slot is null for an unseen level."""
    out = model.transform(df)
    for c in cols:
        arr = vector_to_array(F.col(f"{c}_oh"))
        out = (out.withColumn(f"{c}_width", F.size(arr))
               .withColumn(f"{c}_slot", (F.array_position(arr, 1.0) - 1).cast("int"))
               .withColumn(f"{c}_slot", F.when(F.col(f"{c}_slot") >= 0, F.col(f"{c}_slot"))))
    return out


@dataclass
class FeatureSpace:
    """Fitted encoders of two feature tables. All their string columns are one-hot encoded and all
    numeric ones are numbers, whatever their names; ``price`` is standardised."""

    user_model: object
    item_model: object
    price_mean: float
    price_std: float
    user_cats: list
    user_nums: list
    item_cats: list
    item_nums: list

    @staticmethod
    def fit(users: DataFrame, items: DataFrame, train_log: DataFrame | None = None) -> "FeatureSpace":
        user_cats, user_nums = columns_of(users, ["user_idx"])
        item_cats, item_nums = columns_of(items, ["item_idx", "price"])
        um = onehot_pipeline(user_cats).fit(users)
        im = onehot_pipeline(item_cats).fit(items)
        src = items if train_log is None else train_log.join(sized(items.select("item_idx", "price")), "item_idx")
        st = src.agg(F.avg("price").alias("m"), F.stddev_pop("price").alias("s")).first()
        std = st["s"] if st["s"] else 1.0   # constant price: scale by 1 (as sklearn)
        return FeatureSpace(um, im, float(st["m"] or 0.0), float(std), user_cats, user_nums, item_cats, item_nums)

    def scaled_price(self, col="price"):
        return (F.col(col) - F.lit(self.price_mean)) / F.lit(self.price_std)

    def user_vectors(self, users: DataFrame, *keep: str) -> DataFrame:
        """(user_idx, keep..., uvec array<double>) = one-hot(segment) ++ numeric attributes."""
        t = self.user_model.transform(users)
        parts = [vector_to_array(F.col(f"{c}_oh")) for c in self.user_cats] + \
                [F.array(*[F.col(c).cast("double") for c in self.user_nums]).cast("array<double>")]
        return t.select("user_idx", *keep, F.concat(*parts).alias("uvec"))

    def item_vectors(self, items: DataFrame, *keep: str) -> DataFrame:
        """(item_idx, keep..., ivec, price, scaled_price); ivec = one-hots ++ attributes ++ scaled price."""
        t = self.item_model.transform(items)
        parts = [vector_to_array(F.col(f"{c}_oh")) for c in self.item_cats] + \
                [F.array(*[F.col(c).cast("double") for c in self.item_nums] + [self.scaled_price()])]
        return t.select("item_idx", *keep, F.concat(*parts).alias("ivec"), "price",
                        self.scaled_price().alias("scaled_price"))

    def user_parts(self, users: DataFrame) -> DataFrame:
        """(user_idx, numbers array<double>, levels array<int>): the same features without one-hot
        vectors; a level is its index, -1 if it is null or unknown."""
        t = self.user_model.transform(users)
        return t.select("user_idx", F.array(*[F.col(c).cast("double") for c in self.user_nums]).cast("array<double>").alias("numbers"),
                        self._levels(self.user_model, self.user_cats))

    def item_parts(self, items: DataFrame) -> DataFrame:
        """(item_idx, numbers array<double> with the standardised price last, levels array<int>)."""
        t = self.item_model.transform(items)
        return t.select("item_idx", F.array(*[F.col(c).cast("double") for c in self.item_nums] + [self.scaled_price()]).alias("numbers"),
                        self._levels(self.item_model, self.item_cats))

    @staticmethod
    def _levels(model, cats):
        known = [len(s.labels) for s in model.stages if hasattr(s, "labels")]
        return F.array(*[F.when(F.col(f"{c}_ix") < n, F.col(f"{c}_ix")).otherwise(-1).cast("int")
                         for c, n in zip(cats, known, strict=True)]).cast("array<int>").alias("levels")

    def training_frame(self, log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
        """J1 + P1/P2/P4: log joined to both sides (inner), pair vector, label. The log meets the plain rows
        of both tables and the vectors are made behind the joins: one-hot vectors are many times wider than
        the files whose size Spark goes by, so a join on them may broadcast far too much."""
        j = log.select("user_idx", "item_idx", F.col("relevance").cast("double").alias("label"))
        for key, side, columns in (("user_idx", users, [*self.user_cats, *self.user_nums]),
                                   ("item_idx", items, [*self.item_cats, *self.item_nums, "price"])):
            j = j.join(sized(side.select(key, F.struct(*columns).alias(f"_{key}"))), key)
        u = self.user_vectors(j.select("*", "_user_idx.*"), "item_idx", "label", "_item_idx")
        i = self.item_vectors(u.select("*", "_item_idx.*"), "user_idx", "label", "uvec")
        whole = i.select("user_idx", "item_idx", "label", array_to_vector(F.concat("uvec", "ivec")).alias("_all"))
        width = sum(len(s.labels) for m in (self.user_model, self.item_model) for s in m.stages if hasattr(s, "labels"))
        width += len(self.user_nums) + len(self.item_nums) + 1
        whole = VectorSizeHint(inputCol="_all", size=width, handleInvalid="optimistic").transform(whole)
        # mostly zeros: kept as their other entries
        return VectorAssembler(inputCols=["_all"], outputCol="features").transform(whole).drop("_all")


def training_frame_raw(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Log x users x items, inner equi-joins (unmatched rows vanish)."""
    return log.join(users, "user_idx").join(items, "item_idx")


def with_price(df: DataFrame, items: DataFrame, default: float | None = None) -> DataFrame:
    """Left-join prices onto rows; ``default`` fills missing prices."""
    out = df.join(items.select("item_idx", "price"), "item_idx", "left")
    if default is not None:
        out = out.withColumn("price", F.coalesce(F.col("price"), F.lit(default)))
    return out
