"""Train/test split by entity, model input assembly, logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from cohortspark.functions.ordered import Slices, running_sum
from cohortspark.functions.scalars import unit_hash
from cohortspark.functions.skew import AUTO, hot_keys, lookup_join, resolve_hot
from cohortspark.operators.relational import fill_constant, merge_nullsafe, restrict_to
from cohortspark.operators.scoring import gcs_total
from cohortspark.operators.summaries import mean_by
from cohortspark.session import inline, settle

SIDE = "side"


def split_side(key: str, frac: float, seed: int | str) -> Column:
    """"test" or "train" from the hash of seed and key, so every row of an entity lands on one side."""
    return F.when(unit_hash(key, seed) < F.lit(float(frac)), F.lit("test")).otherwise(F.lit("train"))


def stratified_split(
    ctx: DataFrame, key: str, label: str, frac: float = 0.1, seed: int | str = 0, exact: bool = False, slices: Slices | str | None = AUTO
) -> DataFrame:
    """(key, label, side) per entity.

    By default a hash threshold: each stratum is near the fraction and no rows meet. `exact` ranks the hashes inside
    each stratum, so every stratum has round(frac · size) test entities.
    """
    ids = ctx.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias(label))
    if not exact:
        return ids.withColumn(SIDE, split_side(key, frac, seed))
    ids = ids.withColumn("_hash", unit_hash(key, seed))
    ranked = running_sum(ids, [label], ["_hash", key], {"_rank": F.lit(1)}, slices)
    sizes = ids.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    joined = lookup_join(ranked, sizes, [label], nullsafe=True)
    side = F.when(F.col("_rank") <= F.rint(F.col("_size") * F.lit(float(frac))), F.lit("test")).otherwise(F.lit("train"))
    return joined.select(key, label, side.alias(SIDE))


MAX_STRATA = 10_000  # strata of a split rule, whose limits the driver holds
BINS = 65_536  # counts that reach the driver in one narrowing pass
ABOVE = "g"  # sorts after every hexadecimal digit


@dataclass(frozen=True)
class SplitRule:
    """A side for every entity from its label and the digest of its key alone: a digest before the stratum's limit is "test".

    `limits` holds a limit for each label as text; None stands for the unknown label.
    """

    key: str
    label: str
    seed: int | str
    limits: dict[str | None, str]

    def side(self) -> Column:
        """A column expression on any table that carries key and label. An entity of no known stratum is on the train side."""
        label = F.col(self.label).cast("string")
        named = [x for k, v in self.limits.items() if k is not None for x in (F.lit(k), F.lit(v))]
        limit = F.try_element_at(F.create_map(*named), label) if named else F.lit(None).cast("string")
        if None in self.limits:
            limit = F.when(label.isNull(), F.lit(self.limits[None])).otherwise(limit)
        return F.when(key_digest(self.key, self.seed) < limit, F.lit("test")).otherwise(F.lit("train"))

    def apply(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(train, test) rows of a table that carries key and label: two filters, nothing is joined. Rows without key go."""
        known = df.filter(F.col(self.key).isNotNull())
        return known.filter(self.side() == "train"), known.filter(self.side() == "test")


def key_digest(key: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def fit_split(
    ctx: DataFrame, key: str, label: str, frac: float = 0.1, seed: int | str = 0, strata: int = MAX_STRATA, bins: int = BINS
) -> SplitRule:
    """The rule by which round(frac * size) entities of every stratum are test entities, those of the smallest digests.

    The limit of a stratum is an order statistic of its digests, found digit by digit: a pass counts the entities by the next
    digits of their digests, only for strata and beginnings still open, and returns at most about `bins` counts; two or three
    passes do for any number of entities. An entity's label is the largest among its rows; more than `strata` labels are refused.
    """
    ids = ctx.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.col(label)).cast("string").alias("_label"))
    digests = settle(ids.select("_label", key_digest(key, seed).alias("_digest")), "split-digests")
    sizes = digests.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).limit(strata + 1).collect()
    if len(sizes) > strata:
        raise ValueError(f"more than {strata} strata")
    wanted = {r["_label"]: round(frac * r["n"]) for r in sizes}
    limits = {r["_label"]: "" if wanted[r["_label"]] <= 0 else ABOVE for r in sizes if not 0 < wanted[r["_label"]] < r["n"]}
    open_ = {k: ("", 0) for k in wanted if k not in limits}  # the beginning of the limit, how many digests lie before it
    while open_:
        digits = 1
        while len(open_) * 16 ** (digits + 1) <= bins and digits < 8:
            digits += 1
        begun = inline(ctx.sparkSession, [(k, b) for k, (b, _) in open_.items()], "_stratum string, _begin string")
        here = F.col("_label").eqNullSafe(F.col("_stratum")) & F.col("_digest").startswith(F.col("_begin"))
        rest = F.substring("_digest", F.length("_begin") + 1, F.lit(digits)).alias("next")
        found: dict[str | None, list[tuple[str, int]]] = {k: [] for k in open_}
        counts = digests.join(F.broadcast(begun), here).groupBy("_stratum", rest).agg(F.count(F.lit(1)).alias("n"))  # at most `strata` rows sent
        for r in counts.collect():
            found[r["_stratum"]].append((r["next"], r["n"]))
        for k, (begin, before) in list(open_.items()):
            for part, n in sorted(found[k]):
                if before + n >= wanted[k]:
                    if before + n == wanted[k] or len(begin + part) >= 32:
                        limits[k] = begin + part + ABOVE
                        del open_[k]
                    else:
                        open_[k] = begin + part, before
                    break
                before += n
    return SplitRule(key, label, seed, limits)


def apply_split(df: DataFrame, sides: DataFrame, key: str, hot: DataFrame | str | None = AUTO) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of any table that carries the key. `hot` keys of the table are measured unless given."""
    hot = resolve_hot(hot, df, [key])
    train, test = (sides.filter(F.col(SIDE) == s).select(key) for s in ("train", "test"))
    return restrict_to(df, train, key, hot), restrict_to(df, test, key, hot)


def assemble_features(
    ctx: DataFrame,
    stay_buckets: DataFrame,
    admission_buckets: DataFrame,
    stay_features: list[str],
    admission_features: list[str],
    stay_key: str = "icustay_id",
    admission_key: str = "hadm_id",
    fills: dict[str, float] | None = None,
    total: Column | None = None,
    drop: list[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Context ⋈ stay averages ⋈ admission averages (unknown keys match each other), constant fills, coma total, drops.

    The hot keys of the context, such as an unknown stay shared by many rows, are measured unless the bound `rows` on its
    size rules them out.
    """
    by_stay = mean_by(stay_buckets, stay_key, stay_features)
    by_admission = mean_by(admission_buckets, admission_key, admission_features)
    hot = [hot_keys(ctx, [k], rows=rows) for k in (stay_key, admission_key)]
    merged = merge_nullsafe(ctx, by_stay, stay_key, hot=hot[0])
    merged = merge_nullsafe(merged, by_admission, admission_key, hot=hot[1])
    if fills:
        merged = fill_constant(merged, fills)
    merged = merged.withColumn("gcs_total", gcs_total() if total is None else total)
    return merged.drop(*(drop or []))


def model_frame(df: DataFrame, label: str, outcomes: list[str] | None = None) -> DataFrame:
    """(features, label) of the rows with a label: all columns but the outcomes as a vector. Every outcome column is kept out
    of the inputs."""
    inputs = [c for c in df.columns if c != label and c not in (outcomes or [])]
    out = VectorAssembler(inputCols=inputs, outputCol="features").transform(df.filter(F.col(label).isNotNull()))
    return out.select("features", F.col(label).cast("double").alias("label"))


def fit_logistic(
    train: DataFrame, label: str, outcomes: list[str] | None = None, family: str = "auto", max_iter: int = 100
) -> LogisticRegressionModel:
    """L2 logistic regression with unit inverse strength (a penalty of 1/n on the mean loss), unscaled inputs."""
    data = model_frame(train, label, outcomes)
    rows = data.count()
    return LogisticRegression(
        regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False, family=family, maxIter=max_iter
    ).fit(data)


def accuracy(model: LogisticRegressionModel, test: DataFrame, label: str, outcomes: list[str] | None = None) -> DataFrame:
    """One row: rows scored and the share predicted right."""
    scored = model.transform(model_frame(test, label, outcomes))
    right = F.when(F.col("prediction") == F.col("label"), F.lit(1.0)).otherwise(F.lit(0.0))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))
