"""KPIs, alerts, training tables and checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def unpivot_metrics(metrics: DataFrame, prefix: str = "") -> DataFrame:
    """``metric_path``, ``value`` of a one-row table's numeric columns."""
    names = [c for c, k in metrics.dtypes if k in ("int", "bigint", "double", "float") or k.startswith("decimal")]
    return metrics.select(F.explode(F.array(*[F.struct(F.lit(prefix + c).alias("metric_path"), F.col(c).cast("double").alias("value")) for c in names])).alias("m")).select("m.*")


def kpi_alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules that their metric breaches. ``rules``: ``kpi``, ``metric_path``, ``comparison``, ``threshold``, ``severity``.

    A rule without a metric gives no alert; ``missing_metrics`` lists those.
    """
    both = rules.join(metrics, "metric_path")
    return both.where(text.compare_threshold(F.col("value"), F.col("comparison"), F.col("threshold"))).select("kpi", "metric_path", "value", "threshold", "severity")


def missing_metrics(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    return rules.join(metrics, "metric_path", "left_anti").select("kpi", "metric_path")


def alert_payloads(alerts: DataFrame) -> DataFrame:
    """Alerts with the text that a notifier would post."""
    return alerts.withColumn("payload", F.to_json(F.struct("kpi", "severity", "value", "threshold")))


def running_loss(steps: DataFrame, every: int = 100, group: str | None = None) -> DataFrame:
    """Mean loss up to each step, and whether it is logged and checkpointed. ``steps``: ``step``, ``loss``.

    Prefix sums come in two levels, ranges of steps and steps inside a range, so no task sees all steps.
    """
    size = 4_096
    keys = [group] if group else []
    marked = steps.withColumn("_range", F.floor(F.col("step") / size))
    exact = F.col("loss").cast("decimal(38,9)")
    sums = marked.groupBy(*keys, "_range").agg(F.sum(exact).alias("_s"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"))
    inside = Window.partitionBy(*keys, "_range").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    all_ = marked.withColumns({"_s": F.sum(exact).over(inside), "_n": F.count("*").over(inside)}).join(sums, [*keys, "_range"])
    mean = (F.col("_s") + F.col("_s0")).cast("double") / (F.col("_n") + F.col("_n0"))
    return all_.select(*keys, "step", mean.alias("mean_loss"), (F.col("step") % every == 0).alias("logged"))


def perplexity(losses: DataFrame) -> DataFrame:
    """exp of the token-weighted mean loss. ``losses``: ``loss``, ``tokens``."""
    return losses.agg(F.round(F.exp(F.sum(F.col("loss") * F.col("tokens")) / F.sum("tokens")), 6).alias("perplexity"))


def best_checkpoint(log: DataFrame, recorded: str | None = None) -> DataFrame:
    """The recorded best step, else that of the least loss (the earliest of equals)."""
    best = log.where("eval_loss is not null").agg(F.min(F.struct("eval_loss", "step")).alias("b")).select("b.step", "b.eval_loss")
    return best if recorded is None else best.withColumn("step", F.lit(recorded).cast(dict(log.dtypes)["step"]))


def needs_retrain(log: DataFrame, threshold: float) -> DataFrame:
    """Whether the last evaluation gained less than ``threshold`` on the one before."""
    last = log.where("eval_loss is not null").orderBy(F.col("step").desc()).limit(2).agg(F.max_by("eval_loss", "step").alias("now"), F.min_by("eval_loss", "step").alias("before"), F.count("*").alias("n"))
    return last.select(F.coalesce((F.col("n") == 2) & (F.col("before") - F.col("now") < threshold), F.lit(False)).alias("needs_retrain"))


def retrain_schedule(spark, attempts: int, rate: float, factor: float, replay: float, replay_step: float, epochs: int, epoch_step: int) -> DataFrame:
    """Hyper-parameters of each attempt: rate shrinks, replay grows to 0.9 at most, epochs grow."""
    i = F.col("attempt")
    return spark.range(1, attempts + 1).select(F.col("id").alias("attempt")).select("attempt", F.round(F.lit(rate) * F.pow(F.lit(factor), i), 12).alias("learning_rate"), F.round(F.least(F.lit(replay) + i * replay_step, F.lit(0.9)), 6).alias("replay_ratio"), (F.lit(epochs) + i * epoch_step).cast("long").alias("epochs"))


def score_checkpoints(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.withColumn("score", F.round(text.score_checkpoint(F.col("ppl"), F.col("rag")), 9))


def pareto_checkpoints(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints that no other beats in both perplexity and accuracy.

    A checkpoint is dominated if one of less or equal perplexity has greater accuracy, or one of
    equal accuracy has less perplexity: prefix maxima over distinct perplexities tell. Checkpoints are few.
    """
    best = checkpoints.groupBy("ppl").agg(F.max("rag").alias("best"))
    front = best.withColumn("so_far", F.max("best").over(Window.orderBy("ppl").rowsBetween(Window.unboundedPreceding, -1))).where("so_far is null or best > so_far")
    return checkpoints.join(front.select("ppl", F.col("best").alias("rag")), ["ppl", "rag"], "left_semi")


def weighted_score(checkpoints: DataFrame, weights: dict[str, float]) -> DataFrame:
    total = sum((F.col(c) * w for c, w in weights.items()), F.lit(0.0))
    return checkpoints.withColumn("weighted", F.round(total, 9))


def perplexity_threshold(checkpoints: DataFrame, most: float = 15.0) -> DataFrame:
    return checkpoints.where(F.col("ppl") <= most)


def guardrail_fpr(rows: DataFrame, flagged: str, bad: str) -> DataFrame:
    """Share of good rows that a filter flags."""
    good = F.count_if(F.col(bad) == 0)
    wrong = F.count_if((F.col(bad) == 0) & F.col(flagged))
    return rows.agg(good.alias("n_good"), wrong.alias("n_flagged"), F.when(good > 0, F.round(wrong / good, 6)).alias("fpr"))
