"""Comparison of result tables (one row per model and strategy)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KS, STRATEGIES
from .metrics import columns_at

# Shape of a model key, base name and strategy.
MODEL_PATTERN = r"^(cb\d+)_(.*)$"


def split_model_key(results: DataFrame) -> DataFrame:
    """Add base, variant and model number to the ``model`` key."""
    model = F.col("model")
    return results.withColumns({
        "base": F.regexp_extract(model, MODEL_PATTERN, 1),
        "variant": F.regexp_extract(model, MODEL_PATTERN, 2),
        "model_number": F.regexp_extract(model, r"^cb(\d+)", 1).try_cast("int"),
    })


def sorted_results(results: DataFrame) -> DataFrame:
    return split_model_key(results).orderBy("model_number", "variant")


def _measured(results: DataFrame, ks: Sequence[int]) -> list[str]:
    """Metric columns that this result table has, in the order of the metrics."""
    return sorted(set(columns_at(ks)) & set(results.columns), key=list(columns_at(ks)).index)


def unpivot_metrics(results: DataFrame, ks: Sequence[int] = KS, extra: Sequence[str] = ()) -> DataFrame:
    """(model, name, value): one row per metric column."""
    names = [*extra, *_measured(results, ks)]
    return results.unpivot(["model"], [F.col(f"`{n}`") for n in names], "name", "value")


def metric_by_k(results: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """(model, metric, k, value) from columns named metric@k."""
    long = unpivot_metrics(results, ks)
    part = F.split("name", "@")
    return long.select("model", part[0].alias("metric"), part[1].cast("int").alias("k"), "value")


def variant_means(results: DataFrame, ks: Sequence[int] = KS, variants: Sequence[str] = STRATEGIES) -> DataFrame:
    """(metric, one column per strategy): mean over the models."""
    long = unpivot_metrics(results, ks).withColumn("variant", F.regexp_extract("model", MODEL_PATTERN, 2))
    return (
        long.groupBy(F.col("name").alias("metric")).pivot("variant", list(variants)).agg(F.avg("value"))
    )


def pivot_metric(results: DataFrame, metric: str, variants: Sequence[str] = STRATEGIES) -> DataFrame:
    """(base, one column per strategy) of one metric."""
    return split_model_key(results).groupBy("base").pivot("variant", list(variants)).agg(F.first(F.col(f"`{metric}`")))


def best_models(results: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """(metric, model, value): lowest rmse, highest of the others; ties: name."""
    extra = ["rmse"] if "rmse" in results.columns else []
    long = unpivot_metrics(results, ks, extra).filter(F.col("value").isNotNull())
    good = F.when(F.col("name") == "rmse", F.col("value")).otherwise(-F.col("value"))
    best = F.min_by(F.struct("model", "value"), F.struct(good, F.col("model")))
    return long.groupBy(F.col("name").alias("metric")).agg(best.alias("b")).select("metric", "b.model", "b.value")


def relative_gain(left: DataFrame, right: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """Percent by which the best model of ``left`` beats the best of ``right``."""
    a = best_models(left, ks).select("metric", F.col("model").alias("left_model"), F.col("value").alias("l"))
    b = best_models(right, ks).select("metric", F.col("model").alias("right_model"), F.col("value").alias("r"))
    gain = (F.col("l") - F.col("r")) / F.col("r") * 100
    return a.join(b, "metric").select("metric", "left_model", "right_model", gain.alias("gain_percent"))


def top_models(results: DataFrame, metric: str = "ndcg@10", n: int = 5) -> DataFrame:
    return results.select("model", F.col(f"`{metric}`").alias("value")).orderBy(F.desc("value"), "model").limit(n)


def rounded(results: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """Metrics to 6 places, rmse to 4."""
    places = {**{m: 6 for m in _measured(results, ks)}, **({"rmse": 4} if "rmse" in results.columns else {})}
    return results.select(*[
        F.round(F.col(f"`{c}`"), places[c]).alias(c) if c in places else F.col(f"`{c}`") for c in results.columns
    ])


def markdown_lines(results: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """(part, model, line) of a Markdown table: names, alignment (text left, numbers right), a line per model.

    Cells are not padded: a Markdown reader sets the widths. Measures have four
    decimals; a pattern rounds the stored binary value half-even.
    """
    measures = [*(["rmse"] if "rmse" in results.columns else []), *_measured(results, ks)]
    cells = [F.col("model"), F.col("n_users").cast("string"), *[F.expr(f"format_number(`{m}`, '0.0000')") for m in measures]]

    def framed(parts) -> Column:
        return F.concat(F.lit("|"), F.concat_ws("|", *parts), F.lit("|"))

    one = results.sparkSession.range(1)
    names = one.select(F.lit(0).alias("part"), F.lit("").alias("model"), framed(map(F.lit, ["model", "n_users", *measures])).alias("line"))
    aligned = one.select(F.lit(1), F.lit(""), framed(map(F.lit, [":--"] + ["--:"] * (len(measures) + 1))))
    return names.union(aligned).union(results.select(F.lit(2), "model", framed(cells)))


def render_markdown(results: DataFrame, ks: Sequence[int] = KS) -> str:
    """The table as text (it has a row per model and strategy); empty for no models."""
    lines = [r["line"] for r in markdown_lines(results, ks).orderBy("part", "model").collect()]
    return "\n".join(lines) if len(lines) > 2 else ""
