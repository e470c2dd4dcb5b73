"""Queries: biases, factor models, cold start, rating error."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import KS
from ..functions.text import clip
from ..operators import factor_evaluating, factor_models, metrics, splitting
from ..session import cut_lineage, scratch_path
from ..sources import tables
from ..sources.driver_views import Views, with_views
from .queries_prepare import split
from .registry import register

def _ratings(v: Views):
    s = split(v).select(F.col("userId").alias("user_id"), F.col("movieId").alias("movie_id"), "rating", "split")
    return cut_lineage(s)


_BIAS = {
    "tr": "SELECT userId, movieId, rating FROM split WHERE split = 'train'",
    "c": "SELECT userId, movieId, rating - (SELECT avg(rating) FROM tr) AS r FROM tr",
    "i1": "SELECT movieId, sum(r) / (count(*) + 10.0::DOUBLE) AS b FROM c GROUP BY movieId",
    "u1": "SELECT userId, sum(r - b) / (count(*) + 15.0::DOUBLE) AS b FROM c JOIN i1 USING (movieId) GROUP BY userId",
    "bi": "SELECT movieId, sum(r - b) / (count(*) + 10.0::DOUBLE) AS b FROM c JOIN u1 USING (userId) GROUP BY movieId",
    "bu": "SELECT userId, sum(r - b) / (count(*) + 15.0::DOUBLE) AS b FROM c JOIN bi USING (movieId) GROUP BY userId",
}
_PREDICT = "least(greatest((SELECT avg(rating) FROM tr) + coalesce(bu.b, 0) + coalesce(bi.b, 0), 0.5), 5.0)"


@register("c1_bias_baseline", with_views(["split"], """
SELECT 'user' AS kind, userId AS id, round(b, 6) + 0.0 AS bias FROM bu
UNION ALL SELECT 'item', movieId, round(b, 6) + 0.0 FROM bi""", _BIAS))
def c1_bias_baseline(v):
    b = factor_models.fit_biases(splitting.select_split(_ratings(v), "train"))
    bias = F.round("bias", 6).alias("bias")
    return b.users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), bias).unionByName(
        b.items.select(F.lit("item").alias("kind"), F.col("movie_id").alias("id"), bias)
    )


def _bias_predictions(ratings, pairs):
    return _bias_model(ratings).predict(pairs)


@register("c7_cold_start", with_views(["split"], f"""
SELECT user_id, movie_id, round({_PREDICT}, 6) AS prediction FROM pairs
LEFT JOIN bu ON bu.userId = user_id LEFT JOIN bi ON bi.movieId = movie_id""", {**_BIAS, "pairs": """
SELECT userId AS user_id, movieId AS movie_id FROM split WHERE split = 'val'
UNION ALL SELECT -1 - userId, movieId FROM split WHERE split = 'val'
UNION ALL SELECT userId, -1 - movieId FROM split WHERE split = 'val'
UNION ALL SELECT -1 - userId, -1 - movieId FROM split WHERE split = 'val'"""}))
def c7_cold_start(v):
    """Known, unknown-user, unknown-item and unknown pairs."""
    r = _ratings(v)
    val = splitting.eval_split(r, "val").select("user_id", "movie_id")
    strange = lambda c: (-1 - F.col(c)).alias(c)
    pairs = val
    for cols in ((strange("user_id"), "movie_id"), ("user_id", strange("movie_id")), (strange("user_id"), strange("movie_id"))):
        pairs = pairs.unionByName(val.select(*cols))
    return _bias_predictions(r, pairs).select("user_id", "movie_id", F.round("prediction", 6).alias("prediction"))


@register("a9_rmse", with_views(["split"], f"""
SELECT count(*) AS n, round(sqrt(avg(pow({_PREDICT} - rating, 2))), 6) AS rmse
FROM (SELECT userId AS user_id, movieId AS movie_id, rating FROM split WHERE split = 'val')
LEFT JOIN bu ON bu.userId = user_id LEFT JOIN bi ON bi.movieId = movie_id""", _BIAS))
def a9_rmse(v):
    r = _ratings(v)
    return metrics.rmse(_bias_predictions(r, splitting.eval_split(r, "val"))).select("n", F.round("rmse", 6).alias("rmse"))


@register("t18_clip", with_views(["split"], "SELECT userId, movieId, least(greatest(rating * 1.5::DOUBLE - 1, 0.5), 5.0) AS clipped FROM split"))
def t18_clip(v):
    return split(v).select("userId", "movieId", clip(F.col("rating") * 1.5 - 1).alias("clipped"))


def _fitted(v, algorithm):
    r = _ratings(v)
    return r, factor_models.FactorModel(algorithm).fit(splitting.select_split(r, "train"))


def _training_error(model, r):
    """Root mean squared error of a model on its training ratings, as a one-row subquery."""
    return metrics.rmse(model.predict(splitting.select_split(r, "train"))).select("rmse").scalar()


_ON_SCALE = "prediction BETWEEN 0.5 AND 5.0"


def _predict_query(algorithm):
    def body(v):
        r, model = _fitted(v, algorithm)
        biases = metrics.rmse(_bias_predictions(r, splitting.select_split(r, "train"))).select("rmse").scalar()
        return model.predict(splitting.eval_split(r, "val")).select(
            "user_id", "movie_id", "rating", F.expr(_ON_SCALE).alias("on_scale"),
            (_training_error(model, r) < biases).alias("closer_than_biases"))
    body.__doc__ = f"""Predictions of {algorithm} for every validation rating: a prediction on the scale for each, by a
    model whose error on the training ratings is below that of the biases alone (the values have no SQL form)."""
    return body


_PREDICT_ORACLE = with_views(["split"], """
SELECT userId AS user_id, movieId AS movie_id, rating, true AS on_scale, true AS closer_than_biases FROM split WHERE split = 'val'""")
register("c1_svd_predict", _PREDICT_ORACLE)(_predict_query("svd"))
register("c2_svdpp_predict", _PREDICT_ORACLE)(_predict_query("svdpp"))


@register("c3_nmf_factors", with_views(["split"], f"""
SELECT kind, id, {factor_models.ALGORITHMS["nmf"]["n_factors"]} AS n_factors, true AS non_negative, true AS informative, true AS closer_than_mean FROM (
  SELECT DISTINCT 'user' AS kind, userId AS id FROM tr UNION ALL SELECT DISTINCT 'item', movieId FROM tr)""", _BIAS))
def c3_nmf_factors(v):
    """Every training user and item has a vector of full length, without negative values and not all
    zero; together they are closer to the training ratings than the mean is."""
    r, model = _fitted(v, "nmf")
    spread = splitting.select_split(r, "train").agg(F.stddev_pop("rating")).scalar()
    vectors = model.users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "factors").unionByName(
        model.items.select(F.lit("item").alias("kind"), F.col("movie_id").alias("id"), "factors")
    )
    return vectors.select(
        "kind", "id", F.size("factors").alias("n_factors"), (F.array_min("factors") >= 0).alias("non_negative"),
        (F.array_max("factors") > 0).alias("informative"), (_training_error(model, r) < spread).alias("closer_than_mean"),
    )


def _candidates(v: Views):
    return v.movies_raw.select(F.col("movieId").alias("movie_id"), "title")


# Rows that every list of the ten best must have; titles come from the catalogue.
@register("c5_cf_topn", with_views(["split", "movies"], """
SELECT user_id, rank, true AS in_order, true AS on_scale, true AS unrated, true AS titled FROM
(SELECT userId AS user_id, (SELECT count(*) FROM movies) - count(*) FILTER (split = 'train') AS open FROM split GROUP BY userId),
(SELECT unnest(range(1, 11)) AS rank) WHERE rank <= open"""))
def c5_cf_topn(v):
    """Ten recommendations of svd for every user: as many as there are, in order, on the scale, not rated before, with the item's title."""
    r, model = _fitted(v, "svd")
    found = cut_lineage(model.recommend(r.select("user_id").distinct(), _candidates(v), 10))
    rated = splitting.select_split(r, "train").select("user_id", "movie_id", F.lit(True).alias("rated"))
    titles = v.movies_raw.select(F.col("movieId").alias("movie_id"), F.col("title").alias("own_title"))
    before = F.lag("predicted_rating").over(Window.partitionBy("user_id").orderBy("rank"))  # ten rows a user
    return found.join(rated, ["user_id", "movie_id"], "left").join(titles, "movie_id", "left").select(
        "user_id", F.col("rank").cast("bigint").alias("rank"), F.coalesce(F.col("predicted_rating") <= before, F.lit(True)).alias("in_order"),
        F.col("predicted_rating").between(0.5, 5.0).alias("on_scale"), F.col("rated").isNull().alias("unrated"),
        F.coalesce(F.col("title") == F.col("own_title"), F.lit(False)).alias("titled"))


def _bias_model(r):
    b = factor_models.fit_biases(splitting.select_split(r, "train"))
    none = F.lit(None).cast("array<double>").alias("factors")
    model = factor_models.FactorModel("svd", mean=b.mean, users=cut_lineage(b.users.select("*", none)), items=cut_lineage(b.items.select("*", none)))
    model.rated = splitting.select_split(r, "train").select("user_id", "movie_id")
    return model


# Lists of the biases alone: scores, lists, metrics and error in SQL.
_BIAS_LISTS = {
    "sc": """SELECT u.userId, movieId, round(least(greatest((SELECT avg(rating) FROM tr) + coalesce(bu.b, 0) + coalesce(bi.b, 0), 0.5), 5.0), 10) AS score
        FROM (SELECT DISTINCT userId FROM split) u CROSS JOIN movies LEFT JOIN bu ON bu.userId = u.userId LEFT JOIN bi USING (movieId)""",
    "rk": """SELECT userId, movieId, score, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS rank
        FROM sc ANTI JOIN tr USING (userId, movieId) QUALIFY rank <= 20""",
    "gt": "SELECT userId, movieId FROM split WHERE split = 'val' AND rating >= 4.0 AND movieId % 7 <> 0 AND userId IN (SELECT userId FROM tr)",
    "ranked_gt": "SELECT gt.userId, gt.movieId, rank FROM gt LEFT JOIN rk USING (userId, movieId)",
    "hits": "SELECT userId, count(*) AS n_gt, " + ", ".join(
        f"count(*) FILTER (rank <= {k}) AS h{k}, coalesce(sum(CASE WHEN rank <= {k} THEN 1 / log2(rank + 1) END), 0) AS g{k}" for k in KS
    ) + " FROM ranked_gt GROUP BY userId",
    "um": "SELECT " + ", ".join(
        f'CASE WHEN h{k} > 0 THEN 1.0::DOUBLE ELSE 0 END AS "hr@{k}", h{k} / {k}::DOUBLE AS "p@{k}", h{k} / n_gt::DOUBLE AS "r@{k}", '
        f'g{k} / list_sum([1 / log2(i + 1) for i in range(1, least(n_gt, {k}) + 1)]) AS "ndcg@{k}"' for k in KS
    ) + " FROM hits",
}
_MEASURES = [f"{name}@{k}" for k in KS for name in metrics.PER_CUTOFF]


@register("c5_bias_topn", with_views(["split", "movies"], """
SELECT userId AS user_id, rank, movieId AS movie_id, title, round(score + 3e-11, 6) AS predicted_rating
FROM rk JOIN movies USING (movieId) WHERE rank <= 10""", {**_BIAS, **{k: _BIAS_LISTS[k] for k in ("sc", "rk")}}))
def c5_bias_topn(v):
    """The same lists with the biases as the model, whose values SQL knows too."""
    r = _ratings(v)
    found = _bias_model(r).recommend(r.select("user_id").distinct(), _candidates(v), 10)
    return found.withColumn("predicted_rating", F.round(F.col("predicted_rating") + 3e-11, 6))


@register("e10_cf_report", with_views(["split", "movies"], f"""
SELECT 'CF_SVD' AS model, count(*) AS n_users, (SELECT round(sqrt(avg(pow({_PREDICT} - rating, 2))), 4)
  FROM (SELECT userId AS user_id, movieId AS movie_id, rating FROM split WHERE split = 'val')
  LEFT JOIN bu ON bu.userId = user_id LEFT JOIN bi ON bi.movieId = movie_id) AS rmse,
  {', '.join(f'round(avg("{m}"), 6) AS "{m}"' for m in _MEASURES)}, {len(_MEASURES) + 1} AS n_best, 3 AS n_lines FROM um""", {**_BIAS, **_BIAS_LISTS}))
def e10_cf_report(v):
    """The report of three models, one absent and one not fitted, read back from its CSV: every seventh item has no
    index and leaves the truth and the lists' hits; with the number of best values and of Markdown lines."""
    r = _ratings(v)
    index = F.when(F.col("movie_id") % 7 != 0, F.col("movie_id") * 2).alias("movie_idx")
    path = scratch_path(v.spark, "report")
    models = [_bias_model(r), None, factor_models.FactorModel("nmf")]
    report = factor_evaluating.full_report(models, r, _candidates(v).select("movie_id", index), KS, csv=path)
    schema = "model STRING, n_users BIGINT, rmse DOUBLE, " + ", ".join(f"`{m}` DOUBLE" for m in _MEASURES)
    return tables.read_results_csv(v.spark, path, schema).select(
        "*", report.best.agg(F.count(F.lit(1))).scalar().alias("n_best"), F.lit(len(report.markdown.splitlines())).alias("n_lines"))


@register("e7_cf_evaluation", with_views(["split"], """
SELECT model, (SELECT count(DISTINCT userId) FROM gt) AS n_users, true AS error_on_scale, true AS shares, true AS grow_with_k
FROM (VALUES ('CF_SVD'), ('CF_SVDPP'), ('CF_NMF')) t(model)""", {
    "tr": "SELECT userId FROM split WHERE split = 'train'",
    "gt": "SELECT userId FROM split WHERE split = 'val' AND rating >= 4.0 AND userId IN (SELECT userId FROM tr)"}))
def e7_cf_evaluation(v):
    """Three fitted models: evaluated users, an error within the scale, shares between 0 and 1, hits and recall that grow with the cut-off."""
    r = _ratings(v)
    models, _ = factor_evaluating.fit_factor_models(r, list(factor_models.ALGORITHMS))
    found = factor_evaluating.report(list(models.values()), r, _candidates(v))
    shares, grow = F.lit(True), F.lit(True)
    for m in _MEASURES:
        shares = shares & F.col(f"`{m}`").between(0, 1)
    for name in ("hr", "r"):
        for low, high in zip(KS[:-1], KS[1:]):
            grow = grow & (F.col(f"`{name}@{low}`") <= F.col(f"`{name}@{high}`"))
    return found.select("model", "n_users", F.col("rmse").between(0.0, 4.5).alias("error_on_scale"), shares.alias("shares"), grow.alias("grow_with_k"))
