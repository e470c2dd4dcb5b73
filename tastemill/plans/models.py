"""Fitted content-based models and batch fitting with a status table."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import N_RECOMMENDATIONS
from ..operators import recommending, similarity
from ..session import cut_lineage
from ..sources import artifacts
from .specs import SPECS, FeatureGroups, ModelSpec


@dataclass
class ContentModel:
    """Item vectors, neighbour table and title lookup of one recipe."""

    spec: ModelSpec
    features: DataFrame | None = None
    neighbours: DataFrame | None = None
    items: DataFrame | None = None

    def fit(self, groups: FeatureGroups) -> ContentModel:
        self.features = cut_lineage(groups.combined(self.spec))
        self.neighbours = cut_lineage(similarity.neighbours(self.features, self.spec.top_k, self.spec.metric))
        self.items = groups.items.select("movie_idx", "title")
        return self

    def check_fitted(self) -> None:
        if self.features is None or self.items is None:
            raise RuntimeError(f"model '{self.spec.name}' is not fitted")

    def recommend_from_ratings(
        self, requests: DataFrame, n: int = N_RECOMMENDATIONS, strategy: str | None = None
    ) -> DataFrame:
        """Top-n for every user of (user_id, title, rating)."""
        self.check_fitted()
        return recommending.recommend_for_titles(
            requests, self.features, self.items, n, self.spec.metric, strategy or self.spec.strategy
        )

    def similar_movies(self, titles: DataFrame, n: int = N_RECOMMENDATIONS) -> DataFrame:
        self.check_fitted()
        return similarity.similar_by_title(titles, self.neighbours, self.items, n)

    def save(self, base: str) -> None:
        self.check_fitted()
        path = f"{base}/{self.spec.name}"
        artifacts.save_artifacts(path, features=self.features, neighbours=self.neighbours, items=self.items)
        artifacts.save_params(self.items.sparkSession, path, "params", asdict(self.spec))

    @classmethod
    def load(cls, spark: SparkSession, base: str, name: str) -> ContentModel:
        path = f"{base}/{name}"
        params = artifacts.load_params(spark, path, "params")
        params["groups"] = tuple((g, w) for g, w in params["groups"])
        frames = {n: artifacts.load_artifact(spark, path, n) for n in ("features", "neighbours", "items")}
        return cls(ModelSpec(**params), **frames)


def fit_models(
    spark: SparkSession, groups: FeatureGroups, names: list[str] | None = None, out: str | None = None
) -> tuple[dict[str, ContentModel], DataFrame]:
    """Fit recipes on shared groups. One failure does not stop the rest; the
    status table has a row per model."""
    models, status = {}, []
    for name in names or list(SPECS):
        try:
            if name not in SPECS:
                raise ValueError(f"unknown model '{name}'")
            model = ContentModel(SPECS[name]).fit(groups)
            if out:
                model.save(out)
            models[name] = model
            status.append((name, "ok", None))
        except Exception as error:  # reported per model
            status.append((name, "failed", str(error).splitlines()[0]))
    return models, spark.createDataFrame(status, "model STRING, status STRING, error STRING")
