"""Views that present the star-schema test tables in this library's schemas.

``Views(spark, sf_dir)`` gives DataFrames; ``DUCKDB`` holds the same views as
SQL for the oracle side.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

# Activity thresholds that fit the test tables.
VIEW_MIN_USER = 20
VIEW_MIN_MOVIE = 20

# Genre vocabulary of the test tables (part types).
VIEW_GENRES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


# Schemas of the test tables: declared, so that no scan starts a footer-reading job.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")

    def _spread(self, df: DataFrame) -> DataFrame:
        """A plain scan with fewer splits than cores is small: use all cores."""
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    @cached_property
    def _purchases(self) -> DataFrame:
        return self.table("orders").select("o_orderkey", "o_custkey").join(
            self._spread(self.table("lineitem").select(
                "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"
            )),
            F.col("o_orderkey") == F.col("l_orderkey"),
        )

    @property
    def _day(self):
        return F.datediff("l_shipdate", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400

    @cached_property
    def ratings(self) -> DataFrame:
        """Latest rating per (user, item): one aggregation, no window. Written,
        as a ratings table would be: most operators read it more than once. Dealt out
        before the aggregation: its buffers are sorted, which a partial one would do twice."""
        newest = F.struct("l_shipdate", "l_orderkey", "l_linenumber")
        value = F.struct(
            (F.ceil(F.col("l_quantity") / 5.0) / 2.0).alias("rating"), self._day.alias("timestamp")
        )
        return cut_lineage(
            self._purchases.select("o_custkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
            .repartition("o_custkey", "l_partkey")
            .groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
            .agg(F.max_by(value, newest).alias("r"))
            .select("userId", "movieId", "r.rating", "r.timestamp")
        )

    @cached_property
    def movies_raw(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS movieId",
            "CASE WHEN p_partkey % 40 = 0 THEN p_name "
            "ELSE concat(p_name, ' (', CAST(1950 + p_size AS STRING), ')') END AS title",
            "CASE WHEN p_partkey % 50 = 0 THEN '(no genres listed)' "
            "ELSE concat(p_type, '|', p_brand) END AS genres",
        )

    @cached_property
    def links_raw(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS movieId",
            "lpad(CAST(p_partkey AS STRING), 7, '0') AS imdbId",
            "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_partkey + 100000 AS STRING) END AS tmdbId",
        )

    @cached_property
    def tags_raw(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_mktsegment")
        part = self.table("part").select("p_partkey", "p_name")
        return (
            self._purchases.join(customer.hint("merge"), F.col("c_custkey") == F.col("o_custkey"))
            .join(part.hint("merge"), F.col("p_partkey") == F.col("l_partkey"))
            .select(
                F.col("o_custkey").alias("userId"),
                F.col("l_partkey").alias("movieId"),
                F.expr(
                    "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
                    "ELSE concat('  ', c_mktsegment, ' ', p_name, ' ') END"
                ).alias("tag"),
                self._day.alias("timestamp"),
            )
        )

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("movie_idx"), F.col("embedding").cast("array<double>").alias("features")
        )

    @cached_property
    def genome_scores(self) -> DataFrame:
        return (
            self.table("embeddings")
            .select(F.col("vec_id").alias("movieId"), F.posexplode("embedding").alias("pos", "x"))
            .select(
                "movieId", (F.col("pos") + 1).alias("tagId"),
                F.round((F.col("x").cast("double") + 1) / 2, 6).alias("relevance"),
            )
        )

    @cached_property
    def metadata_raw(self) -> DataFrame:
        suppliers = self.table("lineitem").groupBy("l_partkey").agg(
            F.sort_array(F.collect_set("l_suppkey")).alias("ks")
        )
        body = F.expr(
            """CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE to_json(struct(
              concat('About ', p_name) AS overview,
              CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE concat('/', p_partkey, '.jpg') END AS poster_path,
              p_size + 60 AS runtime, p_retailprice / 200 AS vote_average,
              array(named_struct('name', p_type)) AS genres,
              named_struct(
                'cast', transform(coalesce(ks, array()), k -> named_struct('name', concat('Supplier ', k))),
                'crew', CASE WHEN p_partkey % 9 = 0 THEN array(named_struct('job', 'Producer', 'name', p_brand))
                  ELSE array(named_struct('job', 'Producer', 'name', p_brand),
                             named_struct('job', 'Director', 'name', concat('Dir ', p_brand))) END) AS credits)) END"""
        )
        return (
            self.table("part").join(suppliers, F.col("l_partkey") == F.col("p_partkey"), "left")
            .select((F.col("p_partkey") + 100000).alias("tmdbId"), body.alias("raw"))
        )

    @cached_property
    def feed(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id", "event_type AS title", "value AS rating", "ts", "event_id",
            "CASE WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 10 = 0 "
            "THEN 'delete' ELSE 'upsert' END AS op",
        )

    @cached_property
    def documents(self) -> DataFrame:
        return self._spread(self.table("documents"))


_DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400"

# The same views for the oracle engine, in dependency order.
DUCKDB = {
    "ratings": f"""SELECT userId, movieId, rating, "timestamp" FROM (
        SELECT o_custkey AS userId, l_partkey AS movieId,
               ceil(l_quantity / CAST(5 AS DOUBLE)) / CAST(2 AS DOUBLE) AS rating,
               {_DAY} AS "timestamp",
               row_number() OVER (PARTITION BY o_custkey, l_partkey
                 ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey) r WHERE rn = 1""",
    "movies": """SELECT p_partkey AS movieId,
        CASE WHEN p_partkey % 40 = 0 THEN p_name
             ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
        CASE WHEN p_partkey % 50 = 0 THEN '(no genres listed)'
             ELSE concat(p_type, '|', p_brand) END AS genres FROM part""",
    "movies_pre": r"""SELECT *,
        CAST(nullif(regexp_extract(title, '\((\d{4})\)$', 1), '') AS INT) AS year,
        trim(regexp_replace(title, '\s*\(\d{4}\)$', '')) AS title_clean,
        CASE WHEN genres = '(no genres listed)' THEN CAST([] AS VARCHAR[])
             ELSE string_split(genres, '|') END AS genres_list FROM movies""",
    "links": """SELECT p_partkey AS movieId, lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS imdbId,
        CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey + 100000 END AS tmdbId FROM part""",
    "tags": f"""SELECT o_custkey AS userId, l_partkey AS movieId,
        trim(lower(coalesce(CASE WHEN l_orderkey % 97 = 0 THEN NULL
             ELSE concat('  ', c_mktsegment, ' ', p_name, ' ') END, ''))) AS tag,
        {_DAY} AS "timestamp"
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey""",
    "genome_scores": """SELECT vec_id AS movieId, generate_subscripts(embedding, 1) AS tagId,
        round((CAST(unnest(embedding) AS DOUBLE) + 1) / 2, 6) AS relevance FROM embeddings""",
    "ps": """SELECT l_partkey, list_sort(list(DISTINCT l_suppkey)) AS ks FROM lineitem GROUP BY l_partkey""",
    "metadata": """SELECT p_partkey + 100000 AS tmdbId, concat('About ', p_name) AS overview,
        CASE WHEN p_partkey % 7 <> 0
             THEN concat('https://image.tmdb.org/t/p/w500/', p_partkey, '.jpg') END AS poster_url,
        p_size + 60 AS runtime_min, p_retailprice / 200 AS vote_average, p_type AS tmdb_genres,
        array_to_string(list_transform(ks[1:5], lambda k: concat('Supplier ', k)), '|') AS cast_names,
        CASE WHEN p_partkey % 9 <> 0 THEN concat('Dir ', p_brand) END AS director
        FROM part LEFT JOIN ps ON l_partkey = p_partkey WHERE p_partkey % 13 <> 0""",
    "active": """SELECT * FROM ratings SEMI JOIN
        (SELECT userId FROM ratings GROUP BY userId HAVING count(*) >= 20) u USING (userId)""",
    "filtered": """SELECT * FROM active SEMI JOIN
        (SELECT movieId FROM active GROUP BY movieId HAVING count(*) >= 20) m USING (movieId)""",
    "ranked": """SELECT *, count(*) OVER (PARTITION BY userId) AS n,
        row_number() OVER (PARTITION BY userId ORDER BY "timestamp", movieId) AS k FROM filtered""",
    "split": """SELECT userId, movieId, rating, "timestamp",
        CASE WHEN n < 5 THEN 'train' WHEN k > n - t THEN 'test'
             WHEN k > n - 2 * t THEN 'val' ELSE 'train' END AS split
        FROM (SELECT *, greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) AS t FROM ranked)""",
    "emb": """SELECT vec_id AS movie_idx, CAST(embedding AS DOUBLE[]) AS v FROM embeddings""",
    "feed": """SELECT user_id, event_type AS title, value AS rating, ts, event_id,
        CASE WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 10 = 0
             THEN 'delete' ELSE 'upsert' END AS op FROM events""",
}

_NEEDS = {
    "movies_pre": ["movies"], "metadata": ["ps"], "active": ["ratings"],
    "filtered": ["ratings", "active"], "ranked": ["ratings", "active", "filtered"],
    "split": ["ratings", "active", "filtered", "ranked"],
}


def with_views(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """Oracle SQL: WITH clause of the needed views in order, then the body."""
    wanted = {n for name in names for n in [*_NEEDS.get(name, []), name]}
    ctes = [f"{n} AS ({sql})" for n, sql in DUCKDB.items() if n in wanted]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body
