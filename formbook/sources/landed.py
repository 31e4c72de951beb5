"""Landed JSON documents: match lists, standings, news."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LANDED_SCHEMA = T.StructType(
    [
        T.StructField(
            "matches",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType()),
                        T.StructField("utcDate", T.StringType()),
                        T.StructField("status", T.StringType()),
                        T.StructField("matchday", T.IntegerType()),
                        T.StructField("homeTeam", T.StructType([T.StructField("name", T.StringType())])),
                        T.StructField("awayTeam", T.StructType([T.StructField("name", T.StringType())])),
                        T.StructField(
                            "score",
                            T.StructType(
                                [
                                    T.StructField("home", T.LongType()),
                                    T.StructField("away", T.LongType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


STANDINGS_SCHEMA = (
    "standings array<struct<type: string, table: array<struct<position: int, team: struct<name: string>, "
    "playedGames: long, won: long, draw: long, lost: long, points: long, goalsFor: long, goalsAgainst: long, "
    "goalDifference: long>>>>"
)
NEWS_SCHEMA = (
    "articles array<struct<title: string, description: string, url: string, source: struct<name: string>, publishedAt: string>>"
)
BROKEN = "_broken"


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The documents that can be read, and ``file, reason, document`` of those that cannot.

    A document per line, or with ``multi_line`` per file. A broken document, or one without any of the schema's
    fields, costs no other one.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lenient = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    df = spark.read.schema(lenient).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, multiLine=multi_line)
    fields = schema.names
    nothing = ~F.array_contains(F.array(*[F.col(n).isNotNull() for n in fields]), True)
    reason = F.when(F.col(BROKEN).isNotNull(), "malformed").when(nothing, "no known field")
    df = df.withColumns({"_file": F.col("_metadata.file_path"), "_reason": reason})
    bad = df.filter(F.col("_reason").isNotNull())
    return df.filter(F.col("_reason").isNull()).select(*fields), bad.select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col(BROKEN).alias("document")
    )


def match_rows_of(documents: DataFrame) -> DataFrame:
    """One row per match out of documents with a ``matches`` list."""
    return documents.select(F.explode("matches").alias("m")).select(
        F.col("m.id").alias("match_id"),
        F.col("m.utcDate").cast("timestamp_ntz").alias("date"),
        F.col("m.status").alias("status"),
        F.col("m.matchday").alias("matchday"),
        F.col("m.homeTeam.name").alias("home_team"),
        F.col("m.awayTeam.name").alias("away_team"),
        F.col("m.score.home").alias("home_goals"),
        F.col("m.score.away").alias("away_goals"),
    )


def read_landed_matches(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per match out of documents with a ``matches`` list.

    A document per line, or with ``multi_line`` per file. A malformed document fails the read; ``read_documents``
    reports it instead.
    """
    return match_rows_of(spark.read.schema(LANDED_SCHEMA).json(path, mode="FAILFAST", multiLine=multi_line))


def standings_of(documents: DataFrame) -> DataFrame:
    """Rows of the first table of each document, in order of place."""
    table = F.get(F.col("standings"), F.lit(0))["table"]
    return documents.select(F.explode(table).alias("t")).select(
        F.col("t.position").alias("position"),
        F.col("t.team.name").alias("team"),
        *[
            F.col(f"t.{a}").alias(b)
            for a, b in (
                ("playedGames", "played"), ("won", "won"), ("draw", "drawn"), ("lost", "lost"), ("points", "points"),
                ("goalsFor", "goals_for"), ("goalsAgainst", "goals_against"), ("goalDifference", "goal_difference"),
            )
        ],
    )


def news_of(documents: DataFrame, n: int | None = 10) -> DataFrame:
    """The first ``n`` articles of each document, in its order; all without ``n``."""
    articles = F.slice("articles", 1, n) if n else F.col("articles")
    return documents.select(F.posexplode(articles).alias("place", "a")).select(
        "place",
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.col("a.url").alias("url"),
        F.col("a.source.name").alias("source"),
        F.col("a.publishedAt").cast("timestamp_ntz").alias("published"),
    )


def as_documents(matches: DataFrame, page: int = 100) -> DataFrame:
    """Matches as documents of at most ``page`` consecutive ids each."""
    match = F.struct(
        F.col("match_id").alias("id"),
        F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("utcDate"),
        "status",
        "matchday",
        F.struct(F.col("home_team").alias("name")).alias("homeTeam"),
        F.struct(F.col("away_team").alias("name")).alias("awayTeam"),
        F.struct(F.col("home_goals").alias("home"), F.col("away_goals").alias("away")).alias("score"),
    )
    return (
        matches.groupBy(F.floor(F.col("match_id") / page).alias("page"))
        .agg(F.collect_list(match).alias("matches"))
        .select("matches")
    )


def as_standings(table: DataFrame) -> DataFrame:
    """A league table, which has a row per team of one league, as one document in its order."""
    line = F.struct(
        F.col("team").alias("name"), "played", "won", "drawn", "lost", "points", "goals_for", "goals_against", "goal_difference"
    )
    order = F.struct(-F.col("points"), -F.col("goal_difference"), -F.col("goals_for"), "team", line.alias("l"))
    lines = table.agg(F.array_sort(F.collect_list(order)).alias("lines"))
    rows = F.transform(
        "lines",
        lambda x, i: F.struct(
            (i + 1).alias("position"),
            F.struct(x["l"]["name"].alias("name")).alias("team"),
            x["l"]["played"].alias("playedGames"),
            x["l"]["won"].alias("won"),
            x["l"]["drawn"].alias("draw"),
            x["l"]["lost"].alias("lost"),
            x["l"]["points"].alias("points"),
            x["l"]["goals_for"].alias("goalsFor"),
            x["l"]["goals_against"].alias("goalsAgainst"),
            x["l"]["goal_difference"].alias("goalDifference"),
        ),
    )
    return lines.select(F.array(F.struct(F.lit("TOTAL").alias("type"), rows.alias("table"))).alias("standings"))


def as_news(articles: DataFrame, page: int = 100) -> DataFrame:
    """Articles ``id, published, title, source`` as documents of at most ``page`` consecutive ids, newest first."""
    article = F.struct(
        "published",
        "id",
        F.struct(
            "title",
            F.concat(F.lit("https://news.example/"), F.col("id").cast("string")).alias("url"),
            F.struct(F.col("source").alias("name")).alias("source"),
            F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("publishedAt"),
        ).alias("a"),
    )
    pages = articles.groupBy(F.floor(F.col("id") / page).alias("page"))
    ordered = F.sort_array(F.collect_list(article), asc=False)
    return pages.agg(F.transform(ordered, lambda x: x["a"]).alias("articles")).select("articles")
