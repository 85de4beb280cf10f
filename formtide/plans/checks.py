"""One named query per operator over the given tables, and the same in SQL for another engine."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.config import ParsingConfig, SelectionConfig
from formtide.functions import encode, metrics
from formtide.operators import changes, lookup, reshape, rolling, select
from formtide.plans.jobs import form_lookups, with_features
from formtide.plans.model import fit_win_model, numbered, vector_columns
from formtide.plans.standin import MATCHES_SQL, matches, table
from formtide.session import materialize, shared_dir
from formtide.sources import records
from formtide.sources.csv import load_results, load_with_rejects, typed_results
from formtide.sources.tables import FeatureTable, TableStore, key_violations
from formtide.streaming.upsert import SyncedTable

TRAINED_TO = "1999-12-31"
VALID_FROM = "1999-12-01"
KEYS = ["date", "team_1", "team_2", "map_name"]
SELECTION = SelectionConfig(
    features=("team_1", "team_2", "map_name", "starting_ct", "rank_1", "rank_2"),
    categories=("team_1", "team_2", "map_name"),
    date_column="date",
    target="map_winner",
)
QUICK_FIT = {"n_estimators": 20}, {"early_stopping": 5}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name; in ``oracle`` the stand-in matches are called ``matches``."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            body = oracle.strip()
            if "matches" in body:
                rest = body[len("WITH ") :] if body.startswith("WITH ") else None
                head = f"WITH matches AS ({MATCHES_SQL})"
                body = f"{head}, {rest}" if rest else f"{head} {body}"
            ORACLES[fn.__name__] = body
        return fn

    return register


def sides_of(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.side_rows(matches(spark, folder))


def tagged(name: str, **frames: DataFrame) -> DataFrame:
    """All frames as one, with the name of its frame on each row."""
    named = [df.withColumn(name, F.lit(tag)) for tag, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def feature_tables(spark: SparkSession, folder: str) -> tuple[FeatureTable, FeatureTable]:
    """Both feature tables, stored, as lookups read them."""
    sides = sides_of(spark, folder)
    overall = materialize(rolling.overall_form(sides), "overall")
    per_map = materialize(rolling.map_form(sides), "per-map")
    return (
        FeatureTable(overall, ("team_name",), "date", "overall", checked=True),
        FeatureTable(per_map, ("map_name", "team_name"), "date", "per_map", checked=True),
    )


SIDES_SQL = """
  SELECT date, map_name, map_winner, 'team_1' AS team_id, team_1 AS team_name,
         CAST(CAST(map_winner = 1 AS INT) AS FLOAT) AS has_won FROM matches
  UNION ALL
  SELECT date, map_name, map_winner, 'team_2', team_2, CAST(CAST(map_winner = 2 AS INT) AS FLOAT) FROM matches
"""
DAYS_SQL = f"""sides AS ({SIDES_SQL}),
days AS (
  SELECT date, team_name, CAST(sum(has_won) AS DOUBLE) AS has_won, count(*) AS matches_played
  FROM sides GROUP BY date, team_name),
map_days AS (
  SELECT date, map_name, team_name, CAST(sum(has_won) AS DOUBLE) AS has_won, count(*) AS matches_played
  FROM sides GROUP BY date, map_name, team_name)"""
FORM_SQL = f"""{DAYS_SQL},
overall AS (
  SELECT date, team_name,
         CAST(coalesce(sum(has_won) OVER w / sum(matches_played) OVER w, -1.0) AS DOUBLE)
           AS last_10_match_day_winshare,
         CAST(coalesce(sum(matches_played) OVER w, 0) AS DOUBLE) AS last_10_days_match_count
  FROM days
  WINDOW w AS (PARTITION BY team_name ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
per_map AS (
  SELECT date, map_name, team_name,
         CAST(coalesce(sum(has_won) OVER w / sum(matches_played) OVER w, -1.0) AS DOUBLE)
           AS last_10_match_day_win_share_for_map,
         CAST(coalesce(sum(matches_played) OVER w, 0) AS DOUBLE) AS last_10_days_match_count_for_map
  FROM map_days
  WINDOW w AS (PARTITION BY map_name, team_name ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))"""


# --- sources, projections, splits -----------------------------------------------------------------------------


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS match_id, o_orderstatus AS map_name,
           o_orderpriority AS team_1,
           TRY_CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown'
                         WHEN o_orderstatus = 'P' THEN '1996-13-45'
                         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS TIMESTAMP) AS date
    FROM orders
    """
)
def typed_scan(spark: SparkSession, folder: str) -> DataFrame:
    text = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.col("o_orderstatus").alias("_map"),
        F.col("o_orderpriority").alias("team_1"),
        F.when(F.col("o_orderpriority") == "5-LOW", "unknown")
        .when(F.col("o_orderstatus") == "P", "1996-13-45")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date"),
        F.col("o_totalprice").cast("string").alias("unused"),
    )
    parsing = ParsingConfig(
        categories=("team_1", "map_name"), date_column="date", rename={"_map": "map_name"}, types={"match_id": "bigint"}
    )
    return typed_results(text, ["match_id", "absent", "_map", "team_1", "date"], parsing)


CSV_PARSING = ParsingConfig(
    categories=("team_1", "map_name"), date_column="date", rename={"_map": "map_name"}, types={"match_id": "bigint", "rank_1": "int"}
)
CSV_COLUMNS = ["match_id", "_map", "team_1", "date", "rank_1"]


def _orders_csv(spark: SparkSession, folder: str) -> str:
    """A CSV file of the orders, with quotes, commas and line breaks in values, and some numbers and dates that are none."""
    lines = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.col("o_orderstatus").alias("_map"),
        F.concat(F.lit('says "'), F.col("o_orderpriority"), F.lit('",\nthen goes on')).alias("team_1"),
        F.when(F.col("o_orderstatus") == "P", "1996-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("o_orderpriority") == "5-LOW", "low").when(F.col("o_orderpriority") == "1-URGENT", "NA").otherwise("7").alias("rank_1"),
    )
    path = f"{shared_dir(spark)}/orders-{uuid.uuid4().hex}.csv"
    lines.write.options(header=True, quote='"', escape='"').csv(path)
    return path


@query(
    """
    SELECT CAST(o_orderkey AS BIGINT) AS match_id, o_orderstatus AS map_name,
           'says "' || o_orderpriority || '",' || chr(10) || 'then goes on' AS team_1,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) END AS date,
           CASE WHEN o_orderpriority NOT IN ('5-LOW', '1-URGENT') THEN 7 END AS rank_1
    FROM orders
    """
)
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return load_results(spark, _orders_csv(spark, folder), CSV_COLUMNS, CSV_PARSING, strict=True)


@query(
    """
    SELECT 'date' AS "column", '1996-13-45' AS value, 'time' AS expected FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'rank_1', 'low', 'int' FROM orders WHERE o_orderpriority = '5-LOW'
    """
)
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return load_with_rejects(spark, _orders_csv(spark, folder), CSV_COLUMNS, CSV_PARSING)[1]


@query("SELECT date, team_1, team_2, map_name, starting_ct, rank_1, rank_2, map_winner FROM matches")
def select_features(spark: SparkSession, folder: str) -> DataFrame:
    wanted = SelectionConfig(features=(*SELECTION.features, "absent"), date_column="date", target="map_winner")
    return select.select_model_columns(matches(spark, folder), wanted)


@query(
    """
    SELECT 'features' AS part, team_1, team_2, map_name, starting_ct, rank_1, rank_2, NULL AS map_winner FROM matches
    UNION ALL
    SELECT 'target', NULL, NULL, NULL, NULL, NULL, NULL, map_winner FROM matches
    """
)
def feature_target_split(spark: SparkSession, folder: str) -> DataFrame:
    features, target = select.features_and_target(matches(spark, folder), SELECTION)
    return tagged("part", features=features, target=target)


@query(
    f"""
    SELECT *, CASE WHEN date <= DATE '{TRAINED_TO}' THEN 'train' ELSE 'test' END AS part
    FROM matches WHERE date IS NOT NULL
    """
)
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = select.temporal_split(matches(spark, folder), TRAINED_TO)
    return tagged("part", train=train, test=test)


@query(
    f"""
    SELECT *, CASE WHEN date < DATE '{VALID_FROM}' THEN 'train' ELSE 'validation' END AS part
    FROM matches WHERE date <= DATE '{TRAINED_TO}'
    """
)
def validation_split(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = select.temporal_split(matches(spark, folder), TRAINED_TO)
    early, late = select.validation_split(train, VALID_FROM)
    return tagged("part", train=early, validation=late)


@query(
    f"""
    SELECT CASE WHEN date <= DATE '{TRAINED_TO}' THEN 'train' ELSE 'test' END AS part,
           min(date) AS first, max(date) AS last
    FROM matches WHERE date IS NOT NULL GROUP BY 1
    """
)
def split_bounds(spark: SparkSession, folder: str) -> DataFrame:
    train, test = select.temporal_split(matches(spark, folder), TRAINED_TO)
    return tagged("part", train=select.time_bounds(train), test=select.time_bounds(test))


@query(
    f"""
    SELECT * FROM matches WHERE date <= DATE '{TRAINED_TO}'
    UNION ALL SELECT * FROM matches WHERE date > DATE '{TRAINED_TO}'
    """
)
def union_splits(spark: SparkSession, folder: str) -> DataFrame:
    return select.union_splits(*select.temporal_split(matches(spark, folder), TRAINED_TO))


def _predicted(spark: SparkSession, folder: str) -> DataFrame:
    return matches(spark, folder).withColumn("prediction", F.when(F.col("rank_1") < F.col("rank_2"), 1).otherwise(2))


PUBLISHED_SQL = """
  SELECT DISTINCT date, team_1, team_2, map_name, CASE WHEN rank_1 < rank_2 THEN 1 ELSE 2 END AS prediction
  FROM matches
"""


@query(PUBLISHED_SQL)
def distinct_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return select.publishable(_predicted(spark, folder), [*KEYS, "prediction"])


@query(
    f"""
    SELECT date, team_1, team_2, map_name, count(*) AS n_rows FROM ({PUBLISHED_SQL})
    GROUP BY date, team_1, team_2, map_name
    HAVING count(*) > 1 OR date IS NULL OR team_1 IS NULL OR team_2 IS NULL OR map_name IS NULL
    """
)
def published_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return key_violations(select.publishable(_predicted(spark, folder), [*KEYS, "prediction"]), KEYS)


@query(
    f"""
    WITH sides AS ({SIDES_SQL})
    SELECT map_name, team_name, date, count(*) AS n_rows FROM sides
    GROUP BY map_name, team_name, date
    HAVING count(*) > 1 OR map_name IS NULL OR team_name IS NULL OR date IS NULL
    """
)
def feature_key_violations(spark: SparkSession, folder: str) -> DataFrame:
    return key_violations(sides_of(spark, folder), ["map_name", "team_name", "date"])


LIMIT_ORDER = ["date", "team_1", "team_2", "map_name", "map_winner", "starting_ct", "rank_1", "rank_2"]


@query(f"SELECT * FROM matches ORDER BY {', '.join(LIMIT_ORDER)} LIMIT 10")
def limit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return select.first_rows(matches(spark, folder), 10, LIMIT_ORDER)


@query(
    """
    SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(json_extract(props, '$.absent') AS VARCHAR) AS absent
    FROM events
    """
)
def records_to_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return records.expand_records(events, "props", "k bigint, absent string", keep=["event_id", "event_type"])


# --- rolling features -----------------------------------------------------------------------------------------


@query(SIDES_SQL)
def unpivot_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return sides_of(spark, folder)


@query(f"WITH {DAYS_SQL} SELECT date, team_name, has_won, matches_played AS matches FROM days")
def daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.daily_totals(sides_of(spark, folder), ["team_name"])


@query(f"WITH {DAYS_SQL} SELECT date, map_name, team_name, has_won, matches_played AS matches FROM map_days")
def daily_map_totals(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.daily_totals(sides_of(spark, folder), ["map_name", "team_name"])


@query(f"WITH {FORM_SQL} SELECT * FROM overall")
def rolling_winshare(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.overall_form(sides_of(spark, folder))


@query(f"WITH {FORM_SQL} SELECT * FROM per_map")
def rolling_winshare_map(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.map_form(sides_of(spark, folder))


@query(
    f"""
    WITH {DAYS_SQL}
    SELECT date, map_name, team_name,
           CAST(coalesce(sum(has_won) OVER own / sum(matches_played) OVER wide, -1.0) AS DOUBLE)
             AS last_10_match_day_win_share_for_map,
           CAST(coalesce(sum(matches_played) OVER wide, 0) AS DOUBLE) AS last_10_days_match_count_for_map
    FROM map_days
    WINDOW own AS (PARTITION BY map_name, team_name ORDER BY date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING),
           wide AS (PARTITION BY team_name ORDER BY date, map_name ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
    """
)
def rolling_winshare_map_mixed(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.map_form(sides_of(spark, folder), frame="mixed")


# --- lookups --------------------------------------------------------------------------------------------------

ASKED_SQL = """asked AS (
  SELECT o_orderkey, o_orderdate AS date, concat('S', o_orderkey % 120) AS team,
         concat('A', o_orderstatus) AS map_name FROM orders)"""


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("date"),
        F.concat(F.lit("S"), (F.col("o_orderkey") % 120).cast("string")).alias("team"),
        F.concat(F.lit("A"), F.col("o_orderstatus")).alias("map_name"),
    )


@query(
    f"""
    WITH {FORM_SQL}, {ASKED_SQL}
    SELECT a.o_orderkey, a.date, a.team, a.map_name, f.last_10_match_day_winshare AS winshare,
           f.last_10_days_match_count
    FROM asked a ASOF LEFT JOIN overall f ON a.team = f.team_name AND a.date >= f.date
    """
)
def asof_lookup(spark: SparkSession, folder: str) -> DataFrame:
    overall = materialize(rolling.overall_form(sides_of(spark, folder)), "overall")
    features = FeatureTable(overall, ("team_name",), "date", "overall", checked=True)
    renamed = {"last_10_match_day_winshare": "winshare"}
    return lookup.asof_lookup(_asked(spark, folder), lookup.Lookup(features, ("team",), "date", rename=renamed))


@query(
    f"""
    WITH {FORM_SQL}, {ASKED_SQL}
    SELECT a.o_orderkey, a.date, a.team, a.map_name, f.last_10_match_day_win_share_for_map,
           f.last_10_days_match_count_for_map
    FROM asked a ASOF LEFT JOIN per_map f
      ON a.map_name = f.map_name AND a.team = f.team_name AND a.date >= f.date
    """
)
def asof_lookup_composite(spark: SparkSession, folder: str) -> DataFrame:
    per_map = materialize(rolling.map_form(sides_of(spark, folder)), "per-map")
    features = FeatureTable(per_map, ("map_name", "team_name"), "date", "per_map", checked=True)
    return lookup.asof_lookup(_asked(spark, folder), lookup.Lookup(features, ("map_name", "team"), "date"))


def _asof_side(side: str) -> tuple[str, str]:
    columns = f"""
           o_{side}.last_10_match_day_winshare AS {side}_last_10_match_day_winshare,
           o_{side}.last_10_days_match_count AS {side}_last_10_match_day_match_count,
           m_{side}.last_10_match_day_win_share_for_map AS {side}_last_10_match_day_win_share_for_map,
           m_{side}.last_10_days_match_count_for_map AS {side}_last_10_match_day_match_count_for_map"""
    joins = f"""
    ASOF LEFT JOIN overall o_{side} ON b.{side} = o_{side}.team_name AND b.date >= o_{side}.date
    ASOF LEFT JOIN per_map m_{side}
      ON b.map_name = m_{side}.map_name AND b.{side} = m_{side}.team_name AND b.date >= m_{side}.date"""
    return columns, joins


@query(
    f"""
    WITH {FORM_SQL},
    base AS (SELECT * FROM matches
             UNION ALL
             SELECT date + INTERVAL 12 HOUR, team_1, team_2, map_name, map_winner, starting_ct, rank_1, rank_2
             FROM matches)
    SELECT b.date, b.team_1, b.team_2, b.map_name, b.map_winner, b.rank_1, b.rank_2,
           {_asof_side("team_1")[0]}, {_asof_side("team_2")[0]}
    FROM base b {_asof_side("team_1")[1]} {_asof_side("team_2")[1]}
    """
)
def training_set(spark: SparkSession, folder: str) -> DataFrame:
    on_the_day = matches(spark, folder)
    half_a_day = F.expr("INTERVAL 12 HOURS")
    base = on_the_day.unionByName(on_the_day.withColumn("date", F.col("date") + half_a_day))
    return lookup.training_set(base, form_lookups(*feature_tables(spark, folder)), exclude=["starting_ct"])


@query(
    """
    WITH served AS (SELECT date, team_1, team_2, map_name, max(rank_2) AS best, count(*) AS n
                    FROM matches GROUP BY date, team_1, team_2, map_name),
    requests AS (SELECT date, team_1, team_2, CASE WHEN rank_1 = 1 THEN 'AF' ELSE map_name END AS map_name,
                        starting_ct FROM matches)
    SELECT r.date, r.team_1, r.team_2, r.map_name, r.starting_ct, s.best, s.n
    FROM requests r LEFT JOIN served s
      ON r.date = s.date AND r.team_1 = s.team_1 AND r.team_2 = s.team_2 AND r.map_name = s.map_name
    """
)
def keyed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    played = matches(spark, folder)
    served = played.groupBy(*KEYS).agg(F.max("rank_2").alias("best"), F.count(F.lit(1)).alias("n"))
    requests = played.select(
        "date",
        "team_1",
        "team_2",
        F.when(F.col("rank_1") == 1, "AF").otherwise(F.col("map_name")).alias("map_name"),
        "starting_ct",
    )
    return lookup.keyed_lookup(requests, FeatureTable(served, tuple(KEYS), checked=True))


@query(
    """
    SELECT l.l_orderkey, l.l_linenumber, e.event_type, e.value
    FROM lineitem l
    LEFT JOIN (SELECT user_id, max((value, event_type)) AS m, m[1] AS value, m[2] AS event_type FROM events GROUP BY user_id) e
      ON e.user_id = l.l_partkey
    """
)
def keyed_lookup_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A table with many rows of each key; still one row per request, with the greatest features."""
    requests = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    events = FeatureTable(table(spark, folder, "events").select("user_id", "value", "event_type"), ("user_id",))
    return lookup.keyed_lookup(requests, events, ["l_partkey"]).drop("l_partkey")


@query(
    """
    WITH small AS (SELECT CAST(doc_id AS VARCHAR) AS asked, toxic FROM labels),
    requests AS (SELECT * FROM small UNION ALL SELECT 'none', 0 UNION ALL SELECT NULL, 1)
    SELECT r.asked, r.toxic, d.lang, d.source FROM requests r LEFT JOIN documents d ON TRY_CAST(r.asked AS BIGINT) = d.doc_id
    """
)
def keyed_lookup_text_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Requests name their key as text, as they do in JSON; the table has it as a number."""
    asked = table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("asked"), "toxic")
    odd = spark.createDataFrame([("none", 0), (None, 1)], "asked string, toxic int")
    requests = asked.union(odd.select("asked", F.col("toxic").cast(asked.schema["toxic"].dataType)))
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return lookup.keyed_lookup(requests, FeatureTable(documents, ("doc_id",)), ["asked"])


# --- encoding, training, scores -------------------------------------------------------------------------------


@query(
    """
    SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
    FROM (SELECT DISTINCT concat(team_1, ' - ', team_2) AS value FROM matches)
    """
)
def category_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    pairs = matches(spark, folder).select(F.concat_ws(" - ", "team_1", "team_2").alias("pair"))
    return encode.category_dictionary(pairs, "pair")


@query(
    """
    WITH dictionary AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
                        FROM (SELECT DISTINCT team_1 AS value FROM matches))
    SELECT m.date, m.team_1, d.code AS team_2, m.map_name, m.rank_1, m.rank_2
    FROM matches m LEFT JOIN dictionary d ON m.team_2 = d.value
    """
)
def category_encode(spark: SparkSession, folder: str) -> DataFrame:
    played = matches(spark, folder).select("date", "team_1", "team_2", "map_name", "rank_1", "rank_2")
    return encode.category_encode(played, "team_2", encode.category_dictionary(played, "team_1"))


@query(
    """
    SELECT round(avg(-ln(CASE WHEN quality = 1 THEN p ELSE 1 - p END)), 6) AS log_loss
    FROM (SELECT quality, CASE WHEN toxic = 1 THEN 0.3 ELSE 0.8 END::DOUBLE AS p FROM labels)
    WHERE quality IS NOT NULL
    """
)
def log_loss(spark: SparkSession, folder: str) -> DataFrame:
    scored = table(spark, folder, "labels").withColumn("p", F.when(F.col("toxic") == 1, 0.3).otherwise(0.8))
    return metrics.log_loss(scored, "quality", "p").select(F.round("log_loss", 6).alias("log_loss"))


GAPS_SQL = """
    SELECT CASE WHEN doc_id % 7 = 0 THEN NULL ELSE quality END AS quality, toxic,
           CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN 'NaN'::DOUBLE
                WHEN toxic = 1 THEN 0.3 ELSE 0.8 END::DOUBLE AS p,
           CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 1 - toxic END AS said
    FROM labels"""


def _with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Labels with missing labels, probabilities and predictions."""
    place = F.col("doc_id") % 5
    chance = F.when(place == 0, None).when(place == 1, float("nan")).otherwise(F.when(F.col("toxic") == 1, 0.3).otherwise(0.8))
    return table(spark, folder, "labels").select(
        F.when(F.col("doc_id") % 7 != 0, F.col("quality")).alias("quality"),
        "toxic",
        chance.alias("p"),
        F.when(place != 0, 1 - F.col("toxic")).alias("said"),
    )


@query(
    f"""
    WITH gaps AS ({GAPS_SQL})
    SELECT round(avg(-ln(CASE WHEN quality = 1 THEN p ELSE 1 - p END)) FILTER (p IS NOT NULL AND NOT isnan(p)), 6) AS log_loss,
           count(*) FILTER (p IS NULL OR isnan(p)) AS unscored
    FROM gaps WHERE quality IS NOT NULL
    """
)
def log_loss_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    loss = metrics.log_loss(_with_gaps(spark, folder), "quality", "p")
    return loss.select(F.round("log_loss", 6).alias("log_loss"), "unscored")


@query(
    f"""
    WITH gaps AS ({GAPS_SQL})
    SELECT count(*) FILTER (quality IS NULL) AS unlabelled,
           count(*) FILTER (quality IS NOT NULL AND said IS NULL) AS unpredicted
    FROM gaps
    """
)
def report_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.report_gaps(_with_gaps(spark, folder), "quality", "said")


REPORT_SQL = """
    WITH pairs AS ({pairs}),
    classes AS (SELECT y AS c FROM pairs UNION SELECT p FROM pairs WHERE p IS NOT NULL),
    counts AS (
      SELECT c, (SELECT count(*) FROM pairs WHERE y = c AND p = c) AS hit,
             (SELECT count(*) FROM pairs WHERE p = c) AS said, (SELECT count(*) FROM pairs WHERE y = c) AS support
      FROM classes),
    per_class AS (
      SELECT CAST(c AS VARCHAR) AS label, coalesce(hit / nullif(said, 0), 0) AS precision,
             coalesce(hit / nullif(support, 0), 0) AS recall,
             coalesce(2 * hit / nullif(said + support, 0), 0) AS f1_score, support, hit
      FROM counts),
    report AS (
      SELECT label, precision, recall, f1_score, support FROM per_class
      UNION ALL
      SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support)
      FROM per_class
      UNION ALL
      SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM per_class
      UNION ALL
      SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
             sum(f1_score * support) / sum(support), sum(support)
      FROM per_class)
    SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
           CAST(support AS BIGINT) AS support
    FROM report
    """


@query(REPORT_SQL.format(pairs="SELECT quality AS y, 1 - toxic AS p FROM labels"))
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    judged = table(spark, folder, "labels").withColumn("predicted", 1 - F.col("toxic"))
    return _rounded(metrics.classification_report(judged, "quality", "predicted"))


@query(
    REPORT_SQL.format(pairs=f"SELECT quality AS y, said AS p FROM ({GAPS_SQL}) WHERE quality IS NOT NULL")
)
def classification_report_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.classification_report(_with_gaps(spark, folder), "quality", "said"))


def _rounded(report: DataFrame) -> DataFrame:
    scores = ("precision", "recall", "f1_score")
    return report.select("label", *[F.round(c, 6).alias(c) for c in scores], "support")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM matches"
        for c in LIMIT_ORDER
    )
)
def dataset_profile(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.dataset_profile(matches(spark, folder))


def _judged(scored: DataFrame) -> DataFrame:
    """Scores as what must hold of them, since the probabilities themselves are the model's own."""
    one, two = F.col("p_team_1"), F.col("p_team_2")
    larger = F.when(F.col("prediction") == 1, one >= two).otherwise(two >= one)
    return scored.withColumns(
        {
            "names_a_side": F.col("prediction").isin(1, 2),
            "sums_to_one": F.abs(one + two - 1) < 1e-9,
            "takes_the_larger": larger,
        }
    ).drop("prediction", "p_team_1", "p_team_2")


HOLDS_SQL = "true AS names_a_side, true AS sums_to_one, true AS takes_the_larger"


@query(f"SELECT *, {HOLDS_SQL} FROM matches WHERE date > DATE '{TRAINED_TO}'")
def train_score(spark: SparkSession, folder: str) -> DataFrame:
    train, test = select.temporal_split(matches(spark, folder), TRAINED_TO)
    early, late = select.validation_split(train, VALID_FROM)
    return _judged(fit_win_model(early, late, SELECTION, *QUICK_FIT).score(test))


@query(
    f"""
    WITH early AS (SELECT * FROM matches WHERE date < DATE '{VALID_FROM}'),
    one AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS n FROM (SELECT DISTINCT team_1 AS v FROM early)),
    two AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS n FROM (SELECT DISTINCT team_2 AS v FROM early)),
    map AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS n FROM (SELECT DISTINCT map_name AS v FROM early)),
    late AS (SELECT date, CASE WHEN rank_1 = 1 THEN 'nobody' ELSE team_1 END AS team_1, team_2, map_name, starting_ct,
                    CASE WHEN rank_1 <> 2 THEN rank_1 END AS rank_1, rank_2
             FROM matches WHERE date >= DATE '{VALID_FROM}')
    SELECT date, team_1, team_2, map_name, coalesce(one.n, -1)::DOUBLE AS f0, coalesce(two.n, -1)::DOUBLE AS f1,
           coalesce(map.n, -1)::DOUBLE AS f2, coalesce(starting_ct, 0)::DOUBLE AS f3, coalesce(rank_1, 0)::DOUBLE AS f4,
           coalesce(rank_2, 0)::DOUBLE AS f5, (starting_ct IS NOT NULL)::INT::DOUBLE AS f6, (rank_1 IS NOT NULL)::INT::DOUBLE AS f7,
           (rank_2 IS NOT NULL)::INT::DOUBLE AS f8
    FROM late LEFT JOIN one ON one.v = team_1 LEFT JOIN two ON two.v = team_2 LEFT JOIN map ON map.v = map_name
    """
)
def encoded_features(spark: SparkSession, folder: str) -> DataFrame:
    """The vector that a model sees, by dictionaries of the earlier matches; some teams and ranks are unknown."""
    early, late = select.validation_split(matches(spark, folder), VALID_FROM)
    odd = {
        "team_1": F.when(F.col("rank_1") == 1, "nobody").otherwise(F.col("team_1")),
        "rank_1": F.when(F.col("rank_1") != 2, F.col("rank_1")),
    }
    dictionaries = {c: materialize(encode.category_dictionary(early, c), "dictionary") for c in SELECTION.categories}
    columns = vector_columns(SELECTION)
    rows = VectorAssembler(inputCols=columns, outputCol="v").transform(numbered(late.withColumns(odd), SELECTION, dictionaries, {}))
    array = vector_to_array("v")
    return rows.select(*KEYS, *(array[i].alias(f"f{i}") for i in range(len(columns))))


@query(
    f"""
    WITH {FORM_SQL},
    base AS (SELECT * FROM matches WHERE date > DATE '{TRAINED_TO}')
    SELECT b.*, {_asof_side("team_1")[0]}, {_asof_side("team_2")[0]}, {HOLDS_SQL}
    FROM base b {_asof_side("team_1")[1]} {_asof_side("team_2")[1]}
    """
)
def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    lookups = form_lookups(*feature_tables(spark, folder))
    train, test = select.temporal_split(matches(spark, folder), TRAINED_TO)
    rows = materialize(lookup.training_set(train, lookups), "training")
    early, late = select.validation_split(rows, VALID_FROM)
    model = fit_win_model(early, late, with_features(SELECTION, lookups), *QUICK_FIT, lookups)
    return _judged(model.score_batch(test))


# --- changes --------------------------------------------------------------------------------------------------

OLD_TO, NEW_FROM = "2024-01-20", "2024-01-10"


def _snapshot(events: DataFrame) -> DataFrame:
    keyed = records.expand_records(events, "props", "k bigint")
    newest = changes.latest_per_key(keyed, ["user_id", "k"], ["ts", "event_id"])
    return newest.select("user_id", "k", "event_type", "value")


@query(
    f"""
    WITH keyed AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
    old AS (SELECT user_id, k, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
            FROM keyed WHERE ts < TIMESTAMP '{OLD_TO}' GROUP BY user_id, k),
    new AS (SELECT user_id, k, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
            FROM keyed WHERE ts >= TIMESTAMP '{NEW_FROM}' GROUP BY user_id, k),
    diff AS (
      SELECT o.user_id AS ou, o.k AS ok, o.event_type AS oe, o.value AS ov,
             n.user_id AS nu, n.k AS nk, n.event_type AS ne, n.value AS nv
      FROM old o FULL JOIN new n ON o.user_id = n.user_id AND o.k = n.k
      WHERE o.user_id IS NULL OR n.user_id IS NULL
         OR o.event_type IS DISTINCT FROM n.event_type OR o.value IS DISTINCT FROM n.value)
    SELECT nu AS user_id, nk AS k, ne AS event_type, nv AS value, 'insert' AS change_type FROM diff WHERE ou IS NULL
    UNION ALL SELECT ou, ok, oe, ov, 'delete' FROM diff WHERE nu IS NULL
    UNION ALL SELECT ou, ok, oe, ov, 'update_preimage' FROM diff WHERE ou IS NOT NULL AND nu IS NOT NULL
    UNION ALL SELECT nu, nk, ne, nv, 'update_postimage' FROM diff WHERE ou IS NOT NULL AND nu IS NOT NULL
    """
)
def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    old = events.where(F.col("ts") < F.lit(OLD_TO).cast("timestamp_ntz"))
    new = events.where(F.col("ts") >= F.lit(NEW_FROM).cast("timestamp_ntz"))
    return changes.change_feed(_snapshot(old), _snapshot(new), ["user_id", "k"])


def _window_sql(first: str | None, last: str | None) -> str:
    """Newest event per user and k of a span of days."""
    spans = [f"ts >= TIMESTAMP '{first}'" if first else "true", f"ts < TIMESTAMP '{last}'" if last else "true"]
    return f"""(SELECT user_id, k, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
      FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
      WHERE {" AND ".join(spans)} GROUP BY user_id, k)"""


def _window(spark: SparkSession, folder: str, first: str | None, last: str | None) -> DataFrame:
    events, day = table(spark, folder, "events"), lambda text: F.lit(text).cast("timestamp_ntz")
    if first:
        events = events.where(F.col("ts") >= day(first))
    return _snapshot(events.where(F.col("ts") < day(last)) if last else events)


def _diff_sql(old: str, new: str, version: int) -> str:
    return f"""
    SELECT unnest(CASE WHEN o.user_id IS NULL THEN [row(n.user_id, n.k, n.event_type, n.value, 'insert')]
                       WHEN n.user_id IS NULL THEN [row(o.user_id, o.k, o.event_type, o.value, 'delete')]
                       ELSE [row(o.user_id, o.k, o.event_type, o.value, 'update_preimage'),
                             row(n.user_id, n.k, n.event_type, n.value, 'update_postimage')] END) AS r, {version} AS version
    FROM {old} o FULL JOIN {new} n ON o.user_id = n.user_id AND o.k = n.k
    WHERE o.user_id IS NULL OR n.user_id IS NULL
       OR o.event_type IS DISTINCT FROM n.event_type OR o.value IS DISTINCT FROM n.value"""


#: Spans of days whose newest events are the versions of a table: rows come, change and go from each to the next.
SPANS = ((None, "2024-01-12"), ("2024-01-05", "2024-01-18"), ("2024-01-10", "2024-01-22"), ("2024-01-15", "2024-01-26"),
         ("2024-01-20", None), ("2024-01-08", "2024-01-24"), ("2024-01-12", "2024-01-28"))
EVENT_KEYS = ["user_id", "k"]


def _versioned(spark: SparkSession, folder: str, versions: int) -> TableStore:
    """A store in which the table ``newest`` has that many versions."""
    store = TableStore(spark, "events", "newest", f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}")
    for span in SPANS[:versions]:
        store.create_keyed(_window(spark, folder, *span), "newest", EVENT_KEYS, replace=store.exists("newest"))
    return store


@query(
    f"""
    SELECT 'reader' AS read_by, * FROM {_window_sql(*SPANS[0])}
    UNION ALL SELECT 'number', * FROM {_window_sql(*SPANS[0])}
    UNION ALL SELECT 'newest', * FROM {_window_sql(*SPANS[1])}
    """
)
def keyed_table_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A table is replaced while a reader of the version before goes on."""
    store = _versioned(spark, folder, 1)
    reader = store.keyed("newest", EVENT_KEYS).df
    store.create_keyed(_window(spark, folder, *SPANS[1]), "newest", EVENT_KEYS, replace=True)
    return tagged("read_by", reader=reader, number=store.read("newest", version=1), newest=store.read("newest"))


@query(
    "SELECT r[1] AS user_id, r[2] AS k, r[3] AS event_type, r[4] AS value, r[5] AS change_type, CAST(version AS BIGINT) AS version FROM ("
    + " UNION ALL ".join(_diff_sql(_window_sql(*SPANS[v - 2]), _window_sql(*SPANS[v - 1]), v) for v in (2, 3))
    + ")"
)
def table_change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The logged changes of a stored table from its first version to its third."""
    return _versioned(spark, folder, 3).versions("newest", EVENT_KEYS).changes(1, 3)


@query(f"SELECT * FROM {_window_sql(*SPANS[-1])}")
def upsert_with_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """A copy of a table's first version that follows its change log to the last, a file a micro-batch."""
    return _followed(spark, folder).read().drop("version")


def _followed(spark: SparkSession, folder: str) -> SyncedTable:
    source = _versioned(spark, folder, len(SPANS)).versions("newest", EVENT_KEYS)
    first, changes = source.read(1), source.change_stream(maxFilesPerTrigger=1)
    copy = SyncedTable(spark, f"{source.place}/copy", changes.schema, tuple(EVENT_KEYS), ("version",), tombstone="deleted")
    copy.start_from(first)
    copy.sync(changes).awaitTermination()
    return copy


@query(
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """
)
def incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    root = f"{shared_dir(spark)}/synced-{uuid.uuid4().hex}"
    copy = SyncedTable(spark, root, schema, ("user_id", "event_type"), ("ts", "event_id"))
    # As a pattern the path may be one file or a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")
    copy.sync(stream).awaitTermination()
    return copy.read()
