"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone import catalog
from marlstone.functions.text import java_split, place_label, words
from marlstone.operators.relational import at_least_group_mean
from marlstone.plans.geotags import located_pictures
from marlstone.plans.licensing import located_and_licensed, with_license_flag
from marlstone.queries import proxies as px
from marlstone.queries.registry import query


@query(
    "j1_flagged_license_join",
    f"""WITH {px.PICTURES}, {px.LICENCES}
    SELECT p.photo_id, p.longitude, p.latitude, p.license
    FROM pictures p JOIN licences l ON l.Name = p.license
    WHERE p.longitude <> -1.0 AND p.latitude <> -1.0 AND TRY_CAST(l.NonDerivative AS BOOLEAN)""",
)
def flagged_license_join(spark, folder):
    return catalog.run_sql(
        spark,
        """SELECT ip.* FROM {interesting} AS ip JOIN {licences} AS l ON l.Name = ip.license
           WHERE try_cast(l.NonDerivative AS boolean)""",
        interesting=located_and_licensed(px.pictures(spark, folder)),
        licences=px.licences(spark, folder),
    )


@query(
    "p7_flagged_license_frame",
    f"""WITH {px.PICTURES}, {px.LICENCES}
    SELECT license, count(*) AS n FROM pictures JOIN licences ON Name = license
    WHERE longitude <> -1.0 AND latitude <> -1.0 AND TRY_CAST(NonDerivative AS BOOLEAN)
    GROUP BY license""",
)
def flagged_license_frame(spark, folder):
    flagged = with_license_flag(
        located_and_licensed(px.pictures(spark, folder)), px.licences(spark, folder), "NonDerivative"
    )
    return flagged.groupBy("license").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p1_project",
    f"WITH {px.PICTURES} SELECT photo_id, longitude, latitude, license FROM pictures",
)
def project(spark, folder):
    return px.pictures(spark, folder).select("photo_id", "longitude", "latitude", "license")


@query(
    "p3_sentinel_filter",
    f"""WITH {px.PICTURES} SELECT photo_id, longitude, latitude, license FROM pictures
    WHERE license IS NOT NULL AND longitude <> -1.0 AND latitude <> -1.0""",
)
def sentinel_filter(spark, folder):
    return located_and_licensed(px.pictures(spark, folder))


@query("p4_range", "SELECT p_name FROM part WHERE p_size >= 13 AND p_size <= 19")
def closed_range(spark, folder):
    parts = px.table(spark, folder, "part")
    return catalog.run_sql(
        spark,
        "SELECT p_name FROM {parts} WHERE p_size >= :low AND p_size <= :high",
        args={"low": 13, "high": 19},
        parts=parts,
    )


@query("p6_range_chained", "SELECT p_name FROM part WHERE p_size BETWEEN 13 AND 19")
def chained_range(spark, folder):
    parts = px.table(spark, folder, "part")
    return parts.where(F.col("p_size") >= 13).where(F.col("p_size") <= 19).select("p_name")


@query(
    "p5_one_sided",
    """SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE o_totalprice >= 250000""",
)
def one_sided(spark, folder):
    orders = px.table(spark, folder, "orders").where(F.col("o_totalprice") >= 250000)
    customers = px.table(spark, folder, "customer")
    return customers.join(orders, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", "o_orderkey"
    )


@query(
    "p8_token_equals",
    """SELECT p_partkey, count(*) AS n
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
    WHERE word = 'widget' GROUP BY p_partkey""",
)
def token_equals(spark, folder):
    tokens = px.table(spark, folder, "part").select(
        "p_partkey", F.explode(java_split(F.col("p_name"), " ")).alias("word")
    )
    return tokens.where(F.col("word") == "widget").groupBy("p_partkey").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "p11_isin",
    """SELECT p_partkey, p_type FROM part
    WHERE p_type IN ('STANDARD', 'PROMO', 'ECONOMY', 'red', 'blue', 'widget')""",
)
def membership_filter(spark, folder):
    parts = px.table(spark, folder, "part")
    return parts.where(F.col("p_type").isin(px.PROXY_GENRES)).select("p_partkey", "p_type")


@query(
    "p12_line_length",
    "SELECT doc_id, text AS value, CAST(length(text) AS INTEGER) AS len FROM documents",
)
def line_length(spark, folder):
    lines = px.table(spark, folder, "documents")
    return lines.select("doc_id", F.col("text").alias("value"), F.length("text").alias("len"))


@query(
    "p13_tokens",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
)
def tokens(spark, folder):
    return px.table(spark, folder, "part").select(
        "p_partkey", F.explode(words(F.col("p_name"))).alias("word")
    )


@query(
    "p10_at_least_own_mean",
    f"""WITH {px.RATINGS}
    SELECT "user", item, rating FROM ratings
    QUALIFY rating >= sum(rating) OVER (PARTITION BY "user") / count(*) OVER (PARTITION BY "user")""",
)
def at_least_own_mean(spark, folder):
    return at_least_group_mean(px.ratings(spark, folder), ["user"], "rating")


@query(
    "p9_p14_valid_pictures",
    f"""WITH {px.PICTURE_TAGS}
    SELECT photo_id, country, '(' || country || ', ' || array_to_string(tags, ', ') || ')' AS label
    FROM picture_tags""",
)
def valid_pictures(spark, folder):
    valid = located_pictures(px.photos(spark, folder), px.boxes(spark, folder))
    return valid.select(
        "photo_id", "country", place_label(F.col("country"), F.col("tags")).alias("label")
    )


@query(
    "p16_p17_pairs",
    f"""WITH {px.RATINGS}
    SELECT "user", item, 0 AS new_user FROM ratings""",
)
def pairs(spark, folder):
    return px.ratings(spark, folder).select("user", "item", F.lit(0).alias("new_user"))


@query(
    "k14_labelled_names",
    "SELECT 'Name: ' || c_name AS label FROM customer WHERE c_acctbal >= 20",
)
def labelled_names(spark, folder):
    customers = px.table(spark, folder, "customer").where(F.col("c_acctbal") >= 20)
    return customers.select(F.concat(F.lit("Name: "), F.col("c_name")).alias("label"))
