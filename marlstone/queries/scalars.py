"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions.maths import distance, in_box
from marlstone.functions.text import blank_comma, java_split, tag_list
from marlstone.operators.geo import code_of, ordinal_of
from marlstone.queries import proxies as px
from marlstone.queries.registry import query


@query(
    "f1_java_split",
    """WITH lines AS (
      SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ',,,'
                        WHEN 2 THEN replace(p_name, ' ', ',,') || ',,'
                        ELSE ',' || p_name END AS line FROM part)
    SELECT p_partkey, CAST(len(parts) AS INTEGER) AS n, array_to_string(parts, '|') AS parts
    FROM (SELECT p_partkey, CASE WHEN line = '' THEN [''] WHEN rtrim(line, ',') = '' THEN []
          ELSE string_split(rtrim(line, ','), ',') END AS parts FROM lines)""",
)
def split_lines(spark, folder):
    key, name = F.col("p_partkey") % 4, F.col("p_name")
    line = (
        F.when(key == 0, "")
        .when(key == 1, ",,,")
        .when(key == 2, F.concat(F.replace(name, F.lit(" "), F.lit(",,")), F.lit(",,")))
        .otherwise(F.concat(F.lit(","), name))
    )
    parts = px.table(spark, folder, "part").select("p_partkey", java_split(line, ",").alias("parts"))
    return parts.select(
        "p_partkey", F.size("parts").alias("n"), F.array_join("parts", "|").alias("parts")
    )


@query(
    "f3_f4_trim_cast",
    """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
           CAST(o_totalprice AS DOUBLE) AS price,
           TRY_CAST(o_orderpriority AS INTEGER) AS bad FROM orders""",
)
def trim_and_cast(spark, folder):
    orders = px.table(spark, folder, "orders")
    padded = F.concat(F.lit("  "), F.get(F.split("o_orderpriority", "-"), F.lit(0)), F.lit(" "))
    return orders.select(
        "o_orderkey",
        F.trim(padded).cast("int").alias("level"),
        F.col("o_totalprice").cast("string").cast("double").alias("price"),
        F.col("o_orderpriority").try_cast("int").alias("bad"),
    )


@query(
    "f5_replace",
    """SELECT doc_id, replace(replace(text, ', ', ' '), '"', '') AS text FROM documents""",
)
def replaced_text(spark, folder):
    documents = px.table(spark, folder, "documents")
    return documents.select("doc_id", blank_comma(F.col("text")).alias("text"))


@query(
    "f6_url_decode",
    f"""WITH {px.PHOTOS}
    SELECT photo_id, CASE WHEN decoded = '' THEN 1 ELSE len(string_split(decoded, ',')) END AS n,
           CASE WHEN decoded = '' THEN '' ELSE replace(decoded, ',', '|') END AS tags FROM photos""",
)
def decoded_tags(spark, folder):
    tags = tag_list(F.col("user_tags"))
    return px.photos(spark, folder).select(
        "photo_id", F.size(tags).cast("bigint").alias("n"), F.array_join(tags, "|").alias("tags")
    )


@query(
    "f6_url_round_trip",
    """SELECT doc_id, text FROM documents""",
)
def url_round_trip(spark, folder):
    documents = px.table(spark, folder, "documents")
    return documents.select("doc_id", F.url_decode(F.url_encode("text")).alias("text"))


@query(
    "f7_f8_arrays",
    f"""WITH {px.MOVIES}
    SELECT item, CAST(len(genres) AS INTEGER) AS n, genres[1] AS first,
           '(' || title || ', ' || array_to_string(genres, ', ') || ')' AS label FROM movies""",
)
def array_text(spark, folder):
    return px.movies(spark, folder).select(
        "item",
        F.size("genres").alias("n"),
        F.element_at("genres", 1).alias("first"),
        F.concat(
            F.lit("("), F.col("title"), F.lit(", "), F.array_join("genres", ", "), F.lit(")")
        ).alias("label"),
    )


@query(
    "f9_concat",
    "SELECT c_custkey, 'Name: ' || c_name || ' in ' || c_nationkey AS label FROM customer",
)
def concatenated(spark, folder):
    return px.table(spark, folder, "customer").select(
        "c_custkey", F.format_string("Name: %s in %d", "c_name", "c_nationkey").alias("label")
    )


@query(
    "f10_f11_math",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, round(sqrt(l_extendedprice), 4) AS root,
           pow(l_quantity, 2) AS square, -l_discount + 0.0 AS negated,
           round(l_extendedprice * (1 - l_discount), 4) AS net,
           round(CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END, 4) AS ratio
    FROM lineitem""",
)
def arithmetic(spark, folder):
    return px.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.round(F.sqrt("l_extendedprice"), 4).alias("root"),
        F.pow("l_quantity", F.lit(2)).alias("square"),
        (-F.col("l_discount") + F.lit(0.0)).alias("negated"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
        F.round(F.try_divide("l_discount", "l_tax"), 4).alias("ratio"),
    )


@query(
    "f12_null_test",
    f"""WITH {px.PICTURES}
    SELECT count(*) FILTER (license IS NOT NULL) AS licensed,
           count(*) FILTER (license IS NULL) AS unlicensed FROM pictures""",
)
def null_test(spark, folder):
    license_ = F.col("license")
    return px.pictures(spark, folder).agg(
        F.count_if(license_.isNotNull()).alias("licensed"),
        F.count_if(license_.isNull()).alias("unlicensed"),
    )


@query(
    "f14_membership",
    f"""WITH {px.MOVIES}
    SELECT item, CAST(list_contains(genres, 'red') AS INTEGER) AS red,
           CAST(title IN ('red ring', 'hot rod') AS INTEGER) AS listed FROM movies""",
)
def membership(spark, folder):
    return px.movies(spark, folder).select(
        "item",
        F.array_contains("genres", "red").cast("int").alias("red"),
        F.col("title").isin("red ring", "hot rod").cast("int").alias("listed"),
    )


@query(
    "f15_f16_maps",
    f"""WITH {px.MOVIES}, {px.PROFILE}
    SELECT item, CAST(p.weight AS INTEGER) AS weight, CASE WHEN p.genre IS NULL THEN 0 ELSE 1 END AS known,
           CAST(p.weight * 2 AS INTEGER) AS doubled, 7 AS added
    FROM movies LEFT JOIN profile p ON p.genre = genres[1]""",
)
def map_functions(spark, folder):
    profile = F.create_map(*[F.lit(v) for pair in px.PROXY_PROFILE.items() for v in pair])
    genre = F.element_at("genres", 1)
    doubled = F.transform_values(profile, lambda _, weight: weight * 2)
    extended = F.map_concat(profile, F.create_map(F.lit("extra"), F.lit(7)))
    return px.movies(spark, folder).select(
        "item",
        F.element_at(profile, genre).alias("weight"),
        F.map_contains_key(profile, genre).cast("int").alias("known"),
        F.element_at(doubled, genre).alias("doubled"),
        F.element_at(extended, F.lit("extra")).alias("added"),
    )


@query(
    "f17_f18_box_distance",
    f"""WITH {px.PICTURES}
    SELECT photo_id,
           CAST(longitude BETWEEN -20 AND 40 AND latitude BETWEEN -10 AND 50 AS INTEGER) AS inside,
           round(sqrt((10 - longitude) * (10 - longitude) + (20 - latitude) * (20 - latitude)), 6) AS d
    FROM pictures""",
)
def box_distance(spark, folder):
    x, y = F.col("longitude"), F.col("latitude")
    box = [F.lit(v) for v in (-20.0, -10.0, 40.0, 50.0)]
    return px.pictures(spark, folder).select(
        "photo_id",
        in_box(x, y, *box).cast("int").alias("inside"),
        F.round(distance(x, y, F.lit(10.0), F.lit(20.0)), 6).alias("d"),
    )


@query(
    "f19_code_id",
    """SELECT c_custkey, n_name AS code, n_nationkey AS ordinal
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def code_and_id(spark, folder):
    boxes = px.boxes(spark, folder)
    customers = px.table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return ordinal_of(code_of(customers, boxes, "c_nationkey"), boxes, "code").select(
        "c_custkey", "code", "ordinal"
    )


@query(
    "f20_flatten",
    f"""WITH {px.MOVIES}
    SELECT item, array_to_string(list_concat(genres, [title, 'x']), '|') AS flat FROM movies""",
)
def flattened(spark, folder):
    nested = F.array(F.col("genres"), F.array(F.col("title"), F.lit("x")))
    return px.movies(spark, folder).select("item", F.array_join(F.flatten(nested), "|").alias("flat"))


@query(
    "f21_boolean",
    """SELECT o_orderkey FROM orders
    WHERE (o_orderstatus = 'F' OR o_totalprice <= 50000) AND NOT (o_orderpriority = '5-LOW')
      AND o_custkey <> 7""",
)
def boolean_algebra(spark, folder):
    status, price = F.col("o_orderstatus") == "F", F.col("o_totalprice") <= 50000
    low, seven = F.col("o_orderpriority") == "5-LOW", F.col("o_custkey") != 7
    return px.table(spark, folder, "orders").where((status | price) & ~low & seven).select("o_orderkey")
