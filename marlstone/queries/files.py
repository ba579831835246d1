"""Sources and sinks: a table goes out in a file format and comes back through the reader for it.

The files lie in the cluster's shared folder, see ``session.shared_dir``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone import catalog
from marlstone.plans.licensing import located_and_licensed
from marlstone.queries import proxies as px
from marlstone.queries.registry import query
from marlstone.session import shared_dir
from marlstone.sources import readers
from marlstone.sources.schemas import CREDIT_FEATURES, CREDIT_LABEL, CREDIT_UNCHANGED, PHOTO_SCHEMA
from marlstone.sources.sinks import write_tsv


@query("s1_s2_lines", "SELECT p_name AS value, count(*) AS n FROM part GROUP BY p_name")
def text_lines(spark, folder):
    path = shared_dir(spark, "lines")
    px.table(spark, folder, "part").select("p_name").write.csv(path, header=True)
    lines = readers.read_lines(spark, path, header=True)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s3_photo_file",
    f"""WITH {px.PHOTOS}, licensed AS (SELECT photo_id AS id, license FROM pictures)
    SELECT photo_id, longitude, latitude, license FROM photos JOIN licensed ON id = photo_id
    WHERE license IS NOT NULL AND longitude <> -1.0 AND latitude <> -1.0""",
)
def photo_file(spark, folder):
    licences = px.pictures(spark, folder).select("photo_id", "license")
    known = px.photos(spark, folder).join(licences, "photo_id").withColumn("marker", F.lit(0))
    columns = [
        (F.col(f.name) if f.name in known.columns else F.lit("x")).cast(f.dataType).alias(f.name)
        for f in PHOTO_SCHEMA
    ]
    path = shared_dir(spark, "photos")
    known.select(*columns).write.csv(path, sep="\t")
    return located_and_licensed(readers.read_photos(spark, path)).withColumns(
        {c: F.col(c).cast("double") for c in ("longitude", "latitude")}
    )


@query("s4_k1_tab_file", f"WITH {px.LICENCES} SELECT Name, nullif(NonDerivative, '') AS NonDerivative FROM licences")
def tab_file(spark, folder):
    path = shared_dir(spark, "licences")
    write_tsv(px.licences(spark, folder), path)
    licences = readers.read_licences(spark, path)
    return licences.select("Name", F.nullif("NonDerivative", F.lit("")).alias("NonDerivative"))


EVENTS = """SELECT event_id, event_type, props, CASE WHEN value > 10 THEN value END AS value,
    CASE WHEN event_id % 1000 = 7 THEN 'gift ' || event_id END AS gift FROM events"""


def _event_lines(spark, folder):
    """Events as JSON lines; one in a thousand has a field that the others lack."""
    path = shared_dir(spark, "events")
    value = F.when(F.col("value") > 10, F.col("value"))
    gift = F.when(F.col("event_id") % 1000 == 7, F.concat(F.lit("gift "), F.col("event_id").cast("string")))
    px.table(spark, folder, "events").select(
        "event_id", "event_type", "props", value.alias("value"), gift.alias("gift")
    ).write.json(path)
    return path


@query("s5_json_file", EVENTS)
def json_file(spark, folder):
    lines = readers.read_json_lines(spark, _event_lines(spark, folder))
    return lines.select("event_id", "event_type", "props", "value", "gift")


@query("s5_json_quarantine", EVENTS)
def json_quarantine(spark, folder):
    """The same from one pass: what the sample's schema lacks is taken from the lines that are set aside."""
    lines = readers.read_json_lines(spark, _event_lines(spark, folder), quarantine="line")
    known = F.col("gift") if "gift" in lines.columns else F.lit(None).cast("string")
    gift = F.coalesce(known, F.get_json_object("line", "$.gift"))
    return lines.select("event_id", "event_type", "props", "value", gift.alias("gift"))


@query(
    "k7_k8_cached_plan",
    """SELECT o_orderstatus, count(*) AS n, 1 AS cached_scans, 1 AS exchanges,
        '[IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]' AS pushed
    FROM orders WHERE o_totalprice > 100000.0 GROUP BY o_orderstatus""",
)
def cached_plan(spark, folder):
    """Counts from a cache, beside the plans before and after: what was pushed to files, what is read now."""
    parent = px.table(spark, folder, "orders").where(F.col("o_totalprice") > 100000.0).select("o_orderstatus")
    before = catalog.plan_facts(parent)
    _, rebuilt = catalog.cached_and_rebuilt(
        parent, lambda df: df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    )

    def steps(name):
        named = F.col("operator").startswith(name) & F.col("fact").isNull()
        return F.count_if(named).cast("int")

    after = catalog.plan_facts(rebuilt).agg(
        steps("InMemoryTableScan").alias("cached_scans"),
        steps("Exchange").alias("exchanges"),
    )
    pushed = before.where("fact = 'PushedFilters'").select(F.col("value").alias("pushed"))
    return rebuilt.join(F.broadcast(after)).join(F.broadcast(pushed))


@query(
    "s6_people_file",
    """SELECT c_name AS name, CAST(c_custkey % 90 AS INTEGER) AS age FROM customer
    WHERE c_custkey % 90 >= 20""",
)
def people_file(spark, folder):
    path = shared_dir(spark, "people")
    age = (F.col("c_custkey") % 90).cast("string")
    px.table(spark, folder, "customer").select(
        F.concat(F.col("c_name"), F.lit(", "), age).alias("value")
    ).write.text(path)
    return readers.read_people(spark, path).where(F.col("age") >= 20)


@query(
    "s7_ratings_file",
    f"""WITH {px.RATINGS}
    SELECT "user", item, rating FROM ratings""",
)
def ratings_file(spark, folder):
    path = shared_dir(spark, "ratings")
    rows = px.ratings(spark, folder).withColumn("ts", F.col("user").cast("long"))
    rows.write.csv(path, header=True)
    return readers.read_ratings(spark, path)


@query(
    "s8_movies_file",
    f"""WITH {px.MOVIES}
    SELECT item, title || ' The film 2,0' AS title, array_to_string(genres, '/') AS genres FROM movies""",
)
def movies_file(spark, folder):
    path = shared_dir(spark, "movies")
    px.movies(spark, folder).select(
        "item",
        F.concat("title", F.lit(', The "film" 2,0')).alias("title"),
        F.array_join("genres", "|").alias("genres"),
    ).write.csv(path, header=True, quote='"', escape='"')
    return readers.read_movies(spark, path).withColumn("genres", F.array_join("genres", "/"))


# The amount has cents, which are summed as whole numbers.
CREDIT_SUMS = ", ".join(
    'CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS amount'
    if c == "amount"
    else f'CAST(sum(CAST("{c}" AS BIGINT){"" if c in CREDIT_UNCHANGED else " - 1"}) AS BIGINT) AS "{c}"'
    for c in CREDIT_FEATURES
)


@query(
    "s9_credit_file",
    f"""WITH {px.CREDIT} SELECT "{CREDIT_LABEL}", count(*) AS n, {CREDIT_SUMS}
    FROM credit GROUP BY "{CREDIT_LABEL}" """,
)
def credit_file(spark, folder):
    path = shared_dir(spark, "credit")
    columns = [CREDIT_LABEL, *CREDIT_FEATURES]
    px.credit(spark, folder).select(*columns).write.csv(path)
    cents = {"amount": F.round(F.col("amount") * 100)}
    sums = [F.sum(cents.get(c, F.col(c)).cast("bigint")).alias(c) for c in CREDIT_FEATURES]
    records = readers.read_credit(spark, path)
    return records.groupBy(CREDIT_LABEL).agg(F.count(F.lit(1)).alias("n"), *sums)


@query(
    "k9_k10_views",
    """SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey
    WHERE c_acctbal > 100""",
)
def views(spark, folder):
    catalog.register(marlstone_customers=px.table(spark, folder, "customer"))
    catalog.register_global(marlstone_nations=px.table(spark, folder, "nation"))
    return catalog.run_sql(
        spark,
        """SELECT c_custkey, n_name FROM marlstone_customers
           JOIN global_temp.marlstone_nations ON n_nationkey = c_nationkey
           WHERE c_acctbal > :least""",
        args={"least": 100},
    )
