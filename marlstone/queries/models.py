"""Normalisation, recommendation and classification.

What a fit gives is not known to SQL. Queries around a fitted model therefore hold it against what it must
satisfy (its own equations, labels and ratings that can be learned, the same predictions on another way)
and return counts and facts that SQL gives too; they differ as soon as ratings or labels are mixed up.
"""

from __future__ import annotations

from itertools import product

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators.ranking import area_under_roc
from marlstone.operators.sampling import exact_split
from marlstone.plans import credit as cr
from marlstone.plans import factorization as fz
from marlstone.plans.neighbours import liked, recommend
from marlstone.plans.ratings import normalise
from marlstone.plans.trees import node_table, scored
from marlstone.queries import proxies as px
from marlstone.queries.joins import LIKED
from marlstone.queries.ordering import MERGED
from marlstone.queries.registry import query
from marlstone.sources.readers import rebase_credit
from marlstone.sources.schemas import CREDIT_FEATURES, CREDIT_LABEL, CREDIT_UNCHANGED

SEED = 12345
NEW_USER = -1

STATS = f"""{px.RATINGS}, stats AS (
  SELECT "user", sum(rating) / count(*) AS mean,
         sqrt(greatest(count(*) * sum(rating * rating) - sum(rating) * sum(rating), 0)) / count(*) AS sd
  FROM ratings GROUP BY "user")"""


def _normalised_sql(centre: str, scale: str) -> str:
    return f"""WITH {STATS}
    SELECT r."user", r.item, round((r.rating - s.{centre}) / nullif(s.{scale}, 0), 6) AS rating
    FROM ratings r JOIN stats s ON s."user" = r."user" """


def _normalised(spark, folder, method):
    rows = normalise(px.ratings(spark, folder), method, on_grid=True)
    return rows.withColumn("rating", F.round("rating", 6))


@query("m1_zscore", _normalised_sql("mean", "sd"))
def zscores(spark, folder):
    return _normalised(spark, folder, "zscore")


@query("m1_swapped", _normalised_sql("sd", "mean"))
def swapped_scores(spark, folder):
    return _normalised(spark, folder, "swapped")


@query("m7_liked", f"""WITH {px.RATINGS}, {LIKED} SELECT "user", item, rating FROM liked""")
def liked_ratings(spark, folder):
    return liked(px.ratings(spark, folder)).orderBy(F.desc("rating"), "user", "item")


@query("m9_knn_recommend", f"WITH {MERGED}")
def neighbour_titles(spark, folder):
    return recommend(px.ratings(spark, folder), px.movies(spark, folder), px.PROXY_PROFILE)


PAIR = """md5('{seed}:' || "user" || ':' || item)""".format(seed=SEED)
SPLIT = f"""{px.RATINGS}, drawn AS (SELECT *, {PAIR} AS draw FROM ratings),
cut AS (SELECT draw AS first FROM drawn
  ORDER BY draw LIMIT 1 OFFSET (SELECT CAST(floor(0.9 * count(*) + 1e-9) AS BIGINT) FROM drawn)),
train AS (SELECT * FROM drawn WHERE draw < (SELECT first FROM cut)),
test AS (SELECT * FROM drawn WHERE draw >= (SELECT first FROM cut)),
scored AS (
  SELECT count(*) AS n_pairs FROM test
  WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train))"""


def split_ratings(ratings: DataFrame) -> list[DataFrame]:
    return exact_split(ratings, [0.9, 0.1], F.concat_ws(":", "user", "item"), SEED)


@query(
    "m5_split",
    f"""WITH {SPLIT}
    SELECT 'train' AS part, count(*) AS n, sum(rating) AS total FROM train
    UNION ALL SELECT 'test', count(*), sum(rating) FROM test""",
)
def split_sizes(spark, folder):
    train, test = split_ratings(px.ratings(spark, folder))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"))


#: How far a user's factors may be from solving their equations (they are single floats), how far items'
#: may be on average after all rounds, and how far a prediction may be from the model's own.
SOLVED, SETTLED, EQUAL = 1e-3, 0.05, 1e-4


def stored_ratings(
    ratings: DataFrame, level: StorageLevel = StorageLevel.DISK_ONLY
) -> tuple[DataFrame, int]:
    """The ratings, joined and aggregated once for all that reads them, and the blocks that they take.

    They are read a few times only, and a fit needs the executors' memory for its blocks.
    """
    ratings = ratings.persist(level)
    return ratings, fz.blocks_for(ratings)


@query("m2_m3_als_predict", f"WITH {SPLIT} SELECT n_pairs, n_pairs AS n_equal FROM scored")
def factor_scores(spark, folder):
    """Held-out pairs that the model predicts, and those where joined factors predict the same."""
    ratings, blocks = stored_ratings(px.ratings(spark, folder), StorageLevel.MEMORY_AND_DISK)
    train, test = split_ratings(ratings)
    model = fz.factorizer(blocks=blocks).fit(train)
    own = fz.predict_by_join(model, test.select("user", "item")).withColumnRenamed("prediction", "joined")
    both = model.transform(own)
    return both.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.abs(F.col("prediction") - F.col("joined")) <= EQUAL).alias("n_equal"),
    )


@query(
    "m2_als_equations",
    f"""WITH {SPLIT}
    SELECT count(DISTINCT "user") AS n_users, count(DISTINCT "user") AS n_solved, true AS items_settled FROM train""",
)
def factor_equations(spark, folder):
    """How many users' factors solve their equations, and whether those of the items have settled."""
    ratings, blocks = stored_ratings(px.ratings(spark, folder))
    train, _ = split_ratings(ratings)
    model = fz.factorizer(blocks=blocks).fit(train)
    users = fz.residuals(model, train, "user").agg(
        F.count(F.lit(1)).alias("n_users"), F.count_if(F.col("residual") <= SOLVED).alias("n_solved")
    )
    items = fz.residuals(model, train, "item").agg((F.avg("residual") <= SETTLED).alias("items_settled"))
    return users.join(items)


def low_rank_ratings(spark, folder) -> DataFrame:
    """The given pairs of user and item, rated by one taste: a user's factor times an item's."""
    rating = (F.col("user") % 4 + 1) * (F.col("item") % 3 + 1) / 2.0
    return px.ratings(spark, folder).select("user", "item", rating.alias("rating"))


@query(
    "j7_scoring_join",
    f"""WITH {SPLIT},
    known AS (SELECT t."user", t.item, (t."user" % 4 + 1) * (t.item % 3 + 1) / 2.0 AS rating FROM test t
      WHERE t."user" IN (SELECT "user" FROM train) AND t.item IN (SELECT item FROM train))
    SELECT count(*) AS n_pairs, round(avg(rating), 9) AS mean_rating, true AS learned FROM known""",
)
def low_rank_error(spark, folder):
    """The error of predictions on held-out ratings of low rank, far below their variance."""
    ratings, blocks = stored_ratings(low_rank_ratings(spark, folder))
    train, test = split_ratings(ratings)
    model = fz.factorizer(rank=4, iterations=10, blocks=blocks).fit(train)
    error = F.col("rating") - F.col("prediction")
    found = fz.predict_by_join(model, test).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.round(F.avg("rating"), 9).alias("mean_rating"),
        (F.avg(error * error) < F.var_pop("rating") / 20).alias("learned"),
    )
    return found


GRID = ", ".join(
    f"({i}, {rank}, {reg}, {rounds})"
    for i, (rank, reg, rounds) in enumerate(product(fz.GRID_RANKS, fz.GRID_REGS, fz.GRID_ITERATIONS))
)


@query(
    "m4_als_grid",
    f"""WITH {SPLIT}
    SELECT step, rank, CAST(reg AS DOUBLE) AS reg, iterations, n_pairs, true AS learned,
           true AS best_is_least, 1 AS n_best
    FROM (VALUES {GRID}) AS grid(step, rank, reg, iterations), scored""",
)
def factor_grid(spark, folder):
    """All parameter sets on ratings of low rank; strong regularisation does worse, so `learned` is what
    each should do: far below the variance for the least, above it for the others."""
    ratings, _ = stored_ratings(low_rank_ratings(spark, folder))
    train, test = split_ratings(ratings)
    trials = fz.tune(train, test)
    checked = trials.agg(
        F.min_by("step", F.struct("mse", "step")).alias("least"),
        F.max(F.when(F.col("best"), F.col("step"))).alias("chosen"),
        F.count_if("best").cast("int").alias("n_best"),
    )
    spread = test.agg(F.var_pop("rating").alias("spread"))
    learned = (F.col("mse") < F.col("spread") / 20) == (F.col("reg") < 0.1)
    rows = trials.join(F.broadcast(checked)).join(F.broadcast(spread))
    return rows.select(
        "step", "rank", "reg", "iterations", "n_pairs", learned.alias("learned"),
        (F.col("least") == F.col("chosen")).alias("best_is_least"), "n_best",
    )


def new_user_ratings(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """The new user rates the sampled popular items from one to five."""
    shown = fz.items_to_rate(ratings, movies)
    return shown.select("item", (1 + F.col("item") % 5).cast("double").alias("rating"))


SHOWN = f"""{px.RATINGS}, {px.MOVIES},
popular AS (SELECT item, count(*) AS n FROM ratings GROUP BY item ORDER BY n DESC, item LIMIT 200),
shown AS (SELECT item FROM popular ORDER BY md5('{SEED}:' || item), item LIMIT 40)"""


@query(
    "m6_candidates",
    f"""WITH {SHOWN}
    SELECT {NEW_USER} AS "user", item FROM movies WHERE item NOT IN (SELECT item FROM shown)""",
)
def unseen_items(spark, folder):
    ratings, movies = px.ratings(spark, folder), px.movies(spark, folder)
    return fz.candidates(movies, new_user_ratings(ratings, movies), NEW_USER)


def _checked(best: DataFrame, model_predictions: DataFrame, rated: DataFrame) -> DataFrame:
    """How many titles were given, are new to the user, and carry the model's own prediction; whether they
    are the greatest and come in falling order."""
    placed = best.select("item", "prediction").withColumn("place", F.monotonically_increasing_id())
    whole = placed.join(model_predictions.withColumnRenamed("prediction", "own"), "item", "right")
    new = placed.join(rated.select("item"), "item", "left_anti").agg(F.count(F.lit(1)).alias("n_unseen"))
    falling = F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "prediction"))))
    facts = whole.agg(
        F.count("place").alias("n_items"),
        F.count_if(F.abs(F.col("prediction") - F.col("own")) <= EQUAL).alias("n_equal"),
        falling["prediction"].alias("order"),
        F.max(F.when(F.col("place").isNull(), F.col("own"))).alias("next"),
        F.min("prediction").alias("last"),
    )
    in_order = F.reverse(F.array_sort("order")) == F.col("order")
    greatest = F.coalesce(F.col("next") <= F.col("last") + EQUAL, F.lit(True))
    return facts.join(new).select(
        "n_items", "n_unseen", "n_equal", in_order.alias("falling"), greatest.alias("greatest")
    )


LISTED = f"""SELECT least(count(*), {fz.RECOMMENDED}) AS n_items, least(count(*), {fz.RECOMMENDED}) AS n_unseen,
           least(count(*), {fz.RECOMMENDED}) AS n_equal, true AS falling, true AS greatest FROM unseen"""


@query(
    "m6_new_user",
    f"""WITH {SHOWN},
    unseen AS (SELECT item FROM movies WHERE item IN (SELECT item FROM ratings)
               AND item NOT IN (SELECT item FROM shown))
    {LISTED}""",
)
def new_user_titles(spark, folder):
    """A new user's titles against the model's own predictions for all that they have not rated."""
    ratings, movies = stored_ratings(px.ratings(spark, folder))[0], px.movies(spark, folder)
    own = new_user_ratings(ratings, movies).persist()
    model = fz.new_user_model(ratings, own, NEW_USER)
    best = fz.recommend_for_new_user(ratings, movies, own, NEW_USER, model=model)
    every = fz.predict(model, fz.candidates(movies, own, NEW_USER)).select("item", "prediction")
    return _checked(best, every, own)


@query(
    "t9_top_predictions",
    f"""WITH {px.RATINGS}, {px.MOVIES},
    unseen AS (SELECT item FROM movies WHERE item IN (SELECT item FROM ratings)
               AND item NOT IN (SELECT item FROM ratings WHERE "user" = 7))
    {LISTED}""",
)
def top_of_user(spark, folder):
    ratings, blocks = stored_ratings(px.ratings(spark, folder))
    movies = px.movies(spark, folder)
    model = fz.factorizer(blocks=blocks).fit(ratings)
    own = ratings.where(F.col("user") == 7)
    pairs = fz.candidates(movies, own, 7)
    every = fz.predict(model, pairs).select("item", "prediction")
    return _checked(fz.top_predictions(model, pairs, 7), every, own)


REBASED = ", ".join(
    f'"{c}"' if c in (CREDIT_LABEL, *CREDIT_UNCHANGED) else f'"{c}" - 1 AS "{c}"'
    for c in [CREDIT_LABEL, *CREDIT_FEATURES]
)


@query("s10_rebase", f"WITH {px.CREDIT} SELECT l_orderkey, l_linenumber, {REBASED} FROM credit")
def rebased_records(spark, folder):
    return rebase_credit(px.credit(spark, folder))


@query(
    "m11_label_index",
    """SELECT l_returnflag, CAST(row_number() OVER (ORDER BY n DESC, l_returnflag) - 1 AS DOUBLE)
           AS label_index, n
    FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag)""",
)
def label_order(spark, folder):
    lines = px.table(spark, folder, "lineitem").select("l_returnflag")
    indexed = cr.label_indexer("l_returnflag").fit(lines).transform(lines)
    return indexed.groupBy("l_returnflag", cr.LABEL_COLUMN).agg(F.count(F.lit(1)).alias("n"))


RECORD = "concat_ws(':', l_orderkey, l_linenumber, CAST(history AS BIGINT), CAST(purpose AS BIGINT))"


def cut_sql(rows: str, share: float, seed: int, low: str, high: str) -> str:
    """CTEs for ``exact_split``: the rows of ``rows`` in two parts, ordered by the digest of their key."""
    return f"""{low}_drawn AS (SELECT *, md5('{seed}:' || {RECORD}) AS draw FROM {rows}),
    {low}_cut AS (SELECT draw AS first FROM {low}_drawn ORDER BY draw LIMIT 1
      OFFSET (SELECT CAST(floor({share} * count(*) + 1e-9) AS BIGINT) FROM {low}_drawn)),
    {low} AS (SELECT * EXCLUDE (draw) FROM {low}_drawn WHERE draw < (SELECT first FROM {low}_cut)),
    {high} AS (SELECT * EXCLUDE (draw) FROM {low}_drawn WHERE draw >= (SELECT first FROM {low}_cut))"""


PARTS = f"{px.CREDIT}, {cut_sql('credit', cr.TRAIN_SHARE, cr.SPLIT_SEED, 'train', 'test')}"
HELD_OUT = cut_sql("train", cr.TRAIN_RATIO, cr.SPLIT_SEED + 1, "fitted", "held_out")


def record_key():
    history, purpose = (F.col(c).cast("bigint") for c in ("history", "purpose"))
    return F.concat_ws(":", "l_orderkey", "l_linenumber", history, purpose)


def learnable_credit(spark, folder) -> DataFrame:
    """The credit records with a label that two features tell, but for one record in a hundred."""
    records = rebase_credit(px.credit(spark, folder))
    told = F.col("duration") + 10 * F.col("balance") > 40
    noise = (F.col("l_orderkey") + F.col("l_linenumber")) % 100 == 0
    return records.withColumn(CREDIT_LABEL, (told != noise).cast("double"))


@query(
    "m5_credit_split",
    f"""WITH {PARTS}
    SELECT 'train' AS part, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM train
    UNION ALL SELECT 'test', count(*), CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) FROM test""",
)
def credit_split_sizes(spark, folder):
    train, test = cr.split(px.credit(spark, folder), key=record_key())
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    total = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), total.alias("total"))


@query(
    "a18_area_under_roc",
    f"""WITH {px.CREDIT},
    scores AS (SELECT balance AS "group", creditability AS label, duration + amount % 100 AS score FROM credit),
    ranked AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY "group", score) - 1) / 2.0 AS place
      FROM scores WINDOW w AS (PARTITION BY "group" ORDER BY score)),
    sums AS (SELECT "group", count(*) FILTER (label = 1) AS n_positive,
        count(*) FILTER (label = 0) AS n_negative, sum(place) FILTER (label = 1) AS places
      FROM ranked GROUP BY "group")
    SELECT "group", n_positive, n_negative,
        round((places - n_positive * (n_positive + 1) / 2.0) / (n_positive * n_negative), 9) AS auc
    FROM sums""",
)
def ranked_scores(spark, folder):
    records = px.credit(spark, folder)
    score = F.col("duration") + F.col("amount") % 100
    areas = area_under_roc(
        records.withColumn("group", F.col("balance")), F.col(CREDIT_LABEL) == 1, score, ["group"], per_range=500
    )
    return areas.withColumn("auc", F.round("auc", 9))


@query(
    "m10_m16_forest",
    f"""WITH {PARTS}
    SELECT (SELECT count(*) FROM train) AS n_train, count(*) AS n_test, count(*) AS n_equal, true AS learned
    FROM test""",
)
def fitted_forest(spark, folder):
    """Predictions of the fitted trees as expressions against the model's, and whether it has learned."""
    train, test = cr.split(learnable_credit(spark, folder), key=record_key())
    with cr.kept(train) as fitted_on:
        model = cr.stages(cr.forest()).fit(fitted_on)
        n_train = fitted_on.count()
    nodes = node_table(model.stages[-1])
    both = model.transform(scored(test, nodes, CREDIT_FEATURES))
    equal = F.abs(F.col("score") - cr.positive()) <= 1e-9
    # The area reads the scores several times; both ways of predicting are gone once.
    with cr.persisted(both.select((F.col(cr.LABEL_COLUMN) == 1).alias("label"), "score", equal.alias("equal"))) as known:
        auc = area_under_roc(known, F.col("label"), F.col("score")).select((F.col("auc") > 0.9).alias("learned"))
        facts = known.agg(F.count(F.lit(1)).alias("n_test"), F.count_if("equal").alias("n_equal")).join(auc).first()
    return spark.range(1).select(
        F.lit(n_train).cast("bigint").alias("n_train"),
        F.lit(facts["n_test"]).cast("bigint").alias("n_test"),
        F.lit(facts["n_equal"]).cast("bigint").alias("n_equal"),
        F.lit(facts["learned"]).cast("boolean").alias("learned"),
    )


SETS = ", ".join(
    f"({i}, {bins}, {depth}, '{impurity}')"
    for i, (bins, depth, impurity) in enumerate(product(cr.MAX_BINS, cr.MAX_DEPTH, cr.IMPURITY))
)


@query(
    "m15_forest_grid",
    f"""WITH {PARTS}, {HELD_OUT}
    SELECT step, max_bins, max_depth, impurity, (SELECT count(*) FROM held_out) AS n_pairs,
        true AS learned, true AS best_is_greatest, 1 AS n_best
    FROM (VALUES {SETS}) AS grid(step, max_bins, max_depth, impurity)""",
)
def forest_grid(spark, folder):
    """All parameter sets on records that can be learned: each does, and the best has the greatest area."""
    tuned = cr.classify(learnable_credit(spark, folder), key=record_key())
    checked = tuned.trials.agg(
        F.min_by("step", F.struct(-F.col("auc"), "step")).alias("greatest"),
        F.max(F.when(F.col("best"), F.col("step"))).alias("chosen"),
        F.count_if("best").cast("int").alias("n_best"),
    )
    return tuned.trials.join(F.broadcast(checked)).select(
        "step", "max_bins", "max_depth", "impurity", "n_pairs", (F.col("auc") > 0.9).alias("learned"),
        (F.col("greatest") == F.col("chosen")).alias("best_is_greatest"), "n_best",
    )
