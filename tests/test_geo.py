import pytest
from pyspark.sql import functions as F

from marlstone.operators import geo
from marlstone.plans.geotags import located_pictures, tag_counts_by_country
from marlstone.sources.schemas import PHOTO_SCHEMA
from tests.conftest import rows

SCHEMA = (
    "code string, ordinal int, min_lon double, min_lat double, max_lon double, max_lat double, "
    "centre_lon double, centre_lat double"
)
# Boxes of the countries around the four cities below.
EUROPE = [
    ("BE", 19, 2.566667, 49.516667, 6.4, 51.683333, 4.4833335, 50.6),
    ("EI", 70, -10.680833, 51.425556, -6.0025, 55.433333, -8.3416665, 53.4294445),
    ("FR", 77, -5.133333, 41.333333, 9.533333, 51.083333, 2.2, 46.208333),
    ("GM", 90, 5.9, 47.266667, 15.033333, 55.05, 10.4666665, 51.1583335),
    ("LU", 141, 5.742778, 49.460833, 6.505833, 50.181667, 6.1243055, 49.82125),
    ("NL", 169, 3.133333, 50.75, 7.2, 53.583333, 5.1666665, 52.1666665),
    ("SZ", 212, 6.0, 45.366667, 10.5, 49.866667, 8.25, 47.616667),
    ("UK", 230, -13.65, 49.866667, 2.866667, 61.5, -5.3916665, 55.6833335),
]
CITIES = {
    "Paris": (2.351828, 48.856578, "FR", 77),
    "Brussels": (4.352425, 50.846686, "BE", 19),
    "Lille": (3.063333, 50.637222, "BE", 19),
    "Compiègne": (2.823056, 49.4149, "FR", 77),
}


def brute_force(points, boxes):
    found = {}
    for key, x, y in points:
        inside = [
            (((b[6] - x) ** 2 + (b[7] - y) ** 2) ** 0.5, b[1], b[0])
            for b in boxes
            if x is not None and y is not None and b[2] <= x <= b[4] and b[3] <= y <= b[5]
        ]
        found[key] = min(inside)[2] if inside else None
    return found


def both(spark, points, boxes):
    """Answers of the index and of the grid."""
    point_rows = spark.createDataFrame(points, "id int, lon double, lat double")
    box_rows = spark.createDataFrame(boxes, SCHEMA)
    for df in (
        geo.box_of_indexed(point_rows, box_rows),
        geo.box_of_grid(point_rows, box_rows),
    ):
        assert df.columns == ["id", "lon", "lat", "country"]
        answers = df.collect()
        assert len(answers) == len(points)
        yield {r.id: r.country for r in answers}


def test_four_cities(spark):
    points = spark.createDataFrame([(n, x, y) for n, (x, y, _, _) in CITIES.items()], "city string, lon double, lat double")
    boxes = spark.createDataFrame(EUROPE, SCHEMA)
    found = geo.ordinal_of(geo.box_of(points, boxes), boxes, "country")
    assert {r.city: (r.country, r.ordinal) for r in found.collect()} == {
        name: city[2:] for name, city in CITIES.items()
    }
    back = geo.code_of(spark.createDataFrame([(77,), (5,)], "n int"), boxes, "n")
    assert rows(back) == [(5, None), (77, "FR")]


def test_edges_ties_and_misses(spark):
    boxes = [
        ("T2", 2, 0.0, 0.0, 4.0, 4.0, 2.0, 2.0),
        ("T1", 1, 0.0, 0.0, 4.0, 4.0, 2.0, 2.0),
        ("PT", 3, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0),
        ("BACK", 4, 170.0, -5.0, -170.0, 5.0, 180.0, 0.0),
        ("BIG", 5, -100.0, -50.0, 100.0, 50.0, 0.0, 0.0),
    ]
    points = [
        (1, 4.0, 4.0), (2, 0.0, 0.0), (3, 9.0, 9.0), (4, 175.0, 0.0), (5, -100.0, 50.0),
        (6, 101.0, 0.0), (7, None, 0.0), (8, 2.0, 2.0), (9, float("nan"), 1.0), (10, 1e300, 1.0),
    ]
    wanted = {1: "T1", 2: "BIG", 3: "PT", 4: None, 5: "BIG", 6: None, 7: None, 8: "T1", 9: None, 10: None}
    for found in both(spark, points, boxes):
        assert found == wanted


def test_methods_agree_with_brute_force(spark):
    boxes = []
    for i in range(300):
        x, y = (i * 37 % 360) - 180.0, (i * 53 % 180) - 90.0
        w, h = (i % 17) ** 2 / 3.0, (i % 11) ** 2 / 7.0
        boxes.append((f"B{i}", i, x, y, x + w, y + h, x + w / 2, y + h / 3))
    points = [(i, (i * 7919 % 3600) / 10 - 180, (i * 104729 % 1800) / 10 - 90) for i in range(2000)]
    wanted = brute_force(points, boxes)
    assert len(set(wanted.values())) > 100
    for found in both(spark, points, boxes):
        assert found == wanted


def test_grid_without_broadcast(spark, without_broadcast):
    points = [(i, i % 30 - 10.0, i % 20 + 40.0) for i in range(200)]
    wanted = brute_force(points, EUROPE)
    for found in both(spark, points, EUROPE):
        assert found == wanted


def test_either_way_gives_the_same_for_shared_ids_and_places(spark, monkeypatch):
    points = [(1, 0.5, 0.5), (1, 5.5, 5.5), (None, 0.5, 0.5), (None, None, 0.5), (2, 0.5, None)]
    frame = spark.createDataFrame(points, "id int, lon double, lat double")
    boxes = [("A", 1, 0.0, 0.0, 1.0, 1.0, 0.5, 0.5), ("B", 2, 5.0, 5.0, 6.0, 6.0, 5.5, 5.5)]
    wanted = sorted(((*p, c) for p, c in zip(points, ["A", "B", "A", None, None])), key=repr)
    for limit in (100, 1):
        monkeypatch.setattr(geo, "BROADCAST_BOXES", limit)
        assert rows(geo.box_of(frame, spark.createDataFrame(boxes, SCHEMA))) == wanted


def test_cells_of_a_dense_cluster_list_few_boxes(spark):
    boxes = [(f"B{i}", i, i % 50 / 1e4, i // 50 / 1e4, (i % 50 + 1) / 1e4, (i // 50 + 1) / 1e4, 0.0, 0.0) for i in range(2500)]
    boxes += [("F1", 9001, -180.0, -90.0, -179.0, -89.0, 0.0, 0.0), ("F2", 9002, 179.0, 89.0, 180.0, 90.0, 0.0, 0.0)]
    frame = spark.createDataFrame(boxes, SCHEMA)
    cells = geo._grid(frame, geo._extent(frame)).cells(frame).groupBy("__level", "__cx", "__cy").count()
    assert max(r["count"] for r in cells.collect()) <= 36


def test_no_boxes(spark):
    for found in both(spark, [(1, 0.0, 0.0)], [("BACK", 1, 5.0, 0.0, -5.0, 1.0, 0.0, 0.0)]):
        assert found == {1: None}


def test_points_are_not_shuffled_by_the_index(spark):
    from marlstone.catalog import plan_text

    points = spark.range(10).select("id", F.rand(1).alias("lon"), F.rand(2).alias("lat"))
    plan = plan_text(geo.box_of(points, spark.createDataFrame(EUROPE, SCHEMA)), "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    above, below = plan.split("BroadcastHashJoin", 1)
    left, right = below.split("BroadcastExchange", 1)
    assert "Exchange" not in above and "Exchange" not in left


def test_tags_per_country(spark):
    def photo(key, x, y, tags):
        values = dict.fromkeys(PHOTO_SCHEMA.names) | {
            "photo_id": key, "longitude": x, "latitude": y, "user_tags": tags
        }
        return tuple(values[c] for c in PHOTO_SCHEMA.names)

    photos = spark.createDataFrame(
        [
            photo(1, 2.35, 48.85, "tower,night"),
            photo(2, 2.36, 48.86, "tower%2Criver"),
            photo(3, 4.35, 50.85, "beer"),
            photo(4, 2.35, 48.85, ""),
            photo(5, -100.0, 0.0, "sea"),
            photo(6, -1.0, -1.0, "nowhere"),
        ],
        PHOTO_SCHEMA,
    )
    boxes = spark.createDataFrame(EUROPE, SCHEMA)
    located = located_pictures(photos, boxes)
    assert rows(located.select("photo_id", "country")) == [(1, "FR"), (2, "FR"), (3, "BE")]
    assert rows(tag_counts_by_country(located)) == [
        ("BE", "beer", 1), ("FR", "night", 1), ("FR", "river", 1), ("FR", "tower", 2)
    ]
