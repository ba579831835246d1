import pytest
from pyspark.sql import functions as F

from marlstone.plans.licensing import located_and_licensed, with_license_flag
from marlstone.sources import readers
from marlstone.sources.schemas import CREDIT_FEATURES, CREDIT_LABEL, PHOTO_SCHEMA
from marlstone.sources.sinks import write_tsv
from tests.conftest import rows


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def photo_line(key, lon="1.5", lat="2.5", license="Attribution License", tags="a,b", marker="0"):
    values = dict.fromkeys(PHOTO_SCHEMA.names, "x") | {
        "photo_id": str(key), "longitude": lon, "latitude": lat, "license": license,
        "user_tags": tags, "marker": marker,
    }
    return "\t".join(values[c] for c in PHOTO_SCHEMA.names)


# Names and flags of real licenses, one of them with a value too many, one with an empty flag.
LICENCES = (
    "Name\tAttribution\tNoncommercial\tNonDerivative\tShareAlike\tPublicDomainDedication\tPublicDomainWork\n"
    "Attribution License\t1\t0\t0\t0\t0\t0\n"
    "Attribution-NoDerivs License\t1\t0\t1\t0\t0\t0\n"
    "Attribution-NonCommercial-NoDerivs License\t1\t1\t1\t0\t0\t0\n"
    "Attribution-NonCommercial License\t1\t1\t0\t0\t0\t0\t0\n"
    "Attribution-NonCommercial-ShareAlike License\t1\t1\t\t1\t0\t0\n"
)


def test_photos_and_licences(spark, tmp_path):
    lines = [
        photo_line(1, license="Attribution-NoDerivs License"),
        photo_line(2, lon="-1.0"),
        photo_line(3, lat="-1.0"),
        photo_line(4, license=""),
        photo_line(5, lon="", lat=""),
        photo_line(6),
        photo_line(7, license="Unknown License"),
        photo_line(8, license="Attribution-NonCommercial License", marker="1"),
        photo_line(9, license="Attribution-NonCommercial-ShareAlike License"),
        photo_line(10, lon="east"),
    ]
    photos = readers.read_photos(spark, write(tmp_path / "photos.tsv", "\n".join(lines)))
    assert photos.schema == PHOTO_SCHEMA
    assert photos.where("photo_id = 8").first().marker == 1
    assert photos.where("photo_id = 10").first().longitude is None
    licences = readers.read_licences(spark, write(tmp_path / "licences.tsv", LICENCES))
    assert licences.count() == 5 and set(dict(licences.dtypes).values()) == {"string"}
    interesting = located_and_licensed(photos)
    assert [r.photo_id for r in interesting.orderBy("photo_id").collect()] == [1, 6, 7, 8, 9]
    flagged = with_license_flag(interesting, licences, "NonDerivative")
    assert [r.photo_id for r in flagged.collect()] == [1]
    assert flagged.columns == ["photo_id", "longitude", "latitude", "license"]
    assert licences.where("try_cast(NonDerivative as boolean)").count() == 2

    target = str(tmp_path / "result")
    write_tsv(flagged, target)
    assert rows(spark.read.csv(target, sep="\t", header=True)) == [
        ("1", "1.5", "2.5", "Attribution-NoDerivs License")
    ]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_tsv(flagged, target)
    write_tsv(flagged, target, mode="overwrite")


def test_quarantine(spark, tmp_path):
    path = write(tmp_path / "photos.tsv", photo_line(1) + "\n" + photo_line("one"))
    photos = readers.read_photos(spark, path, quarantine="bad_line").cache()
    assert [r.photo_id for r in photos.where("bad_line is null").collect()] == [1]
    assert photos.where("bad_line is not null").count() == 1
    photos.unpersist()


def test_lines_and_header(spark, tmp_path):
    path = write(tmp_path / "a.txt", "h\n1\nh\n2\n")
    assert [r.value for r in readers.read_lines(spark, path).collect()] == ["h", "1", "h", "2"]
    assert [r.value for r in readers.read_lines(spark, path, header=True).collect()] == ["1", "2"]
    empty = write(tmp_path / "b.txt", "")
    assert readers.read_lines(spark, empty, header=True).count() == 0


def test_people(spark, tmp_path):
    text = readers.read_people(spark, write(tmp_path / "p.txt", "Ines, 41\nOlu,7\nPiet,  15"))
    assert rows(text) == [("Ines", 41), ("Olu", 7), ("Piet", 15)]
    assert rows(text.where("age >= 15").select("name")) == [("Ines",), ("Piet",)]
    by_sql = spark.sql("SELECT name FROM {p} WHERE age >= 10 AND age <= 40", p=text)
    by_frame = text.where(F.col("age") >= 10).where(F.col("age") <= 40).select("name")
    assert rows(by_sql) == rows(by_frame) == [("Piet",)]
    labels = by_frame.select(F.concat(F.lit("Guest "), F.col("name")))
    assert rows(labels) == [("Guest Piet",)]


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "p.json", '{"town":"Lund","km":12}\n{"town":"Graz"}\n{"km":3, "town":"Faro"}')
    towns = readers.read_json_lines(spark, path)
    assert towns.dtypes == [("km", "bigint"), ("town", "string")]
    assert all(f.nullable for f in towns.schema)
    assert rows(towns.where("km between 1 and 9").select("town")) == [("Faro",)]
    typed = readers.read_json_lines(spark, path, "town string, km int")
    assert typed.where("km is null").first().town == "Graz"


def test_json_fields_beyond_the_sample(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "SAMPLE_LINES", 20)
    lines = [f'{{"id":{i},"at":{{"x":{i}}}}}' for i in range(500)]
    odd = [
        '{"id":900,"rare":[1,2]}', '{"id":901,"at":{"x":1,"deep":"d"}}', '{"id":902.5}', '{"id":903', "", '[1]',
    ]
    path = write(tmp_path / "l.json", "\n".join(lines + odd))
    whole = readers.read_json_lines(spark, path)
    assert whole.schema["rare"].dataType.simpleString() == "array<bigint>"
    assert whole.schema["at"].dataType.simpleString() == "struct<deep:string,x:bigint>"
    assert whole.schema["id"].dataType.simpleString() == "double"
    assert whole.where("rare[1] = 2 or at.deep = 'd' or id = 902.5").count() == 3
    aside = readers.read_json_lines(spark, path, quarantine="line")
    kept = {r["line"] for r in aside.where("line is not null").collect()}
    assert kept == {line for line in odd if line}
    assert aside.where("line is null").count() == 500
    assert aside.where("line is null").agg(F.sum("at.x")).first()[0] == sum(range(500))
    empty = readers.read_json_lines(spark, write(tmp_path / "e.json", ""), quarantine="line")
    assert empty.count() == 0


def test_ratings(spark, tmp_path):
    path = write(tmp_path / "r.csv", "userId,movieId,rating,timestamp\n1,10,3.5,99\n1,11,5,98\n")
    ratings = readers.read_ratings(spark, path)
    assert ratings.dtypes == [("user", "int"), ("item", "int"), ("rating", "double")]
    assert rows(ratings) == [(1, 10, 3.5), (1, 11, 5.0)]
    bad = write(tmp_path / "bad.csv", "userId,movieId,rating,timestamp\n1,10,3.5\n")
    with pytest.raises(Exception):
        readers.read_ratings(spark, bad).collect()
    kept = readers.read_ratings(spark, bad, quarantine="bad_line").cache()
    assert kept.select("bad_line").first().bad_line == "1,10,3.5"


def test_movies(spark, tmp_path):
    path = write(
        tmp_path / "m.csv",
        "movieId,title,genres\n"
        '1,"American President, The (1995)",Comedy|Drama\n'
        '2,"20,000 Leagues (1954)",Adventure|Sci-Fi\n'
        "3,Heat (1995),Action\n"
        '4,"A ""Q"" film",(no genres listed)\n',
    )
    assert rows(readers.read_movies(spark, path)) == [
        (1, "American President The (1995)", ["Comedy", "Drama"]),
        (2, "20,000 Leagues (1954)", ["Adventure", "Sci-Fi"]),
        (3, "Heat (1995)", ["Action"]),
        (4, "A Q film", ["(no genres listed)"]),
    ]


def test_credit(spark, tmp_path):
    path = write(tmp_path / "c.csv", ",".join(str(v) for v in range(1, 22)) + "\n")
    record = readers.read_credit(spark, path).first().asDict()
    values = dict(zip([CREDIT_LABEL, *CREDIT_FEATURES], range(1, 22)))
    unchanged = {"creditability", "duration", "history", "purpose", "amount", "instPercent", "age"}
    assert record == {c: float(v if c in unchanged else v - 1) for c, v in values.items()}
    with pytest.raises(Exception):
        readers.read_credit(spark, write(tmp_path / "bad.csv", "1,2,x\n")).collect()
