import pytest
from pyspark.errors import StreamingQueryException

from marlstone.streaming import words as ws
from tests.conftest import rows


@pytest.fixture
def arrivals(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.txt").write_text("a b  a\n\n")
    (folder / "2.txt").write_text("a c\n")
    return folder


def run(spark, arrivals, tmp_path, limit=None):
    stream = ws.split_words(ws.line_stream(spark, str(arrivals), files_per_batch=1))
    query = ws.start_word_count(
        stream, ws.to_parquet(str(tmp_path / "out"), limit), str(tmp_path / "offsets"), available_now=True
    )
    assert query.awaitTermination(120)
    return spark.read.parquet(str(tmp_path / "out"))


def test_each_batch_counts_alone(spark, arrivals, tmp_path):
    found = run(spark, arrivals, tmp_path)
    by_batch = [rows(found.where(found.batch_id == i).select("word", "n")) for i in (0, 1)]
    assert sorted(by_batch) == [[("", 2), ("a", 2), ("b", 1)], [("a", 1), ("c", 1)]]


def test_restart_counts_only_new_files(spark, arrivals, tmp_path):
    run(spark, arrivals, tmp_path)
    (arrivals / "3.txt").write_text("a a a\n")
    found = run(spark, arrivals, tmp_path)
    assert rows(found.where("batch_id = 2").select("word", "n")) == [("a", 3)]
    assert found.count() == 6


def test_first_rows_of_a_batch(spark, arrivals, tmp_path):
    (arrivals / "2.txt").write_text(" ".join(f"w{i:02d}" for i in range(30)))
    found = run(spark, arrivals, tmp_path, limit=10)
    words = [r.word for r in found.where("word like 'w%'").orderBy("word").collect()]
    assert words == [f"w{i:02d}" for i in range(10)]


def test_stream_equals_batch(spark, arrivals, tmp_path):
    stream = ws.split_words(ws.line_stream(spark, str(arrivals)))
    assert stream.isStreaming
    query = ws.start_word_count(
        stream, ws.to_parquet(str(tmp_path / "out")), str(tmp_path / "offsets"), available_now=True
    )
    assert query.awaitTermination(120)
    batch = ws.count_words(ws.split_words(spark.read.text(str(arrivals))))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.select("batch_id").distinct().count() == 1
    assert rows(found.select("word", "n")) == rows(batch)


def test_interval_trigger_and_show(spark, arrivals, tmp_path, capsys):
    stream = ws.split_words(ws.line_stream(spark, str(arrivals)))
    query = ws.start_word_count(stream, ws.show_batch, str(tmp_path / "offsets"))
    query.processAllAvailable()
    query.stop()
    assert "batch 0" in capsys.readouterr().out


def test_a_batch_that_is_run_twice_leaves_the_same_rows(spark, arrivals, tmp_path):
    write, runs = ws.to_parquet(str(tmp_path / "out")), []

    def sink(counts, batch_id):
        write(counts, batch_id)
        runs.append(batch_id)
        if len(runs) == 1:
            raise RuntimeError("lost before the commit")

    def start():
        stream = ws.split_words(ws.line_stream(spark, str(arrivals)))
        return ws.start_word_count(stream, sink, str(tmp_path / "offsets"), available_now=True)

    assert ws.run_to_end(start) == 2 and runs == [0, 0]
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found.select("batch_id", "word", "n")) == [(0, "", 2), (0, "a", 3), (0, "b", 1), (0, "c", 1)]

    def failing():
        stream = ws.split_words(ws.line_stream(spark, str(arrivals)))
        return ws.start_word_count(stream, lambda *_: 1 / 0, str(tmp_path / "other"), available_now=True)

    with pytest.raises(StreamingQueryException):
        ws.run_to_end(failing, attempts=2)
