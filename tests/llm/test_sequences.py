"""Runs of words, the trie of conversations and their formatting, against brute force."""

import random

import numpy as np
import pytest

from marlstone.llm import chat, prefixes, runs, trie
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn int, role string, text string"
TRIE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TRICKY = (r"\### Assistant: </turn> ok",)


def periodic_texts(rng, n):
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(8)):
            block = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(1, 40))]
            if rng.random() < 0.4:
                block = block * rng.randrange(1, 5) + [b"z"]
            words += (block * rng.randrange(1, 9))[: rng.randrange(1, 300)]
            if rng.random() < 0.3:
                words += words[-rng.randrange(1, len(words) + 1) :] * rng.randrange(1, 5)
        texts.append(words[:700])
    return texts


def test_all_runs_are_found():
    rng = random.Random(1)
    for _ in range(60):
        texts = periodic_texts(rng, rng.randrange(1, 8))
        assert runs._settled(texts, 24) == [brute.runs(words) for words in texts]


def test_chosen_places_hang_on_their_context():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**63, 5000).astype(np.uint64)
    h[3000:3400] = h[1000:1400]
    for scale in (4, 16, 64):
        places = set(runs.synchronising(h, np.zeros(len(h), bool), scale).tolist())
        one = {p - 1000 for p in places if 1000 <= p <= 1400 - 2 * scale}
        assert one == {p - 3000 for p in places if 3000 <= p <= 3400 - 2 * scale}
        assert all(places & set(range(i, i + scale)) for i in range(0, 5000 - 3 * scale, scale))
        assert len(places) < 3 * 5000 / scale


def test_runs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = random.Random(2)
    own = [(k + 10**6, " ".join(w.decode() for w in words)) for k, words in enumerate(periodic_texts(rng, 40))]
    odd = [None, "", " \n ", "one", "a " * 23, "a\x0b" * 24, "a b c " * 9, "a" * 50_000 + " b", "x y " * 20_000]
    own += [(k + 2 * 10**6, text) for k, text in enumerate(odd)] + [(None, "p q " * 20), (5, "p q " * 20), (5, "p q " * 20)]
    small = docs.filter("length(text) < 6000").select("doc_id", "text")
    df = small.union(spark.createDataFrame(own, "doc_id bigint, text string"))
    rows = [tuple(r) for r in df.collect()]
    # a long periodic text is checked by itself
    wanted = [brute.run_report(d, t) for d, t in rows if len(t or "") < 20_000 or " " not in t[:9]]
    got = sorted((tuple(r)[:8] for r in runs.report(df).collect()), key=repr)
    long = [r for r in got if r[0] == 2 * 10**6 + len(odd) - 1]
    assert sorted([r for r in got if r not in long], key=repr) == sorted(wanted, key=repr)
    assert len(long) == 1 and long[0][1] == 1 and long[0][4] in (2, *range(1, 20_000))


def test_runs_keep_their_own_columns(spark):
    rows = [(1, "go " * 30 + "on", 7, "r")]
    df = spark.createDataFrame(rows, "key bigint, body string, n_words int, runs string")
    found = runs.periodic_runs(df, "key", "body").first()
    assert found["key"] == 1 and found["n_words"] == 31 and found["collapsed"] == "go on"
    assert [tuple(r) for r in found["runs"]] == [(0, 30, 1)] == [tuple(found["strongest"])]
    assert runs.periodic_runs(df.limit(0), "key", "body").count() == 0


def some_conversations():
    rng = random.Random(3)
    texts = ["", "x", "<turn a>\n", "\\<", "é😀", None, "yes", *TRICKY]
    rows = []
    for c in range(120):
        first = rng.choice(["hi", "hello"])
        for t in range(900 if c == 40 else rng.randrange(14)):
            role = rng.choice(["user", "assistant", None, "a<b>\n\\"])
            rows.append((c, t or None, role, rng.choice(texts) if t else first))
    for c in range(200, 260):
        rows += [(c, 0, "user", "same"), (c, 1, "assistant", "copy"), (c, 1, "assistant", "copy")]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet").selectExpr("conv_id + 1000 AS conv_id", "turn", "role", "text")
    return spark.createDataFrame(some_conversations(), TURNS).repartition(7).unionByName(table).cache()


def test_trie(spark, talks, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 7)
    rows = [tuple(r) for r in talks.collect()] + [(None, 0, "user", "of no conversation")]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS id", "2 AS depth", "3 AS size", "4 AS f1")
    got = sorted((tuple(r) for r in trie.report(df).select(*TRIE).collect()), key=repr)
    assert got == brute.trie(rows)
    assert trie.report(df.limit(0)).count() == 0


def test_trie_tries_other_seeds(spark, monkeypatch):
    """With references that say little, turns look alike until a seed tells them apart."""
    import pyspark.sql.functions as F

    rows = [(c, t, "user", f"{c % 3}{t}") for c in range(30) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS)
    plain, seeds = trie.stored_turns, []

    def weak(conversations, seed):
        seeds.append(seed)
        turns = plain(conversations, seed)
        return turns.withColumns({"d1": F.lit(1).cast("bigint"), "d2": F.lit(1).cast("bigint")}) if seed < 3 else turns

    monkeypatch.setattr(trie, "stored_turns", weak)
    got = sorted((tuple(r) for r in trie.report(df).select(*TRIE).collect()), key=repr)
    assert got == brute.trie(rows) and seeds == [1, 2, 3]


def test_fingerprints_compose(spark):
    rows = [(c % 3, c, c * 7919, -c * 104729, c) for c in range(500)]
    df = spark.createDataFrame(rows, "id bigint, turn int, d1 bigint, d2 bigint, size int")
    one = {(r["id"], r["place"]): tuple(r) for r in prefixes.running(df.coalesce(1), ["turn"], 1).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    two = {(r["id"], r["place"]): tuple(r) for r in prefixes.running(df, ["turn"], 1).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert one == two and len({r[2:4] for r in one.values()}) == 500


def test_chats(spark, talks, monkeypatch):
    rows = [tuple(r) for r in talks.collect()] + [(None, 1, "user", "x"), (None, None, "assistant", "y")]
    rows += [(777, 0, "assistant", "<" * 300_000 + "\\" * 5)]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS id", "2 AS place", "3 AS part", "4 AS block")
    own = [(-7, 0, "user", *TRICKY), (-7, 1, "assistant", *TRICKY)]
    wanted = brute.chats(rows + own)
    assert sorted((tuple(r)[:5] for r in chat.report(df).collect()), key=repr) == wanted
    monkeypatch.setattr(chat, "HELD", 500)
    monkeypatch.setattr(chat, "BLOCK", 16)
    assert sorted((tuple(r)[:5] for r in chat.report(df).collect()), key=repr) == wanted


def test_pieces_are_the_template_s_text(spark, talks):
    texts = {}
    for r in chat.format_conversations(talks).orderBy("conv_id", "place").collect():
        texts.setdefault(r["conv_id"], []).append(r)
    for c, turns in brute.conversations([tuple(r) for r in talks.collect()]).items():
        whole = chat.apply([(r["piece"], r["rewritten"]) for r in texts[c]])
        assert whole == chat.marked(turns) and chat.read_back(whole) == turns
        for (role, text), r in zip(turns, texts[c], strict=True):
            own = None if r["start"] is None else chat.unescape(r["piece"][r["start"] : r["end"]])
            assert own == (text if role == "assistant" else None)
    assert chat.format_conversations(talks.limit(0)).count() == 0


def forgetful(turns):
    """Like templates that drop an answer's reasoning when the next question comes."""
    out = []
    for k, (role, text) in enumerate(turns):
        old = role == "assistant" and k + 1 < len(turns)
        out.append(f"[{role}] {text.split('=>')[-1] if old else text}|")
    return "".join(out)


def test_templates_that_rewrite_history(spark):
    turns = [("user", "1+1"), ("assistant", "hm => 2"), ("user", "2+2"), ("assistant", "so => 4"), ("user", "ok")]
    df = spark.createDataFrame([(1, k, *turn) for k, turn in enumerate(turns)], TURNS)
    rows = chat.format_conversations(df, forgetful).orderBy("place").collect()
    assert [r["rewritten"] > 0 for r in rows] == [False, False, True, False, True]
    assert chat.apply([(r["piece"], r["rewritten"]) for r in rows]) == forgetful(turns)
    assert rows[1]["piece"][rows[1]["start"] : rows[1]["end"]] == "hm => 2"
    shout = chat.format_conversations(df, lambda t: "".join(f"{r}:{x.upper()}x;" for r, x in t)).collect()
    assert [r["start"] is not None for r in shout] == [False, True, False, True, False]
    twice = chat.format_conversations(df, lambda t: "".join(f"{x}-{x};" for _, x in t)).collect()
    assert all(r["start"] is None for r in twice)


def test_templates_that_look_back_to_the_first_turn(spark, monkeypatch):
    turns = [("user" if k % 2 == 0 else "assistant", f"text {k % 3}") for k in range(41)]
    df = spark.createDataFrame([(c, k, *turn) for c in (1, None) for k, turn in enumerate(turns)], TURNS)

    def numbered(turns):
        return "".join(f"{turns[0][1]}#{k} {role}: {text}|" for k, (role, text) in enumerate(turns))

    for held, block in ((1 << 20, 256), (50, 8)):
        monkeypatch.setattr(chat, "HELD", held)
        monkeypatch.setattr(chat, "BLOCK", block)
        pieces = chat.format_conversations(df, numbered).orderBy("place").collect()
        for c in (1, None):
            own = [r for r in pieces if r["conv_id"] == c]
            assert [r["place"] for r in own] == list(range(1, 42)) and not any(r["rewritten"] for r in own)
            assert chat.apply([(r["piece"], r["rewritten"]) for r in own]) == numbered(turns)
            framed = [r["piece"][r["start"] : r["end"]] for r in own if r["start"] is not None]
            assert framed == [text for role, text in turns if role == "assistant"]
