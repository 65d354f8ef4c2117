"""Lines, chats, addresses and the pipeline on odd rows; queries against their DuckDB twins."""

import datetime as dt
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import chat, lines, urls
from ledgerlens.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import DOCUMENTS, prose

DATA = "/root/testdata/sf0.001"


def counted(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, name):
    for table in ("pages", "conversations"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = QUERIES[name](spark, DATA)
    order = sorted(found.columns)
    want = duckdb.sql(ORACLES[name])
    assert order == sorted(want.columns)
    assert counted(tuple(r[c] for c in order) for r in found.collect()) == counted(want.select(*order).fetchall())


@pytest.mark.parametrize("broadcast", [lines.BROADCAST, 0])
def test_line_dedup(frame, odd_rows, monkeypatch, broadcast):
    monkeypatch.setattr(lines, "BROADCAST", broadcast)
    rows = odd_rows + [(500 + i, f"site menu\n{prose(i, 12)}\n\n site menu \nonce {i}", "en", "menu" if i < 20 else "tiny") for i in range(23)]
    pages, held = Counter(), defaultdict(Counter)
    for _, t, _, s in rows:
        pages[s] += 1
        held[s].update({x.strip(" \t\r") for x in (t or "").split("\n")} - {""} if t is not None else ())
    common = {s: {x for x, n in c.items() if n >= lines.LEAST and n > lines.RATIO * pages[s]} for s, c in held.items()}
    assert common["menu"] == {"site menu"} and not common["tiny"]
    want = []
    for i, t, _, s in rows:
        parts = t.split("\n") if t is not None else []
        kept = [x for x in parts if x.strip(" \t\r") not in common[s]]
        n = sum(x.strip(" \t\r") != "" for x in parts)
        want.append((i, None if t is None else "\n".join(kept), n, n - sum(x.strip(" \t\r") != "" for x in kept)))
    found = lines.drop_boilerplate(frame(rows), "source", "text")
    assert counted(found.select("doc_id", "text", "n_lines", "n_dropped").collect()) == counted(want)
    assert "token" in found.columns and lines.drop_boilerplate(frame([]), "source", "text").count() == 0


def test_copies_of_a_text_get_several_salts(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST", 0)
    monkeypatch.setattr(lines, "SALT_PAGES", 30, raising=False)
    rows = [(i, "big", "site menu\nsame text" if i % 3 else None) for i in range(300)] + [(900 + i, "small", "foot\nx") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    made, keep = [], type(df).withColumn

    def seen(self, name, value):
        out = keep(self, name, value)
        if name == "__salt":
            made.append(out)
        return out

    monkeypatch.setattr(type(df), "withColumn", seen)
    found = lines.drop_boilerplate(df, "source", "text")
    assert counted(found.select("doc_id", "text", "n_dropped").collect()) == counted((i, None if t is None else "", 0 if t is None else 2) for i, _, t in rows)
    salts = {(r.source, r.text): r.n for r in made[0].groupBy("source", "text").agg(F.countDistinct("__salt").alias("n")).collect()}
    assert salts == {("big", None): 10, ("big", "site menu\nsame text"): 10, ("small", "foot\nx"): 1}


def test_html_lines(spark):
    page = "<html><head><title>T</title><style>p{}</style></head><body><!-- x --><p>a <b>b</b> &amp;amp;<br>c</p><script>var a='<p>';</script><li>d</li></body>"
    df = spark.createDataFrame([(page,), (None,), ("",)], "h string").select(lines.html_lines(F.col("h")).alias("t"))
    assert [r.t for r in df.collect()] == ["T\na b &amp;\nc\nd", None, ""]


def test_hosts(spark):
    cases = {"http://A.Example.com:80/x": "a.example.com", "https://u:p@b.org./": "b.org", "nothing": None, "": None, None: None, "ftp://x?q": "x"}
    df = spark.createDataFrame([(u,) for u in cases], "u string").select("u", lines.host(F.col("u")).alias("h"))
    assert {r.u: r.h for r in df.collect()} == cases


def test_rotation(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, "ann", "é😀"), (1, 3, "ann", "é😀"),
             (2, 0, "system", "alone"), (3, None, None, "who"), (None, 0, "x", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").selectExpr("*", "'clash' AS part", "1 AS participant")
    found = {(r.conv_id, r.participant): r for r in chat.rotate(df).collect()}
    assert set(found) == {(1, "ann"), (1, "bob"), (3, chat.UNKNOWN), (None, "x")}
    r = found[1, "ann"]
    assert r.n_turns == 5 and r.rendered.count(chat.END) == 5
    assert [r.rendered[s.start:s.end] for s in r.spans] == ["hi <| im_end|>" + chat.END, "é😀" + chat.END, "é😀" + chat.END]
    assert "user name=bob\n" in r.rendered and "assistant\n" in r.rendered and "system\nbe kind" in r.rendered
    assert [found[1, "bob"].rendered[s.start:s.end] for s in found[1, "bob"].spans] == [chat.END]
    assert chat.rotate(df.limit(0)).count() == 0


def test_long_dialogues_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 4)
    df = spark.createDataFrame([(1, i, "ab"[i % 2], str(i)) for i in range(10)], "conv_id long, turn int, role string, text string")
    assert sorted((r.part, r.participant, r.n_turns) for r in chat.rotate(df).collect()) == [(0, "a", 4), (0, "b", 4), (1, "a", 4), (1, "b", 4), (2, "a", 2), (2, "b", 2)]


@pytest.mark.parametrize("part", [3, chat.PART])
def test_long_dialogues_equal_the_twin(spark, tmp_path, monkeypatch, part):
    """Participants silent in a part, more turns than a part, a dialogue in several ranges; the twin renders dialogues whole."""
    monkeypatch.setattr(chat, "PART", part)
    rows = [(1, i, "ann" if i < 5 else "bob" if i % 7 else "system" if i % 2 else None, f"é{i} <|im_end|>") for i in range(2100)]
    rows += [(2, i // 3, "xyz"[i % 3], "t" * i) for i in range(8)] + [(3, 0, "system", "alone"), (4, 0, "ann", None)]
    (tmp_path / "conversations.parquet").mkdir()
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3).write.mode("overwrite").parquet(path)
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    found = QUERIES["op5_chat"](spark, str(tmp_path))
    want = duckdb.sql(ORACLES["op5_chat"])
    assert counted(found.collect()) == counted(want.select(*found.columns).fetchall())
    parts = chat.rotate(spark.read.parquet(path))
    number = Counter((r.conv_id, r.participant) for r in parts.collect())
    assert number[1, "ann"] == number[1, "bob"] == number[1, chat.UNKNOWN] == -(-2100 // part)


def test_address_lists(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    entries = [("host", "bad.com", "spam", day(10), "add"), ("host", "bad.com", "spam", day(10), "add"), ("host", "bad.com", "spam", day(12), "add"),
               ("host", "bad.com", "spam", day(100), "remove"), ("host", "bad.com", None, day(50), "add"), ("url", "ok.org/a/b", "x", day(0), "add"),
               ("url", "ok.org/q?z", "y", day(0), "add"), ("host", None, "spam", day(0), "add"), ("host", "org", "z", None, "add"), ("host", "ok.org", "z", day(5), "odd"),
               ("host", "same.com", "s", day(3), "add"), ("host", "same.com", "s", day(3), "remove")]
    history = spark.createDataFrame(entries, "kind string, value string, category string, listed_at timestamp, action string")
    captures = [("http://www.BAD.com/x", day(9)), ("http://www.BAD.com/x", day(10)), ("http://bad.com", day(60)), ("http://bad.com", day(100)), ("http://notbad.com", day(20)),
                ("https://ok.org/a/b", day(1)), ("https://ok.org/a/b/c?d#e", day(1)), ("https://ok.org/a/bc", day(1)), ("https://ok.org/q?z", day(1)), ("https://ok.org/q", day(1)),
                ("http://same.com", day(4)), (None, day(1)), ("http://bad.com", None), ("no address", day(1)), ("http://bad.com", day(60))]
    df = spark.createDataFrame(captures, "url string, fetched_at timestamp").selectExpr("*", "'clash' AS value", "'clash' AS month", "1 AS n_entries")
    valid = urls.validity(history)
    assert valid.count() == 4
    found = counted(urls.judge(df, valid).select("url", "fetched_at", "blocked", "n_entries", "category").collect())
    hits = [0, 1, 2, 1, 0, 1, 1, 0, 1, 0, 0, 0, 0, 0, 2]
    names = [None, "spam", "none", "none", None, "x", "x", None, "y", None, None, None, None, None, "none"]
    assert found == counted((u, t, n > 0, n, c) for (u, t), n, c in zip(captures, hits, names))
    assert urls.judge(df.limit(0), valid).count() == 0 and urls.judge(df, valid.limit(0)).where("blocked").count() == 0


def test_deep_address_lists(spark):
    day = dt.datetime(2024, 1, 1)
    name, path = ".".join(f"l{k}" for k in range(8)) + ".org", "deep.net" + "".join(f"/s{k}" for k in range(11)) + "?u=http:"
    assert len(name.split(".")) == 9 and len(re.split("(?=[/?])", path)) == 13
    entries = [("host", name, "h", day, "add"), ("url", path, "u", day, "add"), ("url", "deep.net/s0", "v", day, "add"), ("host", "wide.org", "w", day, "add")]
    history = spark.createDataFrame(entries, "kind string, value string, category string, listed_at timestamp, action string")
    want = {f"http://{name}/": ["h"], f"http://www.a.{name}/x": ["h"], f"http://{name[3:]}/": [], f"http://{path}": ["u", "v"], f"http://{path}//x.org/y?z": ["u", "v"],
            f"http://{path[:-1]}": ["v"], f"http://{path}x": ["v"], "http://" + ".".join("abcdefghijkl") + ".wide.org/1/2/3": ["w"]}
    found = urls.judge(spark.createDataFrame([(u, day) for u in want], "url string, fetched_at timestamp"), urls.validity(history)).collect()
    assert {r.url: (r.n_entries, r.category) for r in found} == {u: (len(c), min(c, default=None)) for u, c in want.items()}


def _stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, frame, odd_rows, name):
    columns = DOCUMENTS.names
    for rows in (odd_rows, []):
        out = _stage(name)(spark, frame(rows), DATA)
        assert name == "sentencepiece" or out.columns == columns
        out.collect()


def test_near_duplicate_stage_keeps_one_of_each_group(spark, frame, odd_rows):
    kept = _stage("near_duplicates")(spark, frame(odd_rows), DATA).collect()
    ids = Counter(r.doc_id for r in kept)
    assert 1 in ids and 2 not in ids and 3 not in ids and ids[7] == 1 and 8 not in ids
    assert ids[None] == 2 and {4, 5, 6, 9, 10, 11, 13, 14, 15, 16, -3} <= set(ids)


def test_mix_stage_follows_the_targets(spark, frame):
    rows = [(i, prose(i, 50), "en", "abc"[i % 3]) for i in range(150)]
    out = Counter(r.source for r in _stage("source_mix")(spark, frame(rows), DATA).collect())
    want = {"a": 150 * 5 / 8, "b": 150 * 2 / 8, "c": 150 / 8}
    assert all(abs(out[s] - n) <= 3 for s, n in want.items())


def test_pipeline_equals_its_stages_in_plain_form(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {r.doc_id: r for r in _stage("near_duplicates")(spark, _stage("line_dedup")(spark, _stage("quality_rules")(spark, docs, DATA), DATA), DATA).collect()}
    out = corpus_pipeline.run(spark, DATA).collect()
    import public_tokenizers
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.TOKENIZER))
    assert out and {r.doc_id for r in out} <= set(kept)
    for r in out:
        assert list(r.ids) == library.encode(kept[r.doc_id].text) and r.round_trip and r.n_tokens == len(r.ids)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in kept.values())
    mixed = sum(len(re.findall(r"[^\x20\x09-\x0D]+", kept[r.doc_id].text)) for r in out)
    assert abs(mixed - words) < 0.15 * words


def test_pipeline_rows_that_differ_in_nulls_only_are_told_apart(spark):
    rows = [(9999, "text", "en", None, 4), (9999, "text", None, "en", 4), (9999, None, "text", "en", 4), (None, "text", "en", None, 4), (9999, "text", "en", None, None),
            (9999, "text", "en", None, 5), (9999, "", "en", None, 4), (None, None, None, None, None), (0, "", "", "", 0)]
    df = spark.createDataFrame(rows + rows, "doc_id long, text string, lang string, source string, n_chars long")
    keys = [r.key for r in df.select(corpus_pipeline._key()).collect()]
    assert len(set(keys)) == len(rows) and keys[:len(rows)] == keys[len(rows):] and {len(k) for k in keys} == {32}
