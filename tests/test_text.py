"""Cleaning, tokens, sources on hand-made rows."""

import html
import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmuro.functions import text, tokens
from murmuro.operators import browse, clean, lexical, order, overview
from murmuro.sources import bind, files

DIRTY = [
    (0, "&lt;b&gt;hi&lt;/b&gt; there"),
    (1, "see https://a.b/c now"),
    (2, "soooo gooood!!!"),
    (3, "1000000"),
    (4, "Ａ ﬁ"),
    (5, "a   b c"),
    (6, "wow 😀 ❤"),
    (7, None),
    (8, "ok"),
    (9, "soooooo  gooooood!!!!"),
    (10, "a\n\n\n\nb"),
]
CLEANED = {
    0: "hi there", 1: "see now", 2: "soo good!!".replace("good", "good"), 3: "100", 4: "A fi", 5: "a b c",
    6: "wow ❤", 7: "", 8: "ok", 9: "soo good!!", 10: "a b",
}


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_clean_text(spark):
    df = spark.createDataFrame(DIRTY, "doc_id bigint, text string")
    assert dict(rows(df.select("doc_id", text.clean_text(F.col("text"))))) == CLEANED


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="ab &;<>lt\n é！😀wh/.:tps", max_size=30), min_size=1, max_size=60))
def test_clean_text_is_the_same_on_both_paths(spark, texts):
    """The JVM path and the Python path of decoding together equal the plain definition."""

    def plain(t):
        t = html.unescape(t)
        t = re.sub(r"<[^>]+>", " ", t)
        t = re.sub(r"https?://\S+|www\.\S+", " ", t)
        t = unicodedata.normalize("NFKC", t)
        t = "".join(c for c in t if c in "\t\n\r" or " " <= c <= "~" or " " <= c <= "￿")
        t = re.sub(r"(.)\1{2,}", r"\1\1", t)
        return re.sub(r"\s+", " ", t).strip()

    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = dict(rows(df.select("i", text.clean_text(F.col("text")))))
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_clean_comments_keeps_first_and_numbers(spark):
    df = spark.createDataFrame(DIRTY, "doc_id bigint, text string")
    got = rows(clean.clean_comments(df).orderBy("doc_id").select("doc_id", "comment_id", "text", "text_raw"))
    assert [g[0] for g in got] == [0, 1, 2, 3, 4, 5, 6, 10]
    assert [g[1] for g in got] == [f"c{i:06d}" for i in range(8)]
    assert got[2][3] == "soooo gooood!!!"


def test_tokens(spark):
    df = spark.createDataFrame([("I CANNOT loooove the Graphics!!! gonna <b>win</b> 10 http://x.y café",)], "text string")
    row = df.select(
        tokens.raw_tokens(F.col("text")).alias("raw"), tokens.clean_tokens(F.col("text")).alias("clean")
    ).first()
    assert row["raw"] == ["i", "can", "not", "loove", "the", "graphics", "gon", "na", "win", "10", "caf"]
    assert row["clean"] == ["loove", "graphics", "gon", "na", "win", "caf"]


def test_questions(spark):
    df = spark.createDataFrame([(1, "is it? yes"), (2, "How is it"), (3, None), (4, "what??")], "doc_id int, text string")
    assert {r[0] for r in rows(browse.questions(df))} == {1, 4}
    assert overview.question_share(df).first()["question_share"] == 0.5
    assert overview.question_share(df.limit(0)).first()["question_share"] == 0.0


def test_emoji(spark):
    data = [("😀😀 ❤️ x",), ("none",), ("👍🏽 😀 👨‍👩‍👧 🇫🇷",), (None,)]
    df = spark.createDataFrame(data, "text_raw string")
    assert dict(rows(lexical.emoji_counts(df))) == {"😀": 3, "❤️": 1, "👍🏽": 1, "👨‍👩‍👧": 1, "🇫🇷": 1}


def test_prefix_sum_and_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 10007).alias("k"), (F.col("id") % 3).alias("v"))
    got = rows(order.prefix_sum(df, "k", "v", "before").orderBy("k").select("v", "before"))
    total = 0
    for v, before in got:
        assert before == total
        total += v
    assert [r[0] for r in rows(order.row_numbers(df, "k").orderBy("k").select("row_no"))] == list(range(1000))


def test_hot_text_is_one_row(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 1, "same").otherwise(F.col("id").cast("string")).alias("text")
    )
    got = clean.first_by_text(df)
    assert got.count() == 2001 and got.where("text = 'same'").first()["doc_id"] == 1


def test_csv_source(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(
        '﻿video_id,author,text,likes,published_at\nv,NA,"two\nlines, ""quoted""",3,2024-05-01T10:00:00Z\nv,b,null,,bad\n',
        encoding="utf-8",
    )
    got = rows(files.read_comments_csv(spark, str(path)).withColumn("published_at", text.parse_time(F.col("published_at"))))
    assert got[0][:4] == ("v", None, 'two\nlines, "quoted"', 3) and got[0][4].year == 2024
    assert got[1][2] is None and got[1][3] is None and got[1][4] is None


def test_load_comments_falls_back(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert files.load_comments(spark, missing, missing).count() == 0
    files.write_csv(
        spark.createDataFrame([("v", "a", "t", 1, "2024-01-01")], bind.RAW_COMMENTS), str(tmp_path / "clean.csv")
    )
    assert files.load_comments(spark, missing, str(tmp_path / "clean.csv")).first()["likes"] == 1
    files.write_enriched(spark.createDataFrame([("x", ["k"])], "text string, keywords array<string>"), str(tmp_path / "e"))
    assert files.load_comments(spark, str(tmp_path / "e"), missing).first()["keywords"] == ["k"]


def test_csv_sink_writes_lists_as_json(spark, tmp_path):
    files.write_csv(spark.createDataFrame([("x", ["a", "b"])], "text string, keywords array<string>"), str(tmp_path / "o"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "o")).first()["keywords"] == '["a","b"]'


def page(video, no, texts):
    items = [
        {"snippet": {"topLevelComment": {"snippet": {"authorDisplayName": "a", "textDisplay": t, "likeCount": i, "publishedAt": "d"}}}}
        for i, t in enumerate(texts)
    ]
    return {"video_id": video, "page_no": no, "items": items, "nextPageToken": None}


def test_collect_pages_overshoots_to_the_page_end(spark):
    pages = [page("v1", 0, ["a", "b"]), page("v1", 1, ["c", "a"]), page("v1", 2, ["x"]), page("v2", 0, ["y"])]
    df = spark.createDataFrame(pages, files.COLLECTOR_PAGE)
    assert {r["text"] for r in files.collect_pages(df, 3, ["v1", "v2"]).collect()} == {"a", "b", "c"}
    got = {r["text"]: r["likes"] for r in files.collect_pages(df, 100, ["v2", "v1"]).collect()}
    assert got == {"a": 0, "b": 1, "c": 0, "x": 0, "y": 0}


def test_metrics_index_and_stages(spark, tmp_path):
    metrics = spark.createDataFrame([("mrr", 0.5)], "key string, value double")
    for run in ("one", "two"):
        files.write_metrics(metrics, str(tmp_path / "m"), run, {"top_k": "6"})
    assert {(r["run_name"], r["params"]["top_k"]) for r in spark.read.parquet(str(tmp_path / "m")).collect()} == {
        ("one", "6"), ("two", "6"),
    }
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    path = str(tmp_path / "s")
    assert files.build_stage(spark, path, build).count() == 1
    assert files.build_stage(spark, path, build).count() == 1
    assert files.build_stage(spark, path, build, rebuild=True).count() == 2
    (tmp_path / "s" / "_SUCCESS").unlink()
    assert files.build_stage(spark, path, build).count() == 3
    (tmp_path / "empty").mkdir()
    assert not files.exists(spark, str(tmp_path / "empty")) and not files.complete(spark, str(tmp_path / "empty"))
    (tmp_path / "one.parquet").write_bytes(next((tmp_path / "s").glob("part*")).read_bytes())
    assert files.complete(spark, str(tmp_path / "one.parquet"))


def test_scope_and_optional_columns(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "doc_id bigint, text string")
    assert [r[0] for r in rows(browse.scope(df, 3, "most liked"))] == [0, 1, 2]
    sample = {r[0] for r in rows(browse.scope(df, 4, "random"))}
    assert len(sample) == 4 and sample == {r[0] for r in rows(browse.scope(df.repartition(3), 4, "random"))}
    assert browse.scope(df, 50).count() == 10
    assert browse.browse_view(df, "newest").columns == ["doc_id", "text"]
    assert browse.browse(df, "T3").count() == 1


def test_any_blank_separates_words(spark):
    df = spark.createDataFrame([("a\u00a0b\u2003c\u3000d e",), ("One.\u00a0Two!\u2003Three",)], "text string")
    got = [tuple(r) for r in df.select(text.word_count(F.col("text")), text.syllable_count(F.col("text")), F.size(text.sentences(F.col("text")))).collect()]
    assert got == [(5, 5, 1), (3, 4, 3)]
