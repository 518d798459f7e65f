"""The collector source on stored pages."""

from __future__ import annotations

import json

import pytest

from murmuro.sources import collector


def put(path, video, token, texts, following=None, **more):
    folder = path / f"video={video}" / f"token={token}"
    folder.mkdir(parents=True)
    snippet = lambda t: {"authorDisplayName": "a", "textDisplay": t, "likeCount": 3, "publishedAt": "2024-01-01T00:00:00Z"}
    items = [{"snippet": {"topLevelComment": {"snippet": snippet(t)}}} for t in texts]
    page = {"items": items, **({"nextPageToken": following} if following else {}), **more}
    (folder / "part-0.txt").write_text(json.dumps(page))


@pytest.fixture()
def pages(spark, tmp_path):
    collector.register(spark)
    path = tmp_path / "pages"
    put(path, "v1", "first", ["a", "b"], "t1")
    put(path, "v1", "t1", ["c", "d"], "t2")
    put(path, "v1", "t2", ["e"])
    put(path, "v2", "first", [], "t1")
    put(path, "v2", "t1", ["f", "g"], error="quota")
    put(path, "v3", "first", ["h"])
    return path


def read(spark, path, videos, target=100):
    df = spark.read.format("comment_pages").option("path", str(path)).option("videos", videos).option("target", target).load()
    return sorted((r.video_id, r.page_no, r.item_no, r.text) for r in df.collect())


def test_all_pages_in_the_order_of_the_videos(spark, pages):
    got = read(spark, pages, "v1, v2,v3")
    assert [r[3] for r in got] == list("abcdefgh")
    assert got[0] == ("v1", 0, 0, "a") and got[4] == ("v1", 2, 0, "e") and got[6] == ("v2", 1, 1, "g")


@pytest.mark.parametrize("target,want", [(1, "ab"), (2, "ab"), (3, "abcd"), (5, "abcde"), (6, "abcdefg"), (0, "")])
def test_ends_with_the_page_that_reaches_the_target(spark, pages, target, want):
    assert "".join(r[3] for r in read(spark, pages, "v1,v2,v3", target)) == want


def test_one_task_per_page_and_no_pages(spark, pages, tmp_path):
    df = spark.read.format("comment_pages").option("path", str(pages)).option("videos", "v1,v2").load()
    assert df.rdd.getNumPartitions() == 5 and df.first().likes == 3
    assert read(spark, tmp_path / "nowhere", "v1") == [] and read(spark, pages, "") == []


def test_a_stream_reads_every_page_once(spark, pages, tmp_path):
    def run():
        stream = spark.readStream.format("comment_pages").option("path", str(pages)).option("videos", "v4,v1").option("target", 9).load()
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect())

    put(pages, "v4", "first", ["1", "2"], "t1")
    assert run() == ["1", "2"]
    # The next page is not there yet; nothing comes twice.
    assert run() == ["1", "2"]
    put(pages, "v4", "t1", ["3"])
    assert run() == ["1", "2", "3", *"abcde"]
    # A restart after the batch was written but before it counted as done.
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == ["1", "2", "3", *"abcde"]
