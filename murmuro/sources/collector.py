"""Collector pages as a Spark data source, for batch and for streams.

A collector asks for a video's comments page by page: every page has its items and the token of the next one. The source
follows the tokens, video after video, and ends at the end of the page on which `target` rows are reached. Following
tokens is one step after the other by nature and takes place in the planner, which counts a page's items and keeps
none; every page is then read by a task of its own. In a stream the place in the chain is the offset, and it follows
from the pages alone: after a restart the engine's own offsets decide what is read, so no page is read twice or left out.

Pages come from a store of JSON files, `video=…/token=…/` under a path on any file system that Arrow reaches. A page that
is not there yet is waited for; one with an `error` ends its video, as a failed request does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "video_id string, page_no bigint, item_no int, author string, text string, likes bigint, published_at string"
FIRST = "first"


class PageStore:
    """Stored pages by video and token."""

    def __init__(self, path: str) -> None:
        self.path = path

    def page(self, video: str, token: str) -> dict | None:
        """The page, or None while it is not there."""
        system, root = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        folder = f"{root}/video={quote(video, safe=' ')}/token={quote(token, safe=' ')}"
        try:
            found = [f.path for f in system.get_file_info(fs.FileSelector(folder)) if not f.base_name.startswith(("_", "."))]
        except FileNotFoundError:
            return None
        if not found:
            return None
        with system.open_input_stream(sorted(found)[0]) as stream:
            return json.loads(stream.read())


class Chain:
    """The pages of several videos as one chain. A place is (video number, token, page number, rows before it)."""

    def __init__(self, store: PageStore, videos: list[str], target: int) -> None:
        self.store, self.videos, self.target = store, videos, target

    def start(self) -> tuple:
        return 0, FIRST, 0, 0

    def ended(self, place: tuple) -> bool:
        return place[0] >= len(self.videos) or place[3] >= self.target

    def after(self, place: tuple) -> tuple | None:
        """The place behind the page at `place`; None while that page is not there."""
        video, token, number, rows = place
        page = self.store.page(self.videos[video], token)
        if page is None:
            return None
        rows += len(page.get("items") or ())
        following = page.get("nextPageToken")
        return (video, following, number + 1, rows) if following and "error" not in page else (video + 1, FIRST, 0, rows)

    def places(self, begin: tuple, end: tuple | None = None) -> Iterator[tuple]:
        """The places of the pages from `begin` on, before `end` or as far as pages are there."""
        at = begin
        while at != end and not self.ended(at) and (following := self.after(at)):
            yield at
            at = following

    def latest(self, begin: tuple) -> tuple:
        at = begin
        while not self.ended(at) and (following := self.after(at)):
            at = following
        return at


class PagePartition(InputPartition):
    def __init__(self, place: tuple) -> None:
        self.place = place


def _rows(chain: Chain, place: tuple) -> Iterator[pa.RecordBatch]:
    video, token, number, _ = place
    items = (chain.store.page(chain.videos[video], token) or {}).get("items") or []
    found = [x["snippet"]["topLevelComment"]["snippet"] for x in items]
    columns = [[chain.videos[video]] * len(found), [number] * len(found), list(range(len(found)))]
    columns += [[x.get(n) for x in found] for n in ("authorDisplayName", "textDisplay", "likeCount", "publishedAt")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


class _Batch(DataSourceReader):
    def __init__(self, chain: Chain) -> None:
        self.chain = chain

    def partitions(self) -> list[PagePartition]:
        return [PagePartition(p) for p in self.chain.places(self.chain.start())]

    def read(self, partition: PagePartition) -> Iterator[pa.RecordBatch]:
        # A source without pages has one empty partition, which is None.
        return _rows(self.chain, partition.place) if partition else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        self.at = chain.start()

    def initialOffset(self) -> dict:
        return {"place": list(self.chain.start())}

    def latestOffset(self) -> dict:
        self.at = self.chain.latest(self.at)
        return {"place": list(self.at)}

    def partitions(self, start: dict, end: dict) -> list[PagePartition]:
        return [PagePartition(p) for p in self.chain.places(tuple(start["place"]), tuple(end["place"]))]

    def read(self, partition: PagePartition) -> Iterator[pa.RecordBatch]:
        return _rows(self.chain, partition.place)

    def commit(self, end: dict) -> None:
        pass


class CommentPages(DataSource):
    """`spark.read.format("comment_pages")`, options `path`, `videos` (comma-separated, in order) and `target`."""

    @classmethod
    def name(cls) -> str:
        return "comment_pages"

    def schema(self) -> str:
        return SCHEMA

    def _chain(self) -> Chain:
        videos = [v.strip() for v in self.options.get("videos", "").split(",") if v.strip()]
        return Chain(PageStore(self.options["path"]), videos, int(self.options.get("target", 1 << 62)))

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self._chain())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self._chain())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CommentPages)
