"""A live source: the feeds of many relays, read by position, caught up with in bounded steps.

A feed is a file of JSON lines for each relay that only grows (what a connection
writes down as it listens). The stream's offset is the position in each feed,
always behind a whole line, so a query that starts again goes on where it was,
and a line that is still being written waits. A trigger admits ``most`` bytes of a
feed; what is left then is the lag, which stands in the offset and so in the
query's progress. Long stretches are read by several tasks, each the lines that
begin in its own bytes. Nothing is dropped.

On a start the position is taken from the query's own checkpoint, which
therefore has to be named in the options, as readers aren't told it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from eventide.sources.files import parse_lines

#: Bytes of a feed in a trigger, bytes that one task reads, longest line.
MOST, TASK, LINE = 64 << 20, 8 << 20, 4 << 20
#: Name of the lag in an offset; no relay has it.
LAG = "\0lag"


@dataclass
class Stretch(InputPartition):
    relay: str
    path: str
    start: int
    end: int


class FeedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.checkpoint = options["path"].rstrip("/"), options["checkpoint"].rstrip("/")
        self.most, self.task, self.source = int(options.get("most", MOST)), int(options.get("task", TASK)), int(options.get("source", 0))
        self.last: dict | None = None

    def initialOffset(self) -> dict:
        return {LAG: 0}

    def _logged(self) -> dict:
        """The end of the newest batch in the checkpoint, or the beginning."""
        fs, at = pafs.FileSystem.from_uri(f"{self.checkpoint}/offsets")
        found = [f for f in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)) if f.base_name.isdigit()]
        if not found:
            return self.initialOffset()
        with fs.open_input_stream(max(found, key=lambda f: int(f.base_name)).path) as f:
            lines = f.read().decode().splitlines()
        # A version, the batch's settings, then a line for each source.
        return json.loads(lines[2 + self.source])

    def latestOffset(self) -> dict:
        last = self._logged() if self.last is None else self.last
        fs, at = pafs.FileSystem.from_uri(self.folder)
        out, lag = {}, 0
        for f in sorted(fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)), key=lambda f: f.base_name):
            if f.is_file and f.base_name.endswith(".jsonl"):
                relay, start = f.base_name.removesuffix(".jsonl"), last.get(f.base_name.removesuffix(".jsonl"), 0)
                out[relay] = _behind_line(fs, f.path, start, min(f.size, start + self.most), f.size)
                lag += f.size - out[relay]
        # Feeds that have gone stay where they were.
        self.last = {**{k: v for k, v in last.items() if k != LAG}, **out, LAG: lag}
        return self.last

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for relay, last in end.items():
            first = start.get(relay, 0)
            if relay != LAG:
                out += [Stretch(relay, f"{self.folder}/{relay}.jsonl", a, min(a + self.task, last)) for a in range(first, last, self.task)]
        self.last = self.last or end
        return out

    def read(self, partition: Stretch):
        fs, at = pafs.FileSystem.from_uri(partition.path)
        with fs.open_input_file(at) as f:
            a = partition.start
            f.seek(max(a - 1, 0))
            rest = f.read(partition.end - max(a - 1, 0))
            # The first line that begins here, if the stretch begins within one.
            skip = 0 if a == 0 else rest.find(b"\n") + 1
            if a and not skip:
                return
            while rest and not rest.endswith(b"\n") and (more := f.read(1 << 16)):
                cut = more.find(b"\n")
                rest += more if cut < 0 else more[: cut + 1]
        lines = rest[skip:].decode("utf-8", "replace").split("\n")
        lines = [x for x in (lines[:-1] if rest.endswith(b"\n") else lines) if x.strip()]
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array(lines), pa.array([partition.relay] * len(lines))], names=["value", "relay"])

    def commit(self, end: dict) -> None:
        pass


def _behind_line(fs, path: str, start: int, end: int, size: int) -> int:
    """The last position up to end, or a little on, that is behind a whole line; start where there is none."""
    if end <= start:
        return start
    with fs.open_input_file(path) as f:
        f.seek(max(start, end - LINE))
        held = f.read(end - max(start, end - LINE))
        if b"\n" in held:
            return end - len(held) + held.rfind(b"\n") + 1
        # One line is longer than what a trigger admits: to its end, if it is there.
        rest = f.read(min(size - end, LINE))
        return end + rest.find(b"\n") + 1 if b"\n" in rest else start


class Feeds(DataSource):
    """``spark.readStream.format("relay_feeds")``: value and relay of each line."""

    @classmethod
    def name(cls) -> str:
        return "relay_feeds"

    def schema(self) -> str:
        return "value string, relay string"

    def streamReader(self, schema) -> FeedReader:
        return FeedReader({k.lower(): v for k, v in self.options.items()})


def feeds(spark: SparkSession, folder: str, checkpoint: str, most: int = MOST, task: int = TASK) -> DataFrame:
    """Lines of all feeds of a folder (a URI), with their relay, as they come. ``checkpoint``: that of the query that reads them."""
    spark.dataSource.register(Feeds)
    return spark.readStream.format("relay_feeds").option("checkpoint", checkpoint).option("most", most).option("task", task).load(folder)


def subscribed(lines: DataFrame, since: int | None = None, kinds: tuple[int, ...] = ()) -> DataFrame:
    """Valid events of the lines, from since on and of these kinds: what a subscription asks for."""
    own = parse_lines(lines).events
    own = own if since is None else own.where(F.col("created_at") >= since)
    return own.where(F.col("kind").isin(*kinds)) if kinds else own


def lag(query: StreamingQuery) -> int | None:
    """Bytes that the newest batch has left behind, from the query's progress."""
    progress = query.lastProgress
    if progress is None:
        return None
    end = json.loads(progress.json)["sources"][0]["endOffset"]
    return int((json.loads(end) if isinstance(end, str) else end)[LAG])
