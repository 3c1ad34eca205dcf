"""The live source: each line once, across restarts, in bounded steps."""

import json

from test_sources import event

from eventide.streaming import live


def append(path, *lines, end="\n"):
    with path.open("a", encoding="utf-8") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + end)


def run(spark, folder, check, out, most=10**6, task=10**6):
    """Until nothing new comes; the number of batches and the lag after each."""
    lines = live.feeds(spark, "file://" + str(folder), "file://" + str(check), most, task)
    q = lines.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", "file://" + str(check)).start()
    try:
        q.processAllAvailable()
        return [p["sources"][0]["endOffset"] for p in q.recentProgress if p["numInputRows"]], live.lag(q)
    finally:
        q.stop()


def test_each_line_once(spark, tmp_path):
    folder, check, out = tmp_path / "feeds", tmp_path / "check", tmp_path / "out"
    folder.mkdir()
    for relay in ("a", "b"):
        append(folder / f"{relay}.jsonl", *[f"{relay}{i} é" for i in range(50)])
    append(folder / "a.jsonl", "half", end="")  # a line that is still being written
    ends, left = run(spark, folder, check, out, most=100, task=7)
    assert len(ends) >= 3 and left == len("half")
    append(folder / "a.jsonl", " whole", "more")
    append(folder / "c.jsonl", "new")
    again, left = run(spark, folder, check, out, most=100, task=7)
    assert again and left == 0
    got = sorted((r.relay, r.value) for r in spark.read.parquet(str(out)).collect())
    assert got == sorted([(x, f"{x}{i} é") for x in "ab" for i in range(50)] + [("a", "half whole"), ("a", "more"), ("c", "new")])
    # Nothing new, from a checkpoint in the middle of the feeds.
    assert run(spark, folder, check, out)[0] == []


def test_lines_longer_than_a_step(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    append(folder / "a.jsonl", "x" * 5000, "y", "", "z" * 3000)
    run(spark, folder, tmp_path / "c", tmp_path / "o", most=50, task=11)
    assert sorted(len(r.value) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 3000, 5000]


def test_subscription(spark):
    lines = spark.createDataFrame([(json.dumps(event("old", at=10)),), (json.dumps(event("new", at=100)),), (json.dumps(event("other", at=100, kind=7)),), ("{bad",)], "value string")
    assert [r.content for r in live.subscribed(lines, since=50, kinds=(1,)).collect()] == ["new"]
