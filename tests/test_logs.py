import collections
import random

import pytest
from pyspark.sql import functions as F

from fleetledger.operators import logs
from fleetledger.sources import readers

NAMES = ["routes", "published", "with_error", "already_minted", "insufficient_funds", "handler_crashed", "nonce_too_low", "underpriced"]
TEXTS = ["Transaction successfully sent: x", "Publishing route id 5", "Error publishing route id 5: nonce too low",
         "Token already minted for 5", "Error publishing route id 5: insufficient funds for gas", "noise", "method handler crashed",
         "replacement transaction underpriced"]


def by_hand(streams):
    """Counters per date, the date being the one last seen in the stream."""
    counts = collections.defaultdict(collections.Counter)
    for lines in streams:
        date = ""
        for line in lines:
            if "Parameters:" in line:
                words = line.split()
                date = words[8] if len(words) > 8 else ""
            for name, text in logs.COUNTERS.items():
                counts[date][name] += text in line
    out = {}
    for date, c in counts.items():
        if c["publishing"]:
            out[date] = (c["publishing"] + c["minted"], c["sent"] + c["minted"], c["with_error"], c["minted"],
                         c["insufficient_funds"], c["handler_crashed"], c["nonce_too_low"], c["underpriced"])
    return out


def streams(seed):
    rng = random.Random(seed)
    made = []
    for s in range(4):
        lines = []
        for i in range(400 if s == 0 else 40):
            if rng.random() < 0.02:
                lines.append(f"[INFO] t r Parameters: environment: staging, processing date: 2024-01-{rng.randrange(1, 9):02d} 00:00:00")
            else:
                lines.append(rng.choice(TEXTS))
        made.append(lines)
    return made


@pytest.mark.parametrize("block", [3, 50, 100_000])
def test_statistics_equal_a_sequential_reading(spark, block):
    made = streams(block)
    rows = [(s, i, line) for s, lines in enumerate(made) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "stream int, line_no bigint, line string").repartition(5)
    size = F.expr(f"line_no div {block}")
    got = logs.publish_stats(df, block=size).collect()
    assert {r.date: tuple(r[n] for n in NAMES) for r in got} == by_hand(made)
    assert [r.date for r in got] == sorted(r.date for r in got)
    dated = {(r.stream, r.line_no): r.date for r in logs.with_dates(df, block=size).collect()}
    assert len(dated) == len(rows)
    for s, lines in enumerate(made):
        date = ""
        for i, line in enumerate(lines):
            date = line.split()[8] if "Parameters:" in line else date
            assert dated[(s, i)] == date


def test_log_files_in_several_splits(spark, tmp_path):
    made = streams(9)
    for s, lines in enumerate(made):
        (tmp_path / f"{s}.log").write_text("".join(f"EVENTS|1|2024-01-0{1 + i // 200} 00:00:00|s|0|{line}\n" for i, line in enumerate(lines)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = readers.read_log_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 3
        got = logs.publish_stats(lines, block=F.col("block")).collect()
        assert {r.date: tuple(r[n] for n in NAMES) for r in got} == by_hand(made)
        late = readers.read_log_lines(spark, str(tmp_path), start="2024-01-02 00:00:00", end="2024-01-03 00:00:00", time_field=3)
        assert late.count() == 200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fields(spark):
    df = spark.createDataFrame([("a|b|c",), ("plain",), ("a|b",), ("  x  y ",)], "line string")
    got = df.select(logs.cut_field("line", 3), logs.word(F.col("line"), 2)).collect()
    assert [r[0] for r in got] == ["c", "plain", "", "  x  y "]
    assert [r[1] for r in got] == ["", "", "", "y"]


def test_each_part_of_a_log_is_written_by_several_tasks(spark, monkeypatch, tmp_path):
    from fleetledger.queries import registry

    expected = sorted(map(tuple, registry.QUERIES["publish_log_stats"](spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(registry, "_scratch", lambda fx, name: str(tmp_path / name))
    joined = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, registry.QUERIES["log_multi_file"](spark, "/root/testdata/sf0.001").collect())) == expected
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", joined)
    for part in range(3):
        files = sorted((tmp_path / "logs" / f"part={part}").glob("part-*"))
        firsts = [f.read_text().splitlines() for f in files]
        streams = [int(line.split("|")[3]) for lines in firsts for line in lines]
        assert sum(map(bool, firsts)) > 1 and streams == sorted(streams)
