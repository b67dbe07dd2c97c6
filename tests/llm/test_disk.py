"""What a finished pass leaves on disk, and what its plan would send to every executor."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import minwise, simhash, substrings


def _shuffled(spark) -> int:
    """Bytes of shuffle files that this session's disk store has."""
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    size = 0
    while held.hasNext():
        file = held.next()
        size += file.length() if file.getName().startswith("shuffle_") else 0
    return size


def test_the_first_pass_gives_back_its_disk(spark, tmp_path):
    words = [" ".join(f"w{(i * 7919 + k * (i % 5 + 1)) % 9973}" for k in range(300)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    before, shared = _shuffled(spark) + 10_000, Path(spark.conf.get("spark.checkpoint.dir"))  # with room for a count
    units = set(shared.glob("units-*"))
    result = substrings.without_repeats(docs)  # the first pass has run, the second has not
    for _ in range(40):
        if _shuffled(spark) <= before:
            break
        time.sleep(0.25)
    assert _shuffled(spark) <= before, (_shuffled(spark), before)
    assert set(shared.glob("units-*")) == units
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert result.count() == 400


@pytest.mark.parametrize("links", ["simhash", "minwise"])
def test_rows_made_for_every_kind_of_key_are_not_broadcast(spark, links):
    """Spark sizes what mapInArrow gives at what it gets: a table under the limit becomes one far above it."""
    if links == "simhash":
        joined = simhash.links(spark.range(4000).select(F.xxhash64("id").alias("fingerprint")))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    else:
        prints = spark.range(40).select(F.xxhash64("id").alias("node"), F.expr(f"CAST(repeat('ab', {minwise.SLOTS // 2}) AS binary)").alias("print"))
        plans, write = [], minwise.staged
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(minwise, "staged", lambda df, purpose: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, purpose))
            joined = minwise.links(prints)
        plan = plans[0]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    joined.count()
