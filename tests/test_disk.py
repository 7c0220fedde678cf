"""What jobs leave on disks: shuffles of written tables go, texts are not copied."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagedframes import fixtures as fx
from pagedframes.constants import BLOCK_PAGES, PAGE_SIZE
from pagedframes.replay import LandedTransport
from pagedframes.sources.transport import Paging
from pagedframes.storage import new_folder, shared_dir, write_and_reopen


def shuffled(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for folder in folders for p in Path(folder.getPath()).glob("*/shuffle_*.data")}


def test_a_written_table_leaves_no_shuffle(spark):
    before = shuffled(spark)
    rows = spark.range(50_000).withColumn("k", F.xxhash64("id") % 1000).repartition(4, "k")
    table = write_and_reopen(rows.groupBy("k").count(), new_folder(spark, "counted"))
    end = time.time() + 15
    while shuffled(spark) - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffled(spark) - before
    assert table.agg(F.sum("count")).first()[0] == 50_000
    # other queries keep theirs as the session says
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_texts_of_large_clusters_are_written_once(spark, monkeypatch):
    jaccard = pytest.importorskip("pagedframes.llm.jaccard")
    monkeypatch.setattr(jaccard, "TREE_DOCS", 4)
    words = [f"w{k}" for k in range(100)]
    # sixty near copies are a cluster of fifteen trees and more; two others are a cluster of one, one has no partner
    rows = [(k, " ".join([*words, f"only{k}"])) for k in range(60)]
    rows += [(k, " ".join([f"v{j}" for j in range(50)] + ["end"] * (k - 70))) for k in (70, 71)]
    rows += [(80, "nothing like it"), (81, None), (None, rows[0][1])]
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("unit-texts-*"))
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    want = dict.fromkeys(range(60), 0) | {70: 70, 71: 70, 80: 80, 81: 81, None: None}
    assert {r.doc_id: r.component_id for r in got} == want
    (made,) = set(folder.glob("unit-texts-*")) - before
    units = spark.read.parquet(str(made))
    # a document stands in its band of sizes and, as one of the upper, in the one below; never once a pair of trees
    assert {r["count"] for r in units.groupBy("doc_id", "root").count().collect()} == {1}
    assert units.select("doc_id").distinct().count() == 60
    assert units.select("root", "unit").distinct().count() > 4


def test_text_of_numbered_pages_moves_once_to_where_it_is_landed(spark):
    n = BLOCK_PAGES * PAGE_SIZE + 450
    long, short = F.struct(F.col("id").alias("k")), F.when(F.col("id") < 201, "short")
    # keys that come twice and a key that is null are numbered too
    rows = spark.range(n).select((F.col("id") / 2).cast("bigint").alias("key"), long.alias("record"), short.alias("short"))
    rows = rows.withColumn("key", F.when(F.col("key") != 7, F.col("key")))
    both = rows.withColumn("dataset", F.explode(F.array(F.lit("long"), "short")))
    pages = fx.numbered_pages(both, F.col("dataset"))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY") == 1
    folder = fx.land(pages, "landed", dealt=True)
    files = list(Path(folder.removeprefix("file:")).glob("block=*/*.parquet"))
    assert {f.parent.name for f in files} == {"block=0", "block=1"}
    # each block of a dataset is one file, in which its pages follow each other
    owners = spark.read.parquet(folder).select("dataset", "block", F.col("_metadata.file_name").alias("file")).distinct()
    assert owners.count() == owners.select("dataset", "block").distinct().count() == 3
    transport = LandedTransport(folder)
    for dataset, size in (("long", n), ("short", 201)):
        held = [json.loads(body) for _, body in transport.pages(dataset, 1, -(-size // PAGE_SIZE), Paging())]
        assert {page["$total"] for page in held} == {size}
        assert all(len(page["$items"]) == PAGE_SIZE for page in held[:-1])
        keys = [item["k"] for page in held for item in page["$items"]]
        assert sorted(keys) == list(range(size))
        numbers = [-1 if k // 2 == 7 else k // 2 for k in keys]
        assert numbers == sorted(numbers)
