"""Many requests as one Spark job: the pages of a fleet of datasets, and single records by key.

What to ask for is a table; it is dealt evenly over tasks, which fetch at the
pace that their budget leaves them. A request that fails is a row, not the end
of the job, so what others brought is kept, and a re-run asks for the rest.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagedframes.sources.landed import land_pages, pages_from_table
from pagedframes.sources.paged import travel
from pagedframes.sources.transport import Budget, Pace, Paging, Transport, is_absent
from pagedframes.storage import new_folder, write_and_reopen

#: pages of a run, which one task asks for in order
RUN = 50
#: runs that are dealt over the cluster together
_BLOCK = 10_000
_PAGES = "dataset string, page bigint, body string, error string"
_BODIES = "key string, body string, error string"
_TEXT = pa.string()
_PAGED = pa.schema([("dataset", _TEXT), ("page", pa.int64()), ("body", _TEXT), ("error", _TEXT)])
_KEYED = pa.schema([("key", _TEXT), ("body", _TEXT), ("error", _TEXT)])


def _tasks(spark: SparkSession, tasks: int | None, budget: Budget | None) -> int:
    wanted = tasks or spark.sparkContext.defaultParallelism
    return budget.tasks(wanted) if budget else wanted


def _at_pace(transport: Transport, budget: Budget | None, tasks: int) -> Callable[[], Transport]:
    """What a task calls for its own transport; all attempts and tasks together keep the budget."""
    if budget is None:
        return lambda: transport
    seconds = budget.interval(tasks)
    return lambda: transport.paced(Pace(seconds))


def page_runs(totals: DataFrame, tasks: int, page_size: int = Paging.size) -> DataFrame:
    """``task, dataset, endpoint, first, last``: the pages of all datasets in runs, dealt over ``tasks``.

    ``totals`` holds ``dataset, endpoint, total``, a row for each dataset. Pages
    are numbered through, by a running sum over datasets (one row each), and cut
    into runs of equal length, which tasks take in turn; so no task has more
    than twice the mean, however unequal the datasets are. An empty dataset
    still has its first page.
    """
    spark = totals.sparkSession
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / page_size)).cast("bigint")
    counted = totals.select("dataset", "endpoint", pages.alias("n"))
    before = Window.orderBy("dataset", "endpoint").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    whole = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    run = max(1, min(RUN, whole // max(tasks, 1)))
    low, high = F.floor(F.col("start") / run), F.floor((F.col("start") + F.col("n") - 1) / run)
    blocks = placed.select(
        "*", low.alias("low"), high.alias("high"), F.explode(F.sequence(F.floor(low / _BLOCK), F.floor(high / _BLOCK))).alias("block")
    )
    spread = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "dataset", "endpoint", "block")
    inside = F.sequence(
        F.greatest(F.col("low"), F.col("block") * _BLOCK), F.least(F.col("high"), F.col("block") * _BLOCK + _BLOCK - 1)
    )
    runs = spread.select("dataset", "endpoint", "start", "n", F.explode(inside).alias("k"))
    return runs.select(
        (F.col("k") % tasks).cast("int").alias("task"),
        "dataset",
        "endpoint",
        (F.greatest(F.col("k") * run, F.col("start")) - F.col("start") + 1).alias("first"),
        (F.least((F.col("k") + 1) * run, F.col("start") + F.col("n")) - F.col("start")).alias("last"),
    )


def _missing(page: int) -> str:
    raise LookupError(f"page {page} is missing")


def _fetch_pages(batches: Iterator[pa.RecordBatch], transport: Callable[[], Transport], paging: Paging) -> Iterator[pa.RecordBatch]:
    own = transport()
    for batch in batches:
        for row in batch.to_pylist():
            for page in row["pages"]:
                body = error = None
                try:
                    ((_, body),) = list(own.pages(row["endpoint"], page, page, paging)) or [(page, _missing(page))]
                except Exception as problem:  # told as a row; whoever reads it decides
                    error = f"{type(problem).__name__}: {problem}"
                found = {"dataset": row["dataset"], "page": page, "body": body, "error": error}
                yield pa.RecordBatch.from_pylist([found], _PAGED)


def _asked(runs: DataFrame, tasks: int, transport: Transport, paging: Paging, budget: Budget | None) -> DataFrame:
    """``dataset, page, body, error`` for ``task, dataset, endpoint, pages``: each task number is one task."""
    travel()
    own = partial(_fetch_pages, transport=_at_pace(transport, budget, tasks), paging=paging)
    dealt = runs.repartitionById(tasks, "task").select("dataset", "endpoint", "pages")
    return dealt.mapInArrow(lambda batches: own(batches), _PAGES)


def totals_of(
    datasets: DataFrame, transport: Transport, paging: Paging | None = None, budget: Budget | None = None, tasks: int | None = None
) -> DataFrame:
    """``dataset, endpoint, total`` for ``dataset, endpoint``, from the first page of each; asked for once, and kept."""
    spark, paging = datasets.sparkSession, paging or Paging()
    n = _tasks(spark, tasks, budget)
    task = F.pmod(F.xxhash64("dataset", "endpoint"), F.lit(n)).cast("int").alias("task")
    one = datasets.select(task, "dataset", "endpoint", F.array(F.lit(1).cast("bigint")).alias("pages"))
    firsts = write_and_reopen(_asked(one, n, transport, paging, budget), new_folder(spark, "first-pages"))
    total = F.get_json_object("body", "$.$total").try_cast("bigint")
    found = firsts.select("dataset", "error", total.alias("total"))
    bad = found.filter("error IS NOT NULL OR total IS NULL").limit(5).collect()
    if bad:
        raise LookupError("no total: " + "; ".join(f"{r['dataset']} ({r['error'] or 'not told'})" for r in bad))
    return datasets.select("dataset", "endpoint").join(found.drop("error"), "dataset")


def read_fleet(
    datasets: DataFrame, transport: Transport, paging: Paging | None = None, budget: Budget | None = None, tasks: int | None = None
) -> DataFrame:
    """``dataset, page, body`` of all pages of all ``datasets`` (``dataset, endpoint``) in one read.

    A page that cannot be had fails the read. Nothing is kept: land what is to outlive a failure.
    """
    spark, paging = datasets.sparkSession, paging or Paging()
    n = _tasks(spark, tasks, budget)
    runs = page_runs(totals_of(datasets, transport, paging, budget, tasks), n, paging.size)
    runs = runs.select("task", "dataset", "endpoint", F.sequence("first", "last").alias("pages"))
    pages = _asked(runs, n, transport, paging, budget)
    told = F.concat(F.lit("page "), F.col("page"), F.lit(" of "), F.col("dataset"), F.lit(": "), F.col("error"))
    body = F.when(F.col("error").isNull(), F.col("body")).otherwise(F.raise_error(told))
    return pages.select("dataset", "page", body.alias("body"))


def land_fleet(
    datasets: DataFrame,
    transport: Transport,
    path: str,
    paging: Paging | None = None,
    budget: Budget | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Land the pages of all ``datasets`` in ``path`` and return them; what is landed already is not asked for again.

    The landing table is its own manifest. Pages that could not be had raise an
    error when all others are landed, so the next call asks for these alone. A
    landed page stays as it is: a dataset that gains items is for ``stream_api``.
    """
    spark, paging = datasets.sparkSession, paging or Paging()
    n = _tasks(spark, tasks, budget)
    runs = page_runs(totals_of(datasets, transport, paging, budget, tasks), n, paging.size)
    wanted = runs.select("task", "dataset", "endpoint", F.explode(F.sequence("first", "last")).alias("page"))
    if _is_there(spark, path):
        wanted = wanted.join(spark.read.parquet(path).select("dataset", "page").distinct(), ["dataset", "page"], "left_anti")
    rest = wanted.groupBy("task", "dataset", "endpoint", F.floor(F.col("page") / RUN).alias("run"))
    rest = rest.agg(F.sort_array(F.collect_list("page")).alias("pages"))
    fetched = write_and_reopen(_asked(rest, n, transport, paging, budget), new_folder(spark, "fetched"))
    land_pages(fetched.filter("error IS NULL"), path, mode="append")
    bad = fetched.filter("error IS NOT NULL")
    told = bad.limit(5).collect()
    if told:
        raise LookupError(f"{bad.count()} pages are missing: " + "; ".join(f"{r['dataset']} {r['page']}: {r['error']}" for r in told))
    return pages_from_table(spark, path)


def _is_there(spark: SparkSession, path: str) -> bool:
    try:
        return len(spark.read.parquet(path).columns) > 0
    except AnalysisException:  # no such path, or nothing in it yet
        return False


# --- by key ----------------------------------------------------------------


def _fetch_keys(batches: Iterator[pa.RecordBatch], transport: Callable[[], Transport], endpoint: str) -> Iterator[pa.RecordBatch]:
    own = transport()
    for batch in batches:
        rows = []
        for key in batch["key"].to_pylist():
            body = error = None
            try:
                body = None if key is None else own.fetch(endpoint.replace("{key}", urllib.parse.quote(key, safe="")))
            except Exception as problem:
                error = None if is_absent(problem) else f"{type(problem).__name__}: {problem}"
            rows.append({"key": key, "body": body, "error": error})
            if len(rows) == RUN:
                yield pa.RecordBatch.from_pylist(rows, _KEYED)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, _KEYED)


def _quoted(text: Column) -> Column:
    """As ``urllib.parse.quote`` with nothing safe."""
    encoded = F.url_encode(text)
    for ours, theirs in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(ours), F.lit(theirs))
    return encoded


def fetch_keys(
    keys: DataFrame,
    endpoint: str,
    transport: Transport,
    budget: Budget | None = None,
    tasks: int | None = None,
    column: str = "key",
) -> DataFrame:
    """``key, body`` for each different key of ``keys``, from the endpoint with ``{key}``; null for one that is not there.

    A null key is not asked for and has no body. Keys are dealt by hash, so a
    key that is given often is one request; if the transport knows where bodies
    lie, each task asks for a stretch of them in order. What was fetched is kept, since a
    second look must not be a second fetch; other failures fail the read after that.
    """
    if "{key}" not in endpoint:
        raise ValueError(f"{endpoint} is not read by key")
    spark = keys.sparkSession
    n = _tasks(spark, tasks, budget)
    travel()
    own = partial(_fetch_keys, transport=_at_pace(transport, budget, n), endpoint=endpoint)
    different = keys.select(F.col(f"`{column}`").cast("string").alias("key")).distinct()
    place = transport.place(F.replace(F.lit(endpoint), F.lit("{key}"), _quoted(F.col("key"))))
    if place is None:
        dealt = different.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")).repartitionById(n, "task")
    else:
        placed = different.withColumn("place", F.coalesce(place, F.lit(0)))
        dealt = placed.withColumn("task", F.floor(F.col("place") * n / (1 << 32)).cast("int")).repartitionById(n, "task")
        dealt = dealt.sortWithinPartitions("place")
    dealt = dealt.select("key")
    fetched = write_and_reopen(dealt.mapInArrow(lambda batches: own(batches), _BODIES), new_folder(spark, "fetched-keys"))
    told = fetched.filter("error IS NOT NULL").limit(5).collect()
    if told:
        raise LookupError("; ".join(f"{r['key']}: {r['error']}" for r in told))
    return fetched.drop("error")
