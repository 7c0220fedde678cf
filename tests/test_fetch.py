"""Budgets, fleets, keys and typed records, with a server that writes down what it is asked."""

import json
import os
import re
import sys
import time
import zlib

import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes import Budget, FunctionTransport, PagedAPI, Paging, fixtures as fx
from pagedframes.operators import page_audit
from pagedframes.replay import BUCKETS, LandedBodies, land_bodies
from pagedframes.sources import fetch_keys, land_fleet, page_runs, read_fleet, register_records, register_transport, unnest
from pagedframes.sources.paged import PagedReader, PagedStreamReader
from pagedframes.sources.records import fit_of
from pagedframes.sources.transport import NotFound, Pace, Transport
from pagedframes.storage import new_folder
from pagedframes.streaming import drain, stream_api, stream_items

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Server:
    """Serves ``sizes`` (endpoint -> items) and appends each request, with its time, to a file that all tasks share."""

    def __init__(self, log, sizes, broken=(), page_size=200):
        self.log, self.sizes, self.broken, self.page_size = str(log), sizes, set(broken), page_size

    def __call__(self, url):
        handle = os.open(self.log, os.O_CREAT | os.O_APPEND | os.O_WRONLY)
        os.write(handle, f"{time.time()} {url}\n".encode())
        os.close(handle)
        endpoint, _, query = url.partition("?")
        page = int(re.search(r"[?&]page=(\d+)", url).group(1))
        if (endpoint, page) in self.broken:
            raise ConnectionError("down")
        assert f"items_per_page={self.page_size}" in query
        low, total = (page - 1) * self.page_size, self.sizes[endpoint]
        items = [{"id": f"{endpoint}:{k}"} for k in range(low, min(low + self.page_size, total))]
        return json.dumps({"$total": total, "$items": items})

    def asked(self):
        lines = open(self.log).read().splitlines() if os.path.exists(self.log) else []
        return [(float(line.split()[0]), line.split()[1]) for line in lines]

    def forget(self):
        open(self.log, "w").close()


def fleet(spark, sizes):
    return spark.createDataFrame([(e.strip("/"), e) for e in sizes], "dataset string, endpoint string")


def ids(pages):
    return sorted(json.loads(r["item"])["id"] for r in unnest(pages).collect())


def every(sizes):
    return sorted(f"{e}:{k}" for e, n in sizes.items() for k in range(n))


# --- budget -------------------------------------------------------------------


@pytest.mark.parametrize("per_second", [0.5, 1, 3, 7.9, 40])
@pytest.mark.parametrize("wanted", [1, 4, 1000])
def test_tasks_share_the_budget(per_second, wanted):
    budget = Budget(per_second)
    tasks = budget.tasks(wanted)
    # requests of one task in any second, a request at its very start included
    each = 1 / budget.interval(tasks)
    assert 1 <= tasks <= wanted
    assert tasks * (round(each) if each >= 1 else each) <= max(per_second, 1e-9)


def test_pace_waits_before_the_first_request_too():
    start, pace = time.monotonic(), Pace(0.05)
    times = []
    for _ in range(4):
        pace()
        times.append(time.monotonic() - start)
    assert times[0] >= 0.05 and all(b - a >= 0.049 for a, b in zip(times, times[1:]))


def test_a_read_never_goes_above_its_budget(spark, tmp_path):
    server = Server(tmp_path / "log", {"/x": 200 * 40})
    register_transport(spark, FunctionTransport(server), "budget")
    options = {"endpoint": "/x", "pagesPerPartition": "3", "requestsPerSecond": "12"}
    assert len(PagedReader(FunctionTransport(server), options).partitions()) <= 12
    server.forget()
    assert unnest(spark.read.format("budget").options(**options).load()).count() == 8000
    times = sorted(t for t, _ in server.asked())
    assert len(times) >= 41  # the total, and each page once
    # of a budget of 12, any 13 requests in a row take over a second (but for the clock's grain)
    tasks = times[-40:]
    assert min(b - a for a, b in zip(tasks, tasks[12:])) > 0.9


# --- fleets -----------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [[1] * 30, [200 * 500, 0, 1, 201, 200 * 3], [200 * 100_000_000]])
def test_no_task_has_more_than_twice_the_mean(spark, sizes):
    totals = spark.createDataFrame([(f"d{k}", f"/d{k}", n) for k, n in enumerate(sizes)], "dataset string, endpoint string, total long")
    runs = page_runs(totals.filter("total < 1000000000"), 8)
    loads = {r["task"]: r["n"] for r in runs.groupBy("task").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n")).collect()}
    pages = sum(max(1, -(-n // 200)) for n in sizes if n < 1000000000)
    assert sum(loads.values()) == pages
    assert max(loads.values(), default=0) <= 2 * pages / 8
    covered = runs.select("dataset", F.explode(F.sequence("first", "last")).alias("page"))
    assert covered.distinct().count() == covered.count() == pages


def test_fleet(spark, tmp_path):
    sizes = {"/a": 1999, "/b": 0, "/c": 1, "/d": 400, "/e/f": 201}
    server = Server(tmp_path / "log", sizes)
    assert ids(read_fleet(fleet(spark, sizes), FunctionTransport(server), tasks=4)) == every(sizes)
    small = Server(tmp_path / "log", sizes, page_size=7)
    assert ids(read_fleet(fleet(spark, sizes), FunctionTransport(small), Paging(size=7))) == every(sizes)


def test_fleet_fails_with_a_page(spark, tmp_path):
    sizes = {"/a": 1999, "/b": 5}
    server = Server(tmp_path / "log", sizes, broken=[("/a", 3)])
    with pytest.raises(PySparkException, match="page 3 of a: ConnectionError: down"):
        read_fleet(fleet(spark, sizes), FunctionTransport(server)).collect()
    with pytest.raises(LookupError, match="no total: b"):
        read_fleet(fleet(spark, sizes), FunctionTransport(Server(tmp_path / "log", sizes, broken=[("/b", 1)])))


def test_a_re_run_asks_for_what_is_missing_only(spark, tmp_path):
    sizes = {"/a": 200 * 60, "/b": 400}
    broken = [("/a", 3), ("/a", 59), ("/b", 2)]
    server, folder = Server(tmp_path / "log", sizes, broken), new_folder(spark, "landed-fleet")
    with pytest.raises(LookupError, match="3 pages are missing"):
        land_fleet(fleet(spark, sizes), FunctionTransport(server), folder)
    landed = spark.read.parquet(folder)
    assert landed.count() == 59
    server.broken.clear()
    server.forget()
    pages = land_fleet(fleet(spark, sizes), FunctionTransport(server), folder)
    assert ids(pages) == every(sizes)
    assert all(r["complete"] for r in page_audit(pages).collect())
    again = [u for _, u in server.asked()]
    # first pages tell the totals; then only what was missing
    assert sorted(u for u in again if not u.endswith("&page=1")) == sorted(
        f"{e}?items_per_page=200&page={p}" for e, p in broken
    )
    server.forget()
    assert land_fleet(fleet(spark, sizes), FunctionTransport(server), folder).count() == 62
    assert len(server.asked()) == 2


# --- keys -------------------------------------------------------------------------


def record(log, url):
    with open(log, "a") as held:
        held.write(url + "\n")
    if url.startswith("/v/x"):
        raise NotFound(url)
    if url == "/v/down":
        raise ConnectionError("down")
    return json.dumps({"id": url})


def test_keys_are_fetched_once_each(spark, tmp_path):
    log = str(tmp_path / "log")
    given = ["a", "b", "b", "a/b", "x1", None, "b"] + ["hot"] * 500
    keys = spark.createDataFrame([(k,) for k in given], "key string").repartition(5)
    found = fetch_keys(keys, "/v/{key}", FunctionTransport(lambda url: record(log, url)))
    held = {r["key"]: r["body"] and json.loads(r["body"])["id"] for r in found.collect()}
    assert held == {"a": "/v/a", "b": "/v/b", "a/b": "/v/a%2Fb", "x1": None, None: None, "hot": "/v/hot"}
    assert sorted(open(log).read().split()) == ["/v/a", "/v/a%2Fb", "/v/b", "/v/hot", "/v/x1"]
    found.count()
    assert len(open(log).read().split()) == 5
    with pytest.raises(LookupError, match="down: ConnectionError"):
        fetch_keys(spark.createDataFrame([("down",)], "key string"), "/v/{key}", FunctionTransport(lambda url: record(log, url)))


def test_read_keys_by_name(spark):
    def get(url):
        if url == "/invoices/9":
            raise NotFound(url)
        return json.dumps({"id": url[-1], "number": 5, "invoice_lines": [{"part": "p", "line": 1}]})

    api = PagedAPI(spark, fx.description().replace("@SEG@", "Sales"), FunctionTransport(get), "keyed")
    rows, missing = api.read_keys("SalesInvoice", spark.createDataFrame([("1",), ("2",), ("9",)], "key string"))
    assert sorted((r["id"], r["invoice_lines"][0]["part"]) for r in rows.collect()) == [("1", "p"), ("2", "p")]
    assert [r["key"] for r in missing.collect()] == ["9"]
    empty = api.empty("SalesInvoice")
    assert empty.columns == fx.INVOICE.names and empty.count() == 0


# --- typed records -----------------------------------------------------------------


def invoices(log):
    rows = [{"id": str(k), "number": k if k % 7 else 5_000_000_000, "status": "OFP"[k % 3], "total": "bad" if k == 1 else k} for k in range(1200)]

    def get(url):
        with open(log, "a") as held:
            held.write(url + "\n")
        status = re.search(r"[?&]status=(\w)", url)
        page = int(re.search(r"[?&]page=(\d+)", url).group(1))
        kept = [r for r in rows if not status or r["status"] == status.group(1)]
        return json.dumps({"$total": len(kept), "$items": kept[(page - 1) * 200 : page * 200]})

    return get


def test_filters_reach_the_server(spark, tmp_path):
    log = str(tmp_path / "log")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        api = PagedAPI(spark, fx.description().replace("@SEG@", "Sales"), FunctionTransport(invoices(log)), "pushed_records")

        def asked(df):
            open(log, "w").close()
            rows = [tuple(r) for r in df.select("id", "number", "total").collect()]
            return sorted(rows, key=str), open(log).read().split()

        records = api.records("SalesInvoice", {"from_date": "2024-01-01"})
        everything, all_requests = asked(records)
        assert len(everything) == 1200
        want = [r for r in everything if int(r[0]) % 3 == 0]
        found, requests = asked(records.filter("status = 'O'"))
        assert found == want and len(requests) < len(all_requests) and all("status=O" in u for u in requests)
        # values fit as from_json makes them fit
        assert ("1", 1, None) in everything and ("7", None, 7.0) in everything
        # P is none of the values that the description declares: Spark filters alone
        found, requests = asked(records.filter("status = 'P'"))
        assert len(found) == 400 and not any("status" in u for u in requests)
        found, requests = asked(records.filter("status = 'O' AND number = 3"))
        assert found == [("3", 3, 3.0)] and all("status=O" in u and "number" not in u for u in requests)
        found, requests = asked(api.records("SalesInvoice", {"from_date": "x"}, equal=[]).filter("status = 'O'"))
        assert found == want and not any("status" in u for u in requests)
        with pytest.raises(ValueError, match="no field and free parameter"):
            api.records("SalesInvoice", {"from_date": "x"}, equal=["from_date"])
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_records_without_pushdown(spark, tmp_path):
    register_records(spark, FunctionTransport(invoices(str(tmp_path / "log"))), "plain_records")
    schema = T.StructType().add("id", "string").add("status", "string")
    rows = spark.read.format("plain_records").schema(schema).option("endpoint", "/i").load()
    assert rows.filter("status = 'F'").count() == 400 and rows.count() == 1200


def test_values_fit_as_in_from_json(spark):
    kind = T.StructType([T.StructField("v", t) for t in ()])
    kinds = [T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.ArrayType(T.IntegerType())]
    kinds.append(T.StructType().add("x", T.IntegerType()))
    values = [None, "a", "5", 5, -1, 2**31, 2**63, 1.5, True, [], [1, 2], ["x", 1], {}, {"x": 3}, {"x": "y"}, "NaN", "é"]
    for t in kinds:
        kind = T.StructType().add("v", t)
        texts = [(k, json.dumps({"v": v})) for k, v in enumerate(values)]
        frame = spark.createDataFrame(texts, "k int, item string").select("k", F.from_json("item", kind).alias("r"))
        for k, row in frame.collect():
            want = row.asDict(recursive=True)["v"]
            assert str(fit_of(t)(values[k])) == str(want), (t, values[k])


# --- the stream ---------------------------------------------------------------------


def test_stream_takes_a_backlog_in_batches(spark, tmp_path):
    server = Server(tmp_path / "log", {"/x": 200 * 10 + 50})
    reader = PagedStreamReader(FunctionTransport(server), {"endpoint": "/x", "maxPagesPerBatch": "4"})
    assert reader.initialOffset() == {"items": 0}
    ends, start = [], {"items": 0}
    while True:
        end = reader.latestOffset()
        if end["items"] == start["items"]:
            break
        reader.partitions(start, end)
        ends.append(end)
        start = end
    assert ends == [{"items": 800, "total": 2050}, {"items": 1600, "total": 2050}, {"items": 2050}]


def test_stream_in_batches_loses_and_repeats_nothing(spark, tmp_path):
    def pull(total, name):
        server = Server(tmp_path / "log", {"/x": total})
        register_transport(spark, FunctionTransport(server), name)
        stream = stream_items(stream_api(spark, "/x", name, pages_per_batch=3)).select("page", "item")
        return [json.loads(r["item"])["id"] for r in drain(stream, target).collect()]

    target = new_folder(spark, "batched")
    assert sorted(pull(1500, "grow1")) == every({"/x": 1500})
    batches = [name for name in os.listdir(f"{target}-checkpoint/commits".removeprefix("file:")) if name.isdigit()]
    assert len(batches) == 3
    # a new query, a page that was half full, and a backlog of several batches again
    assert sorted(pull(3100, "grow2")) == every({"/x": 3100})
    assert sorted(pull(3100, "grow3")) == every({"/x": 3100})


class Shelves(Transport):
    """Tells in a file which places each task asked for, in order."""

    def __init__(self, told):
        self.told = told

    def place(self, url):
        return F.crc32(F.encode(url, "UTF-8"))

    def get(self, url):
        with open(f"{self.told}/{os.getpid()}-{TaskContext.get().partitionId()}", "a") as told:
            told.write(f"{zlib.crc32(url.encode())}\n")
        return url


def test_keys_are_asked_for_by_where_they_lie(spark, tmp_path):
    keys = spark.range(500).select(F.concat(F.lit("a b*~é/"), F.col("id")).alias("key"))
    found = fetch_keys(keys, "/x/{key}", Shelves(str(tmp_path)), tasks=4)
    assert found.count() == 500
    asked = sorted([int(place) for place in told.read_text().split()] for told in tmp_path.iterdir())
    assert len(asked) == 4
    # each task goes through a stretch of its own, in order
    assert [place for task in asked for place in task] == sorted(place for task in asked for place in task)
    assert min(map(len, asked)) > 60


def test_landed_bodies_are_read_a_row_group_at_a_time(spark, tmp_path):
    folder = str(tmp_path / "bodies")
    # of one bucket all
    ids = [i for i in range(30_000) if zlib.crc32(f"/x/{i}".encode()) < (1 << 32) // BUCKETS]
    body = F.expr("concat(lpad(id, 8, '0'), array_join(transform(sequence(1, 300), k -> sha2(concat(id, ' ', k), 256)), 'ü'))")
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    land_bodies(rows.select(F.concat(F.lit("/x/"), F.col("id")).alias("url"), body.alias("body")), folder)
    transport = LandedBodies(folder)
    for i in (ids[0], ids[5], ids[-1], ids[5]):
        assert transport.get(f"/x/{i}")[:8] == f"{i:08}"
        assert len(transport.held[2]) < len(ids) / 2
    assert [int(transport.get(f"/x/{i}")[:8]) for i in ids] == ids
    for url in (f"/x/{ids[0]}?", "/y"):
        with pytest.raises(NotFound):
            transport.get(url)
