"""Inputs for tests and benchmarks, made by Spark from the given tables.

The tables hold plain rows; a paged API would send the same rows as JSON
records in page bodies. The encoders below produce those bodies, so what the
operators decode can be compared with the tables themselves.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes.constants import PAGE_SIZE
from pagedframes.sources.landed import block_of, land_pages
from pagedframes.storage import new_folder, write_and_reopen


#: numbers that a series of invoices holds; a declared integer has 32 bits, so keys are text
SERIES = 2_000_000_000
#: rows that are numbered, or put on pages, by one task
RANGE = 100_000

_TEXT, _INT, _REAL, _FLAG = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in fields.items()])


_REGION = _struct(name=_TEXT, group=_struct(name=_TEXT))
_STEPS = T.ArrayType(_struct(at=_TEXT, n=_INT))

INVOICE = _struct(
    ("id",),
    id=_TEXT,
    number=_INT,
    date=_TEXT,
    total=_REAL,
    status=_TEXT,
    contact=_struct(("id",), id=_TEXT, name=_TEXT, balance=_REAL, region=_REGION),
    tax_breakdown=T.ArrayType(_struct(label=_TEXT, amount=_REAL)),
    tags=T.ArrayType(_TEXT),
    audit=_struct(by=_TEXT, paid=_FLAG, steps=_STEPS),
    invoice_lines=T.ArrayType(_struct(part=_TEXT, line=_INT, quantity=_REAL, price=_REAL, discount=_REAL)),
)
CONTACT = _struct(("id",), id=_TEXT, name=_TEXT, balance=_REAL, segment=_TEXT)
PRODUCT = _struct(id=_TEXT, name=_TEXT, brand=_TEXT, size=_INT, price=_REAL)
EVENT = _struct(("id",), id=_TEXT, at=_TEXT, user=_TEXT, kind=_TEXT, value=_REAL, props=_struct(k=_INT))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Sessions that encode small files in parallel set smaller splits, as the bench does."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- records ---------------------------------------------------------------


def _invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, lines``: the lines of each order, sorted as a whole since line numbers repeat."""
    line = F.struct(
        F.col("l_partkey").cast("string").alias("part"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
    )
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))


def invoice_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, record``: one invoice per order, with the lines of that order (some have none); nested as :data:`INVOICE`."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("nation", "region"))
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        # the lines lie by order already; a broadcast of them would leave the encoding to the splits of the orders' file
        .join(_invoice_lines(spark, sf_dir).hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    group = F.struct(F.col("r_name").alias("name"))
    contact = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.struct(F.col("n_name").alias("name"), group.alias("group")).alias("region"),
    )
    taxes = F.array(
        F.struct(F.lit("net").alias("label"), F.col("o_totalprice").alias("amount")),
        F.struct(F.lit("held").alias("label"), F.col("c_acctbal").alias("amount")),
    )
    step = F.struct(date.alias("at"), F.col("c_nationkey").alias("n"))
    audit = F.struct(
        F.col("c_mktsegment").alias("by"), (F.col("o_orderstatus") == "F").alias("paid"), F.array(step).alias("steps")
    )
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_orderkey") % SERIES).cast("int").alias("number"),
        date.alias("date"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("status"),
        contact.alias("contact"),
        taxes.alias("tax_breakdown"),
        F.array("o_orderpriority", "c_mktsegment").alias("tags"),
        audit.alias("audit"),
        F.coalesce("lines", F.array()).alias("invoice_lines"),
    )
    return joined.select(F.col("o_orderkey").alias("key"), record.alias("record"))


def contact_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), record.alias("record"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.col("user_id").cast("string").alias("user"),
        F.col("event_type").alias("kind"),
        F.col("value"),
        F.from_json("props", "k int").alias("props"),
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("key"), record.alias("record"))


def items_of(records: DataFrame) -> DataFrame:
    """``key, item``: records as JSON text."""
    return records.select("key", F.to_json("record").alias("item"))


# --- pages -----------------------------------------------------------------


def page_bodies(items: DataFrame, dataset: str, total: int, *more: Column) -> DataFrame:
    """``dataset, page, body`` with 200 items each, in key order, and ``more`` aggregates of each page.

    Keys are unique and dense from 0, so ``key div 200`` numbers the pages and
    a page never gathers more than 200 items.
    """
    page = F.expr(f"key div {PAGE_SIZE}") + 1
    held = F.transform(F.sort_array(F.collect_list(F.struct("key", "item"))), lambda e: e["item"])
    grouped = items.groupBy(page.alias("page")).agg(held.alias("items"), *more)
    body = F.concat(
        F.lit(f'{{"$total":{total},"$page":'),
        F.col("page").cast("string"),
        F.lit(f',"$itemsPerPage":{PAGE_SIZE},"$items":['),
        F.array_join("items", ","),
        F.lit("]}"),
    )
    return grouped.select(F.lit(dataset).alias("dataset"), body.alias("body"), "*").drop("items")


def invoice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "orders").count()
    return page_bodies(items_of(invoice_records(spark, sf_dir)), "invoice", total)


def contact_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "customer").count()
    return page_bodies(items_of(contact_records(spark, sf_dir)), "contact", total)


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "events").count()
    return page_bodies(items_of(event_records(spark, sf_dir)), "event", total)


def numbered_pages(rows: DataFrame, dataset: Column) -> DataFrame:
    """``dataset, page, body`` with 200 items each for every ``dataset`` of ``key, record`` rows, in key order.

    Rows are written in ranges of dataset and key, numbered in order. How many
    of a dataset lie before a range is a sum over ranges, so no task numbers a
    dataset by itself. The text is written before, since ranges take a look at all rows.
    The pages of a block lie in one partition, as a landing table wants them.
    """
    spark = rows.sparkSession
    named = rows.select(dataset.alias("dataset"), "key", F.to_json("record").alias("item")).filter("dataset IS NOT NULL")
    named = write_and_reopen(named, new_folder(spark, "named"))
    # as many parts as the rows need, whatever the session's number of them
    rows = named.count()
    parts = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), 10 * rows // RANGE + 1), rows // RANGE)
    # rows of one key are spread too
    ranged = named.repartitionByRange(parts, "dataset", "key", F.xxhash64("item")).sortWithinPartitions("dataset", "key")
    # the number of the range in the upper bits, that of the row below
    at = F.monotonically_increasing_id()
    numbered = ranged.select("dataset", "item", F.shiftright(at, 33).alias("range"), at.bitwiseAND((1 << 33) - 1).alias("at"))
    numbered = write_and_reopen(numbered, new_folder(spark, "numbered"))
    ranges = numbered.groupBy("dataset", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    named_once = Window.partitionBy("dataset")
    before = named_once.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.select(
        "dataset",
        "range",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(named_once).alias("total"),
    )
    at = F.col("at") + F.col("shift")
    # one row for each range and dataset, so the text stays where it is until it goes to its block
    items = numbered.join(F.broadcast(placed), ["dataset", "range"])
    items = items.select("dataset", "total", at.alias("at"), "item").withColumn("page", F.expr(f"at div {PAGE_SIZE}") + 1)
    items = items.withColumn("block", block_of("page")).repartition(parts, "dataset", "block")
    held = F.transform(F.sort_array(F.collect_list(F.struct("at", "item"))), lambda e: e["item"])
    pages = items.groupBy("dataset", "total", "block", "page").agg(held.alias("items"))
    body = F.concat(
        F.lit('{"$total":'), F.col("total").cast("string"), F.lit(',"$items":['), F.array_join("items", ","), F.lit("]}")
    )
    return pages.select("dataset", "page", body.alias("body"))


def land(pages: DataFrame, label: str, dealt: bool = False) -> str:
    """Land pages in the shared folder and return where; ``dealt`` as :func:`numbered_pages` deals them."""
    folder = new_folder(pages.sparkSession, label)
    land_pages(pages, folder, dealt=dealt)
    return folder


def land_more(pages: DataFrame, folder: str) -> None:
    """Land more pages beside those that are there."""
    land_pages(pages, folder, mode="append")


# --- bodies that are not pages ---------------------------------------------


def csv_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``body_id, content``: parts as CSV, 200 records and a header each; each third name has a line end and quotes."""
    broken = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('"'))
    row = F.struct(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 3 == 0, broken).otherwise(F.col("p_name")).alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )
    lines = table(spark, sf_dir, "part").select(
        F.expr(f"p_partkey div {PAGE_SIZE}").alias("body_id"),
        F.struct("p_partkey", F.to_csv(row).alias("line")).alias("entry"),
    )
    held = F.transform(F.sort_array(F.collect_list("entry")), lambda e: e["line"])
    bodies = lines.groupBy("body_id").agg(held.alias("lines"))
    text = F.concat(F.lit(",".join(PRODUCT.fieldNames()) + "\n"), F.array_join("lines", "\n"), F.lit("\n"))
    return bodies.select("body_id", F.encode(text, "UTF-8").alias("content"))


def raw_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kind, body_id, content``: documents as text, web pages as HTML, event properties as JSON."""

    def of(name: str, kind: str, key: str, text: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(kind).alias("kind"), F.col(key).alias("body_id"), F.encode(F.col(text), "UTF-8").alias("content")
        )

    return (
        of("documents", "text", "doc_id", "text")
        .unionByName(of("pages", "html", "page_id", "html"))
        .unionByName(of("events", "json", "event_id", "props"))
    )


# --- faults ----------------------------------------------------------------


def faulty_invoice_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices with faults that follow from the order itself.

    Urgent orders lose their id, orders in process have a total and a tax
    amount that are no numbers, orders not specified carry a field ``extra``,
    orders of customers in debt have a number too large for 32 bits, and
    orders of low priority have no contact. Of the lines, those of line number
    3 have a quantity that is no number, and those with a discount over 0.09
    carry a field ``rebate``. Text follows the records of the orders that are
    finished and of high priority.
    """
    record = F.col("record")
    priority = record["tags"][0]
    in_process = record["status"] == "P"
    in_debt = record["contact"]["balance"] < 0

    def either(condition: Column, one: Column, other: Column) -> Column:
        # values of two types in one JSON field
        return F.when(condition, one.cast("variant")).otherwise(other.cast("variant"))

    taxes = F.array(
        F.struct(F.lit("net").alias("label"), either(in_process, F.lit("n/a"), record["total"]).alias("amount"))
    )

    def line(x: Column) -> Column:
        return F.struct(
            x["part"].alias("part"),
            x["line"].alias("line"),
            either(x["line"] == 3, F.lit("some"), x["quantity"]).alias("quantity"),
            x["price"].alias("price"),
            x["discount"].alias("discount"),
            F.when(x["discount"] > 0.09, F.lit(True)).alias("rebate"),
        )

    broken = F.struct(
        F.when(priority != "1-URGENT", record["id"]).alias("id"),
        F.when(in_debt, F.lit(5_000_000_000)).otherwise(record["number"]).alias("number"),
        record["date"].alias("date"),
        either(in_process, F.lit("n/a"), record["total"]).alias("total"),
        record["status"].alias("status"),
        F.when(priority != "5-LOW", record["contact"]).alias("contact"),
        taxes.alias("tax_breakdown"),
        record["tags"].alias("tags"),
        record["audit"].alias("audit"),
        F.transform(record["invoice_lines"], line).alias("invoice_lines"),
        F.when(priority == "4-NOT SPECIFIED", F.lit(1)).alias("extra"),
    )
    after = F.when((record["status"] == "F") & (priority == "2-HIGH"), F.lit(" {}")).otherwise("")
    return invoice_records(spark, sf_dir).select("key", F.concat(F.to_json(broken), after).alias("item"))


def faulty_invoice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice pages of which some are lost and some come twice.

    A page is lost when the order it starts with is in process and urgent, and
    comes twice when that order is finished and of low priority. Text follows
    the body of a page, so that it cannot be read, when that order is open and
    of high priority.
    """
    record = F.col("record")
    items = invoice_records(spark, sf_dir).select(
        "key", F.to_json(record).alias("item"), record["status"].alias("status"), record["tags"][0].alias("priority")
    )
    first = [F.min_by(name, "key").alias(name) for name in ("status", "priority")]
    pages = page_bodies(items, "invoice", table(spark, sf_dir, "orders").count(), *first)
    copies = (
        F.when((F.col("status") == "P") & (F.col("priority") == "1-URGENT"), 0)
        .when((F.col("status") == "F") & (F.col("priority") == "5-LOW"), 2)
        .otherwise(1)
    )
    after = F.when((F.col("status") == "O") & (F.col("priority") == "2-HIGH"), F.lit(" x")).otherwise("")
    body = F.concat("body", after).alias("body")
    return pages.select("dataset", "page", body, F.explode(F.array_repeat(F.lit(1), copies))).drop("col")


def broken_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page, body``: one body per order, good or broken in the way its priority tells.

    A good body promises more items than 32 bits can count; text follows it if the order is in process.
    """
    orders = table(spark, sf_dir, "orders")
    item = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total")))
    priority = F.col("o_orderpriority")
    after = F.when(F.col("o_orderstatus") == "P", " <html>").otherwise("")
    body = (
        F.when(priority == "1-URGENT", F.concat(F.lit('{"$total":5000000000,"$items":['), item, F.lit("]}"), after))
        .when(priority == "2-HIGH", F.concat(F.lit('{"$total":1,"$items":['), item))
        .when(priority == "3-MEDIUM", F.concat(F.lit('{"error":'), item, F.lit("}")))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("["), item, F.lit("]")))
    )
    return orders.select(F.col("o_orderkey").alias("page"), body.alias("body"))


# --- descriptions ----------------------------------------------------------

_PAGING = [
    {"in": "query", "name": "page", "type": "integer", "required": False},
    {"in": "query", "name": "items_per_page", "type": "integer", "required": False},
]


def _ref(name: str) -> dict:
    return {"$ref": f"#/definitions/{name}"}


def _operation(response: dict, parameters: list, code: str = "200") -> dict:
    return {
        "produces": ["application/json"],
        "parameters": parameters,
        # a later response that must not win, although its code sorts first
        "responses": {code: response, "100": {"schema": _ref("Problem")}},
    }


def description() -> str:
    """A description whose names hold the places ``@SEG@``, ``@ID@`` and ``@NATION@``."""
    status = {"in": "query", "name": "status", "type": "string", "enum": ["O", "F"], "required": False}
    since = {"in": "query", "name": "from_date", "type": "string", "required": True}
    legacy = {"in": "query", "name": "show_legacy", "type": "boolean"}
    key = {"in": "path", "name": "key", "type": "string", "required": True}
    text, whole = {"type": "string"}, {"type": "integer", "format": "int32"}
    real, flag = {"type": "number", "format": "double"}, {"type": "boolean"}
    steps = {"type": "array", "items": {"type": "object", "properties": {"at": text, "n": whole}}}
    return json.dumps(
        {
            "host": "api-@ID@.example.test",
            "basePath": "/v@NATION@",
            "schemes": ["https", "http"],
            "definitions": {
                "Problem": {"type": "object", "properties": {"message": text}},
                "Group": {"type": "object", "properties": {"name": text}},
                "Region": {"type": "object", "properties": {"name": text, "group": _ref("Group")}},
                "Contact": {
                    "type": "object",
                    "required": ["id"],
                    "properties": {
                        "id": text,
                        "name": text,
                        "balance": real,
                        "region": _ref("Region"),
                        "parent": _ref("Contact"),
                    },
                },
                "Tax": {"type": "object", "properties": {"label": text, "amount": real}},
                "Line": {
                    "type": "object",
                    "properties": {"part": text, "line": whole, "quantity": real, "price": real, "discount": real},
                },
                "@SEG@Invoice": {
                    "type": "object",
                    "required": ["id"],
                    "properties": {
                        "id": text,
                        "number": whole,
                        "date": {"type": "string", "format": "date"},
                        "total": real,
                        "status": text,
                        "contact": _ref("Contact"),
                        "tax_breakdown": {"type": "array", "items": _ref("Tax")},
                        "tags": {"type": "array", "items": text},
                        "audit": {"type": "object", "properties": {"by": text, "paid": flag, "steps": steps}},
                        "invoice_lines": {"type": "array", "items": _ref("Line")},
                    },
                },
            },
            "paths": {
                "/invoices": {
                    "x-pathtitle": "Invoices of @SEG@",
                    "get": _operation(
                        {"schema": {"type": "array", "items": _ref("@SEG@Invoice")}}, [*_PAGING, status, since]
                    ),
                    "post": _operation(
                        {"schema": _ref("@SEG@Invoice")}, [{"in": "body", "name": "invoice", "schema": {}}], "201"
                    ),
                },
                "/invoices/{key}": {
                    "get": _operation({"schema": _ref("@SEG@Invoice")}, [key, legacy]),
                    "put": _operation({"schema": _ref("@SEG@Invoice")}, [key]),
                    "delete": _operation({}, [key], "204"),
                },
                "/contacts": {"get": _operation({"schema": {"type": "array", "items": _ref("Contact")}}, _PAGING)},
                "/regions/@NATION@": {"get": _operation({"schema": {"type": "array", "items": _ref("Region")}}, [])},
                "/regions": {"get": _operation({"schema": {"type": "array", "items": _ref("Region")}}, [legacy])},
            },
        }
    )


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``spec_id, body``: one description per customer, named after the customer's segment, key and nation."""
    body = F.lit(description())
    # a few bytes of a customer make kilobytes of text, so the text is made, and parsed, by all cores
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    customers = customers.repartition(spark.sparkContext.defaultParallelism, "c_custkey")
    segment = F.initcap("c_mktsegment")
    for place, value in (("@SEG@", segment), ("@ID@", F.col("c_custkey")), ("@NATION@", F.col("c_nationkey"))):
        body = F.replace(body, F.lit(place), value.cast("string"))
    return customers.select(F.col("c_custkey").alias("spec_id"), body.alias("body"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``request_id, spec_id, endpoint, params``: each order asks its customer's API for invoices.

    Urgent orders leave out the required date, the status is the order's own
    (``P`` is no declared value), medium ones give a parameter that does not
    exist, and high ones ask for estimates, which no API has.
    """
    priority = F.col("o_orderpriority")

    def pair(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    pairs = F.array(
        pair("status", F.col("o_orderstatus")),
        F.when(priority != "1-URGENT", pair("from_date", F.date_format("o_orderdate", "yyyy-MM-dd"))),
        F.when(priority == "3-MEDIUM", pair("colour", F.lit("a b&c"))),
        pair("page", F.lit("7")),
    )
    given = F.map_from_entries(F.filter(pairs, lambda p: p.isNotNull()))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("spec_id"),
        F.when(priority == "2-HIGH", F.lit("/estimates")).otherwise(F.lit("/invoices")).alias("endpoint"),
        given.alias("params"),
    )
