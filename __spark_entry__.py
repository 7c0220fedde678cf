"""

Every query reads the given tables whole: a fixture encodes them as the page
bodies, records or descriptions that an API would send, the operator decodes
them, and the SQL states what must come out in terms of the tables alone.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HOME = os.path.dirname(os.path.abspath(__file__))
if _HOME not in sys.path:
    sys.path.insert(0, _HOME)
# Python workers that start elsewhere find the package too
if _HOME not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (_HOME, os.environ.get("PYTHONPATH"))))

from pagedframes import fixtures as fx  # noqa: E402
from pagedframes import operators as ops  # noqa: E402
from pagedframes import plans, sources, streaming  # noqa: E402
from pagedframes.reader import PagedAPI  # noqa: E402
from pagedframes.replay import LandedBodies, LandedTransport, land_bodies  # noqa: E402
from pagedframes.storage import new_folder  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# --- sources ---------------------------------------------------------------


def _flat_invoice(rows: DataFrame) -> DataFrame:
    """Flattened invoices with their arrays spelled out, so that any engine can compare them."""
    flat = ops.flatten(rows)

    def cents(amount: Column) -> Column:
        return F.floor(amount * 100).cast("string")

    def text(array: str, *fields: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(array, lambda e: F.concat_ws(":", *[f(e) for f in fields])), "|")

    line = [lambda e: e["part"], lambda e: e["line"].cast("string"), *[(lambda e, n=n: cents(e[n])) for n in ("quantity", "price", "discount")]]
    return flat.select(
        *[c for c in flat.columns if c not in ("tax_breakdown", "tags", "audit_steps", "invoice_lines")],
        text("tax_breakdown", lambda e: e["label"], lambda e: cents(e["amount"])).alias("tax_text"),
        F.array_join("tags", "|").alias("tag_text"),
        text("audit_steps", lambda e: e["at"], lambda e: e["n"].cast("string")).alias("step_text"),
        text("invoice_lines", *line).alias("line_text"),
    )


def read_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.land(fx.invoice_pages(spark, sf_dir), "invoice-pages")
    sources.register_transport(spark, LandedTransport(folder, {"/invoices": "invoice"}), "invoice_api")
    pages = spark.read.format("invoice_api").option("endpoint", "/invoices").load()
    return _flat_invoice(sources.unnest_typed(pages, fx.INVOICE))


def _description() -> str:
    return fx.description().replace("@SEG@", "Sales").replace("@ID@", "0").replace("@NATION@", "0")


def read_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By name: all invoices with all their lines, in the schema that the description declares."""
    folder = fx.land(fx.invoice_pages(spark, sf_dir), "invoice-pages")
    transport = LandedTransport(folder, {"/invoices?from_date=1990-01-01": "invoice"})
    return _flat_invoice(PagedAPI(spark, _description(), transport, "invoices").read("SalesInvoice", {"from_date": "1990-01-01"}))


def read_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body that is no page: all nations, in one array."""
    nations = fx.table(spark, sf_dir, "nation").join(fx.table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    region = F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("group"))
    bodies = nations.agg(F.to_json(F.sort_array(F.collect_list(region))).alias("body"))
    folder = new_folder(spark, "bodies")
    land_bodies(bodies.select(F.lit("/regions").alias("url"), "body"), folder)
    return ops.flatten(PagedAPI(spark, _description(), LandedBodies(folder), "single").read("Region"))


def read_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all kinds, each kind a dataset with pages of its own, in one read."""
    events = fx.event_records(spark, sf_dir)
    folder = fx.land(fx.numbered_pages(events, F.col("record.kind")), "fleet-pages", dealt=True)
    datasets = fx.table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset")).distinct()
    fleet = datasets.withColumn("endpoint", F.concat(F.lit("/events/"), F.col("dataset")))
    names = {row["endpoint"]: row["dataset"] for row in fleet.collect()}
    pages = sources.read_fleet(fleet, LandedTransport(folder, names))
    return ops.flatten(sources.unnest_typed(pages, fx.EVENT))


def read_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contacts that orders name, one request for each different key."""
    records = fx.items_of(fx.contact_records(spark, sf_dir))
    folder = new_folder(spark, "bodies")
    land_bodies(records.select(F.concat(F.lit("/contacts/"), F.col("key")).alias("url"), F.col("item").alias("body")), folder)
    keys = fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("key"))
    strange = fx.table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"))
    found = sources.fetch_keys(keys.unionByName(strange), "/contacts/{key}", LandedBodies(folder))
    rows = found.select("key", F.from_json("body", fx.CONTACT).alias("contact"))
    return rows.select("key", F.col("contact.name").alias("name"), F.col("contact.balance").alias("balance"))


def read_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset without records: the first page of contacts of no nation, in declared columns."""
    none = fx.numbered_pages(fx.contact_records(spark, sf_dir), F.lit("contact")).filter("page = 1")
    none = none.withColumn("body", F.lit('{"$total":0,"$items":[]}'))
    api = PagedAPI(spark, _description(), LandedTransport(fx.land(none, "empty-pages"), {"/contacts": "contact"}), "empty")
    return api.read("Contact").unionByName(api.empty("Contact")).select("id", "name", "balance")


def read_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.land(fx.contact_pages(spark, sf_dir), "contact-pages")
    api = PagedAPI(spark, _description(), LandedTransport(folder, {"/contacts": "contact"}), "contact_api")
    return api.read("Contact", {"page": 7}, columns=["id", "name", "balance"])


def unnest_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = sources.unnest(fx.contact_pages(spark, sf_dir))
    # the text itself is engine-specific in how it writes numbers, so fields are taken from it
    return items.select(
        "dataset",
        "page",
        "total",
        "pos",
        F.get_json_object("item", "$.id").cast("bigint").alias("id"),
        F.get_json_object("item", "$.name").alias("name"),
        F.get_json_object("item", "$.segment").alias("segment"),
    )


def read_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = fx.items_of(fx.contact_records(spark, sf_dir)).select(F.col("item").alias("body"))
    return ops.typed_rows(sources.read_object(bodies), fx.CONTACT)


def read_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.contact_pages(spark, sf_dir)
    bodies = pages.select("page", F.get_json_object("body", "$.$items").alias("body"))
    return ops.typed_rows(sources.read_array(bodies), fx.CONTACT)


def _invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.typed_rows(fx.items_of(fx.invoice_records(spark, sf_dir)).select("item"), fx.INVOICE)


def read_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = fx.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"))
    found = ops.read_by_keys(_invoices(spark, sf_dir), keys)
    return found.select("id", "date", "total", F.col("contact.name").alias("contact_name"))


def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    contacts = ops.typed_rows(fx.items_of(fx.contact_records(spark, sf_dir)), fx.CONTACT)
    keys = fx.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("id"))
    return ops.unmatched_keys(contacts, keys)


def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = (
        fx.table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("dataset"))
        .agg(F.count("*").alias("total"))
        .withColumn("params", F.create_map(F.lit("kind"), F.concat(F.col("dataset"), F.lit(" & all"))))
    )
    return plans.page_plan(totals)


def decode_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = sources.decode_bodies(fx.raw_bodies(spark, sf_dir))
    return decoded.select("kind", "body_id", F.md5("text").alias("digest"), F.length("text").alias("chars"))


def csv_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.csv_rows(fx.csv_bodies(spark, sf_dir), fx.PRODUCT)


# --- projection, typing, validation ----------------------------------------


def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bodies to records, typed columns and plain columns: the whole way."""
    return _flat_invoice(sources.unnest_typed(fx.invoice_pages(spark, sf_dir), fx.INVOICE))


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _invoices(spark, sf_dir)
    contact = F.col("contact")
    return rows.select(
        "id",
        "number",
        "total",
        "status",
        contact["id"].alias("contact_id"),
        contact["region"]["group"]["name"].alias("group_name"),
        F.col("audit")["paid"].alias("paid"),
        F.size("invoice_lines").alias("lines"),
    )


def infer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.infer_rows(fx.items_of(fx.event_records(spark, sf_dir)))
    return ops.flatten(rows).select("id", "at", "user", "kind", "value", "props_k")


def flatten_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = plans.flat_fields(plans.field_paths(fx.descriptions(spark, sf_dir)))
    return flat.drop("pos")


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.validate(fx.faulty_invoice_items(spark, sf_dir), fx.INVOICE)


def field_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.field_problems(fx.faulty_invoice_items(spark, sf_dir), fx.INVOICE)
    return found.select("key", "field", "problem")


def page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.page_audit(fx.faulty_invoice_pages(spark, sf_dir))


def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.missing_pages(fx.faulty_invoice_pages(spark, sf_dir))


def repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.repeated_pages(fx.faulty_invoice_pages(spark, sf_dir))


def body_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.body_rejects(fx.broken_bodies(spark, sf_dir)).select("page", "reason")


# --- parameters ------------------------------------------------------------


def read_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter on the typed source: the server, which keeps a list for each status, sends open invoices only."""
    since, status = {"from_date": "1990-01-01"}, F.col("record.status")
    everything = F.lit("/invoices?from_date=1990-01-01")
    lists = F.explode(F.array(everything, F.concat(everything, F.lit("&status="), status))).alias("list")
    records = fx.invoice_records(spark, sf_dir).select("key", "record", lists)
    folder = fx.land(fx.numbered_pages(records, F.col("list")), "by-status", dealt=True)
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        api = PagedAPI(spark, _description(), LandedTransport(folder), "filtered")
        rows = api.records("SalesInvoice", since, equal=["status"]).filter("status = 'O'").select("id", "status", "date", "total")
        # planned here, while filters are pushed down
        rows._jdf.queryExecution().executedPlan()
        return rows
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def missing_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.missing_params(fx.requests(spark, sf_dir), plans.endpoints(fx.descriptions(spark, sf_dir)))


def param_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.param_problems(fx.requests(spark, sf_dir), plans.endpoints(fx.descriptions(spark, sf_dir)))


def enum_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.enum_violations(fx.requests(spark, sf_dir), plans.endpoints(fx.descriptions(spark, sf_dir)))


def request_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.request_query(fx.requests(spark, sf_dir)).select("request_id", "endpoint", "query")


def url_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.url_params(fx.table(spark, sf_dir, "pages").select("page_id", "url"))


def url_param_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = ops.url_param_values(fx.table(spark, sf_dir, "pages").select("page_id", "url"))
    return grouped.select("page_id", "key", F.size("values").alias("n"), F.array_join("values", "|").alias("values"))


# --- catalogue -------------------------------------------------------------


def _endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.endpoints(fx.descriptions(spark, sf_dir))


_ENDPOINT = ["spec_id", "endpoint", "method", "schema_name", "schema_type"]


def spec_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _endpoints(spark, sf_dir).select(*_ENDPOINT)


def spec_read_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.read_paths(_endpoints(spark, sf_dir)).select(*_ENDPOINT)


def spec_write_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.write_paths(_endpoints(spark, sf_dir)).select(*_ENDPOINT)


def spec_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = plans.query_params(_endpoints(spark, sf_dir))
    return params.withColumn("enum", F.array_join("enum", "|"))


def spec_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.datasets(_endpoints(spark, sf_dir))


def dataset_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.dataset_endpoint(_endpoints(spark, sf_dir)).drop("params")


def spec_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.fields(fx.descriptions(spark, sf_dir))


def spec_field_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = plans.field_paths(fx.descriptions(spark, sf_dir))
    return paths.select("spec_id", "schema_name", F.array_join("path", ".").alias("path"), "type", "nullable", "problem")


def spec_base_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.base_url(fx.descriptions(spark, sf_dir))


# --- streaming -------------------------------------------------------------


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.land(fx.event_pages(spark, sf_dir), "event-pages")
    landed = streaming.drain(streaming.stream_landed(spark, folder))
    return landed.select("dataset", "page", F.get_json_object("body", "$.$total").cast("bigint").alias("total"))


def stream_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.land(fx.event_pages(spark, sf_dir), "event-pages")
    rows = streaming.drain(streaming.stream_items(streaming.stream_landed(spark, folder), fx.EVENT))
    return ops.flatten(rows)


def stream_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fx.land(fx.event_pages(spark, sf_dir), "event-pages")
    sources.register_transport(spark, LandedTransport(folder, {"/events": "event"}), "event_api")
    pages = streaming.stream_api(spark, "/events", "event_api", pages_per_batch=2_000)
    rows = streaming.drain(streaming.stream_items(pages, fx.EVENT))
    return ops.flatten(rows)


_QUERIES: list[Query] = [
    read_paged,
    read_dataset,
    read_invoices,
    read_single,
    read_fleet,
    read_keyed,
    read_empty,
    unnest_envelope,
    read_object,
    read_array,
    read_by_key,
    unmatched_keys,
    page_plan,
    decode_bodies,
    csv_bodies,
    flatten,
    typed_rows,
    infer_rows,
    flatten_schema,
    validate,
    field_problems,
    page_audit,
    missing_pages,
    repeated_pages,
    body_rejects,
    read_filtered,
    missing_params,
    param_problems,
    enum_violations,
    request_query,
    url_params,
    url_param_values,
    spec_endpoints,
    spec_read_paths,
    spec_write_paths,
    spec_params,
    spec_datasets,
    dataset_endpoint,
    spec_fields,
    spec_field_paths,
    spec_base_url,
    stream_pages,
    stream_items,
    stream_api,
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: page bodies of nested invoices to flat typed rows."""
    return flatten(spark, "/root/testdata/sf0.001")


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the corpus operators, where they are installed."""
    try:
        found = importlib.import_module("pagedframes.llm.queries")
        pipeline = importlib.import_module("corpus_pipeline")
    except ModuleNotFoundError as error:
        if error.name not in ("pagedframes.llm", "pagedframes.llm.queries", "corpus_pipeline"):
            raise
        return {}, {}
    sql = {"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {}
    return {**found.QUERIES, "pipeline": pipeline.run}, {**found.ORACLE, **sql}


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES} | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE

    return dict(ORACLE) | _corpus()[1]
