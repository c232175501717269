"""The complete load: source files to bronze, silver, dimensions and the order fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lodestar.names import column
from lodestar.operators.lookup import Lookup, build_fact
from lodestar.operators.merge import upsert, upsert_pruned
from lodestar.operators.ranking import dedup_latest
from lodestar.operators.scd1 import scd1_upsert
from lodestar.operators.segments import same
from lodestar.plans import clean
from lodestar.scratch import discard, freed_shuffles, materialise
from lodestar.sources import tables
from lodestar.sources.ingest import (
    ALL_AGES,
    BATCH_ID,
    FILE_TIME,
    LINEAGE,
    SOURCE_FILE,
    Dataset,
    ingest_all,
    ingested_schema,
    remembered_schema,
)
from lodestar.streaming.flows import (
    apply_changes_stream,
    for_each_batch,
    staged,
    start_append,
    table_stream,
)

DATASETS = [Dataset("orders"), Dataset("products"), Dataset("customers"), Dataset("regions")]

CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": clean.clean_customers,
    "orders": clean.clean_orders,
    "products": clean.clean_products,
    "regions": clean.clean_regions,
}

# The order of arrival, most significant first.
LINEAGE_ORDER = (BATCH_ID, FILE_TIME, SOURCE_FILE)

# The number of a source file within a batch.
ARRIVAL = "_arrival"

# The quality rules of the product dimension.
PRODUCT_RULES = {
    "rule1": "product_id IS NOT NULL",
    "rule2": "product_name IS NOT NULL",
}


@dataclass(frozen=True)
class Settings:
    """Where the tables live and how they are merged.

    A load reads the silver rows added since the last one and rewrites only the
    buckets they touch. With ``incremental=False`` it reads all silver customers
    and orders again; the result is the same, except that customers not
    delivered again keep their update time when the load is incremental. The
    greatest ``latest`` columns win in either case: those that are data (not
    lineage) stay in dimension and fact, and an older row changes nothing.

    ``as_of_order_date`` points each order at the product version that was
    valid at its date, by the version's ``DimProductKey``; otherwise orders
    carry the product's business key.

    With ``sliced`` customers and orders are tables in slices, of which a load
    rewrites only those with rows that change. Without ``keep_versions`` a load
    ends by removing the files that no gold table uses any more, for tables that
    nobody reads meanwhile.
    """

    root: str
    schemas: Mapping[str, str] = field(
        default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    )
    product_sequence: str = "updated_at"
    latest: Sequence[str] = LINEAGE_ORDER
    fact_keys: Sequence[str] = ("order_id",)
    as_of_order_date: bool = False
    only_changed: bool = False
    incremental: bool = True
    buckets: int | None = 4
    sliced: bool = False
    keep_versions: bool = True

    def folder(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.schemas[layer]}.{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def load_bronze(spark: SparkSession, s: Settings, datasets: Sequence[Dataset] = DATASETS) -> None:
    """Ingest new files, and make each dataset a table partitioned by ingestion batch."""
    ingested = ingest_all(spark, datasets, f"{s.root}/source", f"{s.root}/bronze", f"{s.root}/checkpoints")
    tables.create_schema(spark, s.schemas["bronze"], f"{s.root}/bronze")
    for dataset, landed in zip(datasets, ingested.values()):
        if BATCH_ID not in landed.columns or len(landed.columns) == len(LINEAGE) + 1:
            continue  # no file has arrived yet
        table = s.table("bronze", dataset.file_name)
        tables.register(spark, table, s.folder("bronze", dataset.file_name))
        spark.catalog.recoverPartitions(table)


def load_silver(spark: SparkSession, s: Settings, datasets: Sequence[Dataset] = DATASETS) -> None:
    """Clean what is new in bronze. The cleaning is row by row over append-only
    input, so appending gives the table that a full rewrite would give."""
    tables.create_schema(spark, s.schemas["silver"], f"{s.root}/silver")
    started, arrived = [], []
    for name in (d.file_name for d in datasets):
        known = remembered_schema(spark, s.folder("source", name), s.checkpoint(name))
        if known is None:  # no file has arrived yet
            continue
        files = spark.readStream.schema(ingested_schema(known)).options(**ALL_AGES)
        bronze = files.parquet(s.folder("bronze", name))
        # the pricing function is stored beside the tables that are made with it
        options = {"schema": s.schemas["silver"]} if name == "products" else {}
        silver = CLEANERS[name](bronze, **options)
        started.append(start_append(silver, s.folder("silver", name), s.checkpoint(f"silver_{name}")))
        arrived.append(name)
    for query in started:
        query.awaitTermination()
    for name in arrived:
        table = s.table("silver", f"{name}_silver")
        tables.register(spark, table, s.folder("silver", name))
        spark.catalog.refreshTable(table)


def load_customers(spark: SparkSession, s: Settings, load_ts: Column | None = None) -> None:
    customers = s.table("silver", "customers_silver")

    def apply(rows: DataFrame, batch_id: int = 0) -> None:
        scd1_upsert(
            rows.sparkSession,
            s.table("gold", "DimCustomers"),
            rows,
            s.folder("gold", "DimCustomers"),
            key="customer_id",
            surrogate="DimCustomerKey",
            latest=s.latest,
            technical=LINEAGE,
            load_ts=load_ts,
            only_changed=s.only_changed,
            buckets=s.buckets,
            sliced=s.sliced,
        )

    if s.incremental:
        for_each_batch(table_stream(spark, customers), apply, s.checkpoint("DimCustomers"))
    else:
        apply(spark.table(customers))


def products_stage(spark: SparkSession, s: Settings) -> DataFrame:
    """The silver products that pass the quality rules, as a stream.

    A product without a sequence value has no place in the history and fails too.
    """
    products = table_stream(spark, s.table("silver", "products_silver"))
    return staged(products, PRODUCT_RULES | {"sequence": f"{s.product_sequence} IS NOT NULL"})


def load_products(spark: SparkSession, s: Settings) -> dict:
    return apply_changes_stream(
        spark,
        products_stage(spark, s),
        s.table("gold", "DimProducts"),
        s.folder("gold", "DimProducts"),
        s.checkpoint("DimProducts"),
        key=["product_id"],
        sequence_by=s.product_sequence,
        arrival=LINEAGE_ORDER,
        buckets=s.buckets,
    )


def product_versions(spark: SparkSession, s: Settings) -> DataFrame:
    """The product dimension with ``DimProductKey``, the key of each version.

    The key is made of the business key and the beginning of the version, so it
    stays the same when the history is rebuilt.
    """
    products = tables.load(spark, s.table("gold", "DimProducts"))
    begin = F.date_format("valid_from", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    begin = begin if dict(products.dtypes)["valid_from"].startswith("timestamp") else F.col("valid_from")
    return products.withColumn("DimProductKey", F.concat_ws("@", "product_id", begin))


def _latest_orders(s: Settings, orders: DataFrame, *left_out: str) -> tuple[DataFrame, list[DataFrame]]:
    """The latest delivery of each order, and what of it is stored.

    Without a repeated one these are the rows as they are: only hashes are shuffled. Else they are
    stored, so that what the comparison has shuffled is gone from disk before the lookups shuffle.
    Orders are compared by the place of their file's name among all names, not by the name.
    """
    hashed = orders.select(F.xxhash64("order_id").alias("hashed"))
    if hashed.groupBy("hashed").agg(F.count("*").alias("times")).where("times > 1").isEmpty():
        return orders.drop(*left_out), []
    in_order = Window.orderBy(SOURCE_FILE)  # a row per source file
    files = orders.select(SOURCE_FILE).distinct().withColumn("number", F.row_number().over(in_order))
    files = materialise(files, "source-files")
    latest = dedup_latest(_by_file(orders, files, SOURCE_FILE, "number"), ["order_id"], s.latest)
    if SOURCE_FILE not in left_out:
        latest = _by_file(latest, files, "number", SOURCE_FILE)
    latest = materialise(latest.drop(*left_out), "latest-orders")
    discard(files)
    return latest, [latest]


def _by_file(orders: DataFrame, files: DataFrame, known: str, put: str) -> DataFrame:
    """Orders that know their source file as ``known``, with ``put`` in its place."""
    same_file = same([F.col(f"o.{SOURCE_FILE}")], [F.col(f"f.{known}")])
    columns = (F.col(f"f.{put}").alias(c) if c == SOURCE_FILE else column(c, "o") for c in orders.columns)
    return orders.alias("o").join(files.alias("f"), same_file).select(*columns)


def _fact_rows(spark: SparkSession, s: Settings, orders: DataFrame) -> DataFrame:
    """Orders, one row each, with dimension keys beside their own columns."""
    customers = tables.load(spark, s.table("gold", "DimCustomers"))
    products = product_versions(spark, s)
    as_of, product_key = ("order_date", "DimProductKey") if s.as_of_order_date else (None, "product_id")
    return build_fact(
        orders,
        [
            Lookup(customers, "customer_id", "customer_id", "DimCustomerKey", "DimCustomerKey"),
            Lookup(products, "product_id", "product_id", product_key, "DimProductKey", as_of),
        ],
        keep_business_keys=True,
    )


def _merge_fact(spark: SparkSession, s: Settings, found: DataFrame) -> None:
    """Merge stored rows of ``_fact_rows``, without the columns that only the lookups need."""
    name, path = s.table("gold", "FactOrders"), s.folder("gold", "FactOrders")
    rows = found.drop(*LINEAGE, *(c for c, _ in OPEN_KEYS.values()), *(m for _, m in OPEN_KEYS.values()))
    sequence = [c for c in s.latest if c not in LINEAGE]
    once = [k.lower() for k in s.fact_keys] == ["order_id"]  # of which the rows are the latest
    if s.sliced:
        upsert_pruned(spark, name, rows, list(s.fact_keys), path, sequence=sequence, stored=True, unique=once)
    else:
        upsert(
            spark, name, rows, list(s.fact_keys), path,
            sequence=sequence, buckets=s.buckets, bucket_by=["order_id"], stored=True, unique=once,
        )


def load_orders(spark: SparkSession, s: Settings) -> None:
    silver = s.table("silver", "orders_silver")
    if not s.incremental:
        orders, stored = _latest_orders(s, spark.table(silver), *LINEAGE)
        found = materialise(_fact_rows(spark, s, orders), "fact-rows")
        discard(*stored)
        _merge_fact(spark, s, found)
        discard(found)
        return
    if [k.lower() for k in s.fact_keys] != ["order_id"]:
        raise ValueError("an incremental load merges orders by order_id alone")

    def apply(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        # a row per source file; orders are shuffled with its number instead of names and times
        arrivals = rows.select(*LINEAGE).distinct().withColumn(ARRIVAL, F.monotonically_increasing_id())
        arrivals = materialise(arrivals, "arrivals")
        same_file = same([F.col(f"o.{c}") for c in LINEAGE], [F.col(f"a.{c}") for c in LINEAGE])
        orders, stored = _latest_orders(s, rows)
        numbered = orders.alias("o").join(arrivals.alias("a"), same_file).select(
            *(f"o.{c}" for c in orders.columns if c not in LINEAGE), ARRIVAL
        )
        found = materialise(_fact_rows(session, s, numbered), "fact-rows")
        discard(*stored)
        _merge_fact(session, s, found.drop(ARRIVAL))
        _keep_open(session, s, found.join(arrivals, ARRIVAL).select(*orders.columns, *OPEN_KEYS))
        discard(found, arrivals)

    _resolve_open_keys(spark, s)
    for_each_batch(table_stream(spark, silver), apply, s.checkpoint("FactOrders"))


#: Dimension keys of the fact, with the column that each is looked up by and the mark of a key that is open.
OPEN_KEYS = {"DimCustomerKey": ("customer_id", "_open_customer"), "DimProductKey": ("product_id", "_open_product")}
ANY_OPEN = " OR ".join(mark for _, mark in OPEN_KEYS.values())


def _open_marks(found: DataFrame) -> DataFrame:
    """Orders with a mark for each key that was not found; a NULL business key has none to be found."""
    marks = {m: F.col(k).isNull() & F.col(c).isNotNull() for k, (c, m) in OPEN_KEYS.items()}
    return found.withColumns(marks).drop(*OPEN_KEYS)


def _write_open(spark: SparkSession, s: Settings, rows: DataFrame) -> None:
    name, path = s.table("gold", "FactOrders_open"), s.folder("gold", "FactOrders_open")
    if tables.exists(spark, name):
        tables.replace(rows, name, path)
        tables.drop_old_versions(spark, name, path)  # nobody else reads it
    else:
        tables.create(rows, name, path)


def _keep_open(spark: SparkSession, s: Settings, found: DataFrame) -> None:
    """Remember the orders of a batch whose customer or product is unknown, whole, and forget those that are known now."""
    marked = _open_marks(found)
    still = marked.where(ANY_OPEN)
    name = s.table("gold", "FactOrders_open")
    if tables.exists(spark, name):
        old = tables.load(spark, name)
        if not old.isEmpty():
            # the later delivery of an order counts, whether its keys are known or not; of known ones only that is needed
            known = marked.where(f"NOT ({ANY_OPEN})").select("order_id", *s.latest, *(m for _, m in OPEN_KEYS.values()))
            there = old.select(F.col("order_id").alias("_order"))
            known = known.join(there, F.col("order_id").eqNullSafe(F.col("_order")), "left_semi")
            either = old.unionByName(still).unionByName(known, allowMissingColumns=True)
            still = dedup_latest(either, ["order_id"], s.latest).where(ANY_OPEN)
        elif still.isEmpty():
            return
    _write_open(spark, s, still)


def _resolve_open_keys(spark: SparkSession, s: Settings) -> None:
    """Look up again the orders whose customer or product was unknown so far.

    They are kept beside the fact, so no silver order is read again, and only
    orders that gain a key are merged.
    """
    name = s.table("gold", "FactOrders_open")
    if not tables.exists(spark, name):
        return
    unresolved = tables.load(spark, name)
    if unresolved.isEmpty():
        return
    found = materialise(_fact_rows(spark, s, unresolved), "fact-rows")
    more = found.where(" OR ".join(f"({m} AND {k} IS NOT NULL)" for k, (_, m) in OPEN_KEYS.items()))
    if not more.isEmpty():
        _merge_fact(spark, s, more)
        _write_open(spark, s, _open_marks(found).where(ANY_OPEN))
    discard(found)


def run(
    spark: SparkSession,
    settings: Settings,
    datasets: Sequence[Dataset] = DATASETS,
    load_ts: Column | None = None,
) -> None:
    """One load, in the order in which the layers depend on each other."""
    with freed_shuffles(spark):
        _run(spark, settings, datasets, load_ts)


def _run(spark: SparkSession, settings: Settings, datasets: Sequence[Dataset], load_ts: Column | None) -> None:
    load_bronze(spark, settings, datasets)
    load_silver(spark, settings, datasets)
    tables.create_schema(spark, settings.schemas["gold"], f"{settings.root}/gold")
    have = [tables.exists(spark, settings.table("silver", f"{n}_silver")) for n in ("customers", "products", "orders")]
    # The two dimensions do not depend on each other.
    steps = [lambda: load_customers(spark, settings, load_ts), lambda: load_products(spark, settings)]
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step, there in zip(steps, have) if there]:
            done.result()
    if all(have):
        load_orders(spark, settings)
    if not settings.keep_versions:
        for name in ("DimCustomers", "DimProducts", "FactOrders"):
            if tables.exists(spark, settings.table("gold", name)):
                tables.drop_old_versions(spark, settings.table("gold", name), settings.folder("gold", name))
