"""Checked queries: each operator of the pipeline run over the driver's tables,
next to an independent SQL formulation of the same result (the oracle).

Every query reads whole tables through the stand-ins of
``lakeshore.sources.standins``; none caps or samples rows. Nested and map
results are flattened (``inline`` / one column per key) before they are
returned, because list order is not part of the result.

Scenario used by the incremental, upsert and reconciliation checks (fixed
values below): a bronze copy was taken at ``SNAPSHOT_CUTOFF``; it holds every
row created before then, in an older version (stamp ``STALE_DAYS`` earlier,
``ShipMethod`` / ``OrderQty`` marked stale). Since then the source has gained
rows, changed rows, and purged some old ones (``PURGE_*``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.context import PipelineContext
from lakeshore.functions.attrs import attr, date_attrs, num_attrs, text_attrs
from lakeshore.functions.keys import surrogate_key
from lakeshore.operators.incremental import high_water_mark_text, mark_frame, newer_than, newer_than_target
from lakeshore.operators.nesting import inline_items
from lakeshore.operators.reconcile import (
    ReconcilePair,
    count_reconciliation,
    key_reconciliation,
    missing_keys,
    validation_gate,
)
from lakeshore.operators.upsert import BUCKET_COL, merge_frames, upsert_table
from lakeshore.plans.conform import (
    conform_addresses,
    conform_customers,
    conform_orders,
    conform_products,
    model_descriptions,
)
from lakeshore.plans.ingest import ingest_table
from lakeshore.plans.serve import flatten_orders
from lakeshore.session import shared_folder
from lakeshore.sources import standins as S
from lakeshore.sources.standins import standin_ctes
from lakeshore.specs import spec_by_name

CTX = PipelineContext(company="acme", env="dev")
PREFIX = CTX.key_prefix  # 'dev_erp_'

# Fixed values of the scenario.
SNAPSHOT_CUTOFF = "2000-01-01 00:00:00"
STALE_DAYS = 730
STALE_METHOD = "OLD"
STALE_QTY = -1.0
PURGE_STATUS = "P"
PURGE_BEFORE = "1997-01-01 00:00:00"
PURGE_DISCOUNT = 0.0

HEADER_COLS = (
    "SalesOrderID", "RevisionNumber", "OrderDate", "DueDate", "ShipDate", "Status",
    "OnlineOrderFlag", "SalesOrderNumber", "PurchaseOrderNumber", "AccountNumber",
    "CustomerID", "ShipToAddressID", "BillToAddressID", "ShipMethod", "ModifiedDate",
)
DETAIL_COLS = (
    "SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice",
    "UnitPriceDiscount", "ModifiedDate",
)


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------------------
# Scenario frames (Spark side)
# ---------------------------------------------------------------------------


def header_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    hdr = S.salesorderheader(spark, sf_dir)
    return hdr.where(F.col("ModifiedDate") < _ts(SNAPSHOT_CUTOFF)).withColumns(
        {
            "ModifiedDate": F.col("ModifiedDate") - F.expr(f"INTERVAL {STALE_DAYS} DAYS"),
            "ShipMethod": F.lit(STALE_METHOD),
        }
    )


def header_source_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    hdr = S.salesorderheader(spark, sf_dir)
    purged = (F.col("Status") == F.lit(PURGE_STATUS)) & (F.col("OrderDate") < _ts(PURGE_BEFORE))
    return hdr.where(~purged)


def detail_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = S.salesorderdetail_unique(spark, sf_dir)
    return det.where(F.col("ModifiedDate") < _ts(SNAPSHOT_CUTOFF)).withColumns(
        {
            "ModifiedDate": F.col("ModifiedDate") - F.expr(f"INTERVAL {STALE_DAYS} DAYS"),
            "OrderQty": F.lit(STALE_QTY),
        }
    )


def detail_source_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = S.salesorderdetail_unique(spark, sf_dir)
    purged = (F.col("UnitPriceDiscount") == F.lit(PURGE_DISCOUNT)) & (
        F.col("ModifiedDate") < _ts(PURGE_BEFORE)
    )
    return det.where(~purged)


def ship_to_pairs(hdr: DataFrame) -> DataFrame:
    return hdr.select("CustomerID", F.col("ShipToAddressID").alias("AddressID")).distinct()


def _orders(spark: SparkSession, sf_dir: str, changed_since=None) -> DataFrame:
    return conform_orders(
        S.salesorderheader(spark, sf_dir), S.salesorderdetail(spark, sf_dir), CTX, changed_since=changed_since
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_products(
        S.product(spark, sf_dir),
        S.productcategory(spark, sf_dir),
        S.productmodel(spark, sf_dir),
        S.productdescription(spark, sf_dir),
        S.productmodelproductdescription(spark, sf_dir),
        CTX,
    )


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------


def q_high_water_mark(spark, sf_dir):
    hdr = S.salesorderheader(spark, sf_dir)
    full = mark_frame(hdr, "ModifiedDate").select(F.lit("orders").alias("target"), "mark")
    empty = mark_frame(newer_than_target(hdr, "ModifiedDate", hdr), "ModifiedDate").select(
        F.lit("empty_increment").alias("target"), "mark"
    )
    return full.unionByName(empty)


def q_incremental_read(spark, sf_dir):
    src = S.salesorderheader(spark, sf_dir)
    return newer_than_target(src, "ModifiedDate", header_snapshot(spark, sf_dir))


def q_upsert_single_key(spark, sf_dir):
    target = header_snapshot(spark, sf_dir)
    src = S.salesorderheader(spark, sf_dir)
    updates = newer_than_target(src, "ModifiedDate", target)
    return merge_frames(target, updates, ["SalesOrderId"])


def q_upsert_composite_key(spark, sf_dir):
    target = detail_snapshot(spark, sf_dir)
    src = S.salesorderdetail_unique(spark, sf_dir)
    updates = newer_than_target(src, "ModifiedDate", target)
    return merge_frames(target, updates, ["SalesOrderId", "SalesOrderDetailID"])


def _fresh_context(spark: SparkSession) -> PipelineContext:
    """A company of its own for each call, its databases in the shared folder."""
    ctx = PipelineContext(company=f"run{uuid.uuid4().hex[:12]}", env="dev")
    for db in {ctx.database("bronze_erp"), ctx.control_db}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{shared_folder(spark)}/lakeshore/{db}'")
    return ctx


def _upserted(spark, snapshot: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The stale copy and then the newer rows, by collected mark, written to a table."""
    name = f"{_fresh_context(spark).database('bronze_erp')}.copy"
    upsert_table(spark, name, snapshot, keys, stamp="ModifiedDate")
    mark = high_water_mark_text(spark.read.table(name), "ModifiedDate")
    upsert_table(spark, name, newer_than(source, "ModifiedDate", mark), keys, stamp="ModifiedDate")
    return spark.read.table(name).drop(BUCKET_COL)


def q_table_upsert_single(spark, sf_dir):
    return _upserted(spark, header_snapshot(spark, sf_dir), S.salesorderheader(spark, sf_dir), ["SalesOrderID"])


def q_table_upsert_composite(spark, sf_dir):
    keys = ["SalesOrderID", "SalesOrderDetailID"]
    return _upserted(spark, detail_snapshot(spark, sf_dir), S.salesorderdetail_unique(spark, sf_dir), keys)


def q_table_upsert_surrogate(spark, sf_dir):
    frames = (header_snapshot(spark, sf_dir), S.salesorderheader(spark, sf_dir))
    old, new = (f.withColumn("id", surrogate_key("SalesOrderID", CTX)) for f in frames)
    return _upserted(spark, old, new, ["id"])


def q_ingest_two_runs(spark, sf_dir):
    """The replication job twice: a first load of the stale copy, then the increment."""
    ctx, spec = _fresh_context(spark), spec_by_name("sales_order_header")
    for source in (header_snapshot(spark, sf_dir), S.salesorderheader(spark, sf_dir)):
        ingest_table(spark, ctx, spec, source)
    return spark.read.table(ctx.bronze(spec.name)).drop(BUCKET_COL)


def q_surrogate_keys(spark, sf_dir):
    hdr = S.salesorderheader(spark, sf_dir)
    return hdr.select(
        "SalesOrderID",
        surrogate_key("SalesOrderID", CTX).alias("id"),
        surrogate_key("CustomerID", CTX).alias("customer_fk"),
        surrogate_key("ShipToAddressID", CTX).alias("shto_address_fk"),
        surrogate_key("BillToAddressID", CTX).alias("blto_address_fk"),
    )


def q_nest_unnest(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return inline_items(orders.select("id", "customer_fk", "order_date", "line_items"), "line_items")


def q_nested_line_counts(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return orders.select("id", F.size("line_items").alias("n_lines"))


def q_language_map(spark, sf_dir):
    pmd = model_descriptions(
        S.productmodelproductdescription(spark, sf_dir), S.productdescription(spark, sf_dir)
    )
    m = F.col("descriptions")
    return pmd.select(
        "ProductModelID",
        m.getItem("en").alias("desc_en"),
        m.getItem("de").alias("desc_de"),
        m.getItem("fr").alias("desc_fr"),
        m.getItem("es").alias("desc_es"),
        F.when(m.isNotNull(), F.size(m)).alias("n_cultures"),
    )


def q_attr_maps(spark, sf_dir):
    hdr = S.salesorderheader(spark, sf_dir)
    maps = hdr.select(
        "SalesOrderID",
        num_attrs(revision_number="RevisionNumber").alias("n"),
        date_attrs(ship_date="ShipDate", due_date="DueDate").alias("d"),
        text_attrs(
            sales_order_no="SalesOrderNumber",
            purchase_order_no="PurchaseOrderNumber",
            account_number="AccountNumber",
        ).alias("t"),
    )
    return maps.select(
        "SalesOrderID",
        attr("n", "revision_number").alias("revision_number"),
        attr("d", "ship_date").alias("ship_date"),
        attr("d", "due_date").alias("due_date"),
        attr("t", "sales_order_no").alias("sales_order_no"),
        attr("t", "purchase_order_no").alias("purchase_order_no"),
        attr("t", "account_number").alias("account_number"),
        attr("t", "no_such_key").alias("missing_key"),
    )


def q_hierarchy_join(spark, sf_dir):
    p = S.product(spark, sf_dir).alias("p")
    pc = S.productcategory(spark, sf_dir)
    return (
        p.join(pc.alias("pc"), F.col("p.ProductCategoryID") == F.col("pc.ProductCategoryID"), "left")
        .join(pc.alias("ppc"), F.col("pc.ParentProductCategoryID") == F.col("ppc.ProductCategoryID"), "left")
        .select(
            F.col("p.ProductID").alias("ProductID"),
            F.col("pc.Name").alias("category_name"),
            F.col("ppc.Name").alias("parent_category_name"),
        )
    )


def q_lookup_left_join(spark, sf_dir):
    p = S.product(spark, sf_dir).alias("p")
    pm = S.productmodel(spark, sf_dir).alias("pm")
    pmd = model_descriptions(
        S.productmodelproductdescription(spark, sf_dir), S.productdescription(spark, sf_dir)
    ).alias("pmd")
    return (
        p.join(pm, F.col("p.ProductModelID") == F.col("pm.ProductModelID"), "left")
        .join(pmd, F.col("p.ProductModelID") == F.col("pmd.ProductModelID"), "left")
        .select(
            F.col("p.ProductID").alias("ProductID"),
            F.col("pm.Name").alias("model_name"),
            F.col("pmd.descriptions").getItem("en").alias("model_description"),
        )
    )


def q_role_playing_join(spark, sf_dir):
    hdr = S.salesorderheader(spark, sf_dir)
    addr = conform_addresses(S.address(spark, sf_dir), CTX).select("id", "city")
    o = hdr.select(
        "SalesOrderID",
        surrogate_key("ShipToAddressID", CTX).alias("sa_fk"),
        surrogate_key("BillToAddressID", CTX).alias("ba_fk"),
    ).alias("o")
    return (
        o.join(addr.alias("sa"), F.col("o.sa_fk") == F.col("sa.id"), "left")
        .join(addr.alias("ba"), F.col("o.ba_fk") == F.col("ba.id"), "left")
        .select(
            F.col("o.SalesOrderID").alias("SalesOrderID"),
            F.col("sa.city").alias("shipment_city"),
            F.col("ba.city").alias("billing_city"),
        )
    )


def q_conform_addresses(spark, sf_dir):
    a = conform_addresses(S.address(spark, sf_dir), CTX)
    return a.select(
        "id", "full_address", "city", "state", "country", "postcode",
        F.col("_num_attrs").isNull().alias("num_attrs_is_null"),
        F.col("_date_attrs").isNull().alias("date_attrs_is_null"),
        F.col("_text_attrs").isNull().alias("text_attrs_is_null"),
        "_source_id", "_source_modstamp",
    )


def q_conform_customers(spark, sf_dir):
    c = conform_customers(S.customer(spark, sf_dir), CTX)
    return c.select(
        "id", "name", "email", "phone", "company",
        F.col("_num_attrs").isNull().alias("num_attrs_is_null"),
        attr("_text_attrs", "title").alias("title"),
        attr("_text_attrs", "suffix").alias("suffix"),
        attr("_text_attrs", "sales_person").alias("sales_person"),
        "_source_id", "_source_modstamp",
    )


def q_conform_products(spark, sf_dir):
    p = _products(spark, sf_dir)
    md = F.col("model_descriptions")
    return p.select(
        "id", "sku", "name", "list_price", "category_name", "parent_category_name", "model_name",
        md.getItem("en").alias("desc_en"),
        md.getItem("de").alias("desc_de"),
        F.when(md.isNotNull(), F.size(md)).alias("n_descriptions"),  # NULL map -> NULL in any ANSI mode
        attr("_num_attrs", "cost").alias("cost"),
        attr("_num_attrs", "weight").alias("weight"),
        attr("_date_attrs", "sell_start_ts").alias("sell_start_ts"),
        attr("_date_attrs", "sell_end_ts").alias("sell_end_ts"),
        attr("_date_attrs", "discontinued_ts").alias("discontinued_ts"),
        attr("_text_attrs", "color").alias("color"),
        attr("_text_attrs", "size").alias("size"),
        "_source_id", "_source_modstamp",
    )


def _order_header_columns(orders: DataFrame) -> DataFrame:
    return orders.select(
        "id", "customer_fk", "shto_address_fk", "blto_address_fk", "order_date",
        "order_status", "was_online_order", "shipping_method",
        attr("_num_attrs", "revision_number").alias("revision_number"),
        attr("_date_attrs", "ship_date").alias("ship_date"),
        attr("_date_attrs", "due_date").alias("due_date"),
        attr("_text_attrs", "sales_order_no").alias("sales_order_no"),
        attr("_text_attrs", "purchase_order_no").alias("purchase_order_no"),
        attr("_text_attrs", "account_number").alias("account_number"),
        F.size("line_items").alias("n_lines"),
        "_source_id", "_source_modstamp",
    )


def q_conform_orders(spark, sf_dir):
    return _order_header_columns(_orders(spark, sf_dir))


def q_conform_orders_changed(spark, sf_dir):
    """P9 restricted to orders changed after the snapshot's mark."""
    mark = mark_frame(header_snapshot(spark, sf_dir), "ModifiedDate").scalar()
    return _order_header_columns(_orders(spark, sf_dir, changed_since=mark))


def q_orders_flattened(spark, sf_dir):
    customers = conform_customers(S.customer(spark, sf_dir), CTX)
    addresses = conform_addresses(S.address(spark, sf_dir), CTX)
    return flatten_orders(_orders(spark, sf_dir), _products(spark, sf_dir), customers, addresses, CTX)


# Reconciled tables: (table name, copy, source, key). The order tables have
# a stale copy and purged source rows; the other seven are reconciled against
# an identical copy, where nothing may be reported.
RECONCILED = (
    ("sales_order_header", "snap_h", "now_h", ("SalesOrderID",)),
    ("sales_order_detail", "snap_d", "now_d", ("SalesOrderID", "SalesOrderDetailID")),
    ("customer_address", "snap_ca", "now_ca", ("CustomerID", "AddressID")),
    ("address", "address", "address", ("AddressID",)),
    ("customer", "customer", "customer", ("CustomerID",)),
    ("product", "product", "product", ("ProductID",)),
    ("product_category", "productcategory", "productcategory", ("ProductCategoryID",)),
    ("product_description", "productdescription", "productdescription", ("ProductDescriptionID",)),
    ("product_model", "productmodel", "productmodel", ("ProductModelID",)),
    (
        "product_model_description",
        "productmodelproductdescription",
        "productmodelproductdescription",
        ("ProductModelID", "ProductDescriptionID"),
    ),
)


def _reconcile_pairs(spark, sf_dir) -> list[ReconcilePair]:
    snap_h = header_snapshot(spark, sf_dir)
    now_h = header_source_now(spark, sf_dir)
    frames = {
        "snap_h": lambda: snap_h,
        "now_h": lambda: now_h,
        "snap_d": lambda: detail_snapshot(spark, sf_dir),
        "now_d": lambda: detail_source_now(spark, sf_dir),
        "snap_ca": lambda: ship_to_pairs(snap_h),
        "now_ca": lambda: ship_to_pairs(now_h),
    }
    pairs = []
    for table, copy, src, keys in RECONCILED:
        build = lambda name: frames[name]() if name in frames else S.BUILDERS[name](spark, sf_dir)
        pairs.append(ReconcilePair(table, build(copy), build(src), keys))
    return pairs


def q_fk_full_outer_single(spark, sf_dir):
    return missing_keys(_reconcile_pairs(spark, sf_dir)[0])


def q_fk_full_outer_composite(spark, sf_dir):
    return missing_keys(_reconcile_pairs(spark, sf_dir)[1])


def q_validation_keys(spark, sf_dir):
    return key_reconciliation(_reconcile_pairs(spark, sf_dir))


def q_validation_totals(spark, sf_dir):
    return count_reconciliation(_reconcile_pairs(spark, sf_dir))


def q_validation_gate(spark, sf_dir):
    """Gate over copies brought up to date by an incremental upsert: passes."""
    src_h = S.salesorderheader(spark, sf_dir)
    snap_h = header_snapshot(spark, sf_dir)
    copy_h = merge_frames(snap_h, newer_than_target(src_h, "ModifiedDate", snap_h), ["SalesOrderID"])
    src_d = S.salesorderdetail_unique(spark, sf_dir)
    snap_d = detail_snapshot(spark, sf_dir)
    copy_d = merge_frames(
        snap_d, newer_than_target(src_d, "ModifiedDate", snap_d), ["SalesOrderID", "SalesOrderDetailID"]
    )
    cus = S.customer(spark, sf_dir)
    totals = count_reconciliation(
        [
            ReconcilePair("sales_order_header", copy_h, src_h, ("SalesOrderID",)),
            ReconcilePair("sales_order_detail", copy_d, src_d, ("SalesOrderID", "SalesOrderDetailID")),
            ReconcilePair(
                "customer",
                merge_frames(spark.createDataFrame([], cus.schema), cus, ["CustomerID"]),
                cus,
                ("CustomerID",),
            ),
        ]
    )
    return validation_gate(totals, ["sales_order_header", "sales_order_detail", "customer"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "high_water_mark": q_high_water_mark,
    "incremental_read": q_incremental_read,
    "upsert_single_key": q_upsert_single_key,
    "upsert_composite_key": q_upsert_composite_key,
    "table_upsert_single": q_table_upsert_single,
    "table_upsert_composite": q_table_upsert_composite,
    "table_upsert_surrogate": q_table_upsert_surrogate,
    "ingest_two_runs": q_ingest_two_runs,
    "surrogate_keys": q_surrogate_keys,
    "nest_unnest": q_nest_unnest,
    "nested_line_counts": q_nested_line_counts,
    "language_map": q_language_map,
    "attr_maps": q_attr_maps,
    "hierarchy_join": q_hierarchy_join,
    "lookup_left_join": q_lookup_left_join,
    "role_playing_join": q_role_playing_join,
    "conform_addresses": q_conform_addresses,
    "conform_customers": q_conform_customers,
    "conform_products": q_conform_products,
    "conform_orders": q_conform_orders,
    "conform_orders_changed": q_conform_orders_changed,
    "orders_flattened": q_orders_flattened,
    "fk_full_outer_single": q_fk_full_outer_single,
    "fk_full_outer_composite": q_fk_full_outer_composite,
    "validation_keys": q_validation_keys,
    "validation_totals": q_validation_totals,
    "validation_gate": q_validation_gate,
}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Written independently of the Spark code: full outer
# joins where the engine uses anti joins or tagged unions, FILTER aggregates
# where it builds maps, plain joins where it nests and unnests.
# ---------------------------------------------------------------------------

_SHA = "sha256('" + PREFIX + "' || CAST({} AS VARCHAR))"


def _sha(expr: str) -> str:
    return _SHA.format(expr)


_HDR_SNAPSHOT = (
    f"SELECT * REPLACE (ModifiedDate - INTERVAL {STALE_DAYS} DAY AS ModifiedDate, "
    f"'{STALE_METHOD}' AS ShipMethod) FROM salesorderheader "
    f"WHERE ModifiedDate < TIMESTAMP '{SNAPSHOT_CUTOFF}'"
)
_HDR_NOW = (
    "SELECT * FROM salesorderheader "
    f"WHERE NOT (Status = '{PURGE_STATUS}' AND OrderDate < TIMESTAMP '{PURGE_BEFORE}')"
)
_DET_SNAPSHOT = (
    f"SELECT * REPLACE (ModifiedDate - INTERVAL {STALE_DAYS} DAY AS ModifiedDate, "
    f"CAST({STALE_QTY} AS DOUBLE) AS OrderQty) FROM salesorderdetail_unique "
    f"WHERE ModifiedDate < TIMESTAMP '{SNAPSHOT_CUTOFF}'"
)
_DET_NOW = (
    "SELECT * FROM salesorderdetail_unique "
    f"WHERE NOT (UnitPriceDiscount = {PURGE_DISCOUNT} AND ModifiedDate < TIMESTAMP '{PURGE_BEFORE}')"
)
_EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def _upsert_full_join(cols, keys, tgt="tgt", upd="upd") -> str:
    """Upsert as FULL JOIN: the update's value where a key matched, else the target's."""
    matched = " AND ".join(f"{upd}.{k} IS NOT NULL" for k in keys)
    on = " AND ".join(f"{tgt}.{k} = {upd}.{k}" for k in keys)
    select = ",\n  ".join(f"CASE WHEN {matched} THEN {upd}.{c} ELSE {tgt}.{c} END AS {c}" for c in cols)
    return f"SELECT\n  {select}\nFROM {tgt} FULL OUTER JOIN {upd} ON {on}"


def _foj_missing(table: str, copy: str, src: str, keys) -> str:
    """Reference-style key check: full outer join, keep one-sided rows, label."""
    on = " AND ".join(f"b.{k} = s.{k}" for k in keys)

    def text(alias):
        if len(keys) == 1:
            return f"CAST({alias}.{keys[0]} AS VARCHAR)"
        return "concat_ws('|', " + ", ".join(
            f"COALESCE(CAST({alias}.{k} AS VARCHAR), '')" for k in keys
        ) + ")"

    def present(alias):
        return " AND ".join(f"{alias}.{k} IS NOT NULL" for k in keys)

    b_row = "b.__row IS NOT NULL"
    s_row = "s.__row IS NOT NULL"
    return f"""
      SELECT DISTINCT '{table}' AS table_name,
        CASE WHEN {b_row} THEN {text('b')} ELSE {text('s')} END AS pk,
        CASE
          WHEN NOT ({present('b')}) AND {b_row} THEN 'both'
          WHEN NOT ({present('s')}) AND {s_row} THEN 'both'
          WHEN {b_row} AND NOT {s_row} THEN 'source'
          WHEN {s_row} AND NOT {b_row} THEN 'target'
        END AS missing_in
      FROM (SELECT *, TRUE AS __row FROM {copy}) b
      FULL OUTER JOIN (SELECT *, TRUE AS __row FROM {src}) s ON {on}
      WHERE b.__row IS NULL OR s.__row IS NULL"""


_RECONCILE_CTES = f"""
  snap_h AS ({_HDR_SNAPSHOT}),
  now_h AS ({_HDR_NOW}),
  snap_d AS ({_DET_SNAPSHOT}),
  now_d AS ({_DET_NOW}),
  snap_ca AS (SELECT DISTINCT CustomerID, ShipToAddressID AS AddressID FROM snap_h),
  now_ca AS (SELECT DISTINCT CustomerID, ShipToAddressID AS AddressID FROM now_h)"""

_ALL_STANDINS = tuple(S.BUILDERS)

_SILVER_CTES = f"""
  addresses AS (
    SELECT {_sha('AddressID')} AS id, AddressID,
           COALESCE(AddressLine1 || chr(10) || AddressLine2, AddressLine1) AS full_address,
           City AS city, StateProvince AS state, CountryRegion AS country, PostalCode AS postcode
    FROM address),
  customers AS (
    SELECT {_sha('CustomerID')} AS id, CustomerID,
           COALESCE(FirstName, '') || ' ' || COALESCE(MiddleName, '') || ' ' || COALESCE(LastName, '') AS name,
           EmailAddress AS email, Phone AS phone, CompanyName AS company,
           Title AS title, Suffix AS suffix, SalesPerson AS sales_person, ModifiedDate
    FROM customer),
  descs AS (
    SELECT b.ProductModelID,
           max(d.Description) FILTER (WHERE b.Culture = 'en') AS desc_en,
           max(d.Description) FILTER (WHERE b.Culture = 'de') AS desc_de,
           max(d.Description) FILTER (WHERE b.Culture = 'fr') AS desc_fr,
           max(d.Description) FILTER (WHERE b.Culture = 'es') AS desc_es,
           CAST(count(DISTINCT b.Culture) AS INTEGER) AS n_cultures
    FROM productmodelproductdescription b
    LEFT JOIN productdescription d ON b.ProductDescriptionID = d.ProductDescriptionID
    GROUP BY b.ProductModelID),
  products AS (
    SELECT {_sha('p.ProductID')} AS id, p.ProductID, p.ProductNumber AS sku, p.Name AS name,
           p.ListPrice AS list_price, pc.Name AS category_name, ppc.Name AS parent_category_name,
           pm.Name AS model_name, ds.desc_en, ds.desc_de, ds.n_cultures,
           CAST(p.StandardCost AS DOUBLE) AS cost, CAST(p.Weight AS DOUBLE) AS weight,
           CAST(p.SellStartDate AS DATE) AS sell_start_ts, CAST(p.SellEndDate AS DATE) AS sell_end_ts,
           CAST(p.DiscontinuedDate AS DATE) AS discontinued_ts,
           p.Color AS color, p.Size AS size, p.ModifiedDate
    FROM product p
    LEFT JOIN productcategory pc ON p.ProductCategoryID = pc.ProductCategoryID
    LEFT JOIN productcategory ppc ON pc.ParentProductCategoryID = ppc.ProductCategoryID
    LEFT JOIN productmodel pm ON p.ProductModelID = pm.ProductModelID
    LEFT JOIN descs ds ON p.ProductModelID = ds.ProductModelID),
  line_counts AS (
    SELECT SalesOrderID, CAST(count(*) AS INTEGER) AS n_lines
    FROM salesorderdetail GROUP BY SalesOrderID),
  order_rows AS (
    SELECT {_sha('h.SalesOrderID')} AS id, {_sha('h.CustomerID')} AS customer_fk,
           {_sha('h.ShipToAddressID')} AS shto_address_fk, {_sha('h.BillToAddressID')} AS blto_address_fk,
           CAST(h.OrderDate AS DATE) AS order_date, h.Status AS order_status,
           h.OnlineOrderFlag AS was_online_order, h.ShipMethod AS shipping_method,
           CAST(h.RevisionNumber AS DOUBLE) AS revision_number,
           CAST(h.ShipDate AS DATE) AS ship_date, CAST(h.DueDate AS DATE) AS due_date,
           h.SalesOrderNumber AS sales_order_no, h.PurchaseOrderNumber AS purchase_order_no,
           h.AccountNumber AS account_number, lc.n_lines,
           '{CTX.source_id}' AS _source_id, h.ModifiedDate AS _source_modstamp
    FROM salesorderheader h JOIN line_counts lc ON h.SalesOrderID = lc.SalesOrderID)"""


def _with(*parts: str) -> str:
    return standin_ctes(*_ALL_STANDINS, "salesorderdetail_unique") + ",\n" + ",\n".join(parts)


ORACLE_SQL: dict[str, str] = {
    "high_water_mark": _with("""
  marks AS (SELECT 'orders' AS target, COALESCE(max(ModifiedDate), TIMESTAMP '1970-01-01 00:00:00') AS mark
            FROM salesorderheader)""") + """
SELECT target, mark FROM marks
UNION ALL
SELECT 'empty_increment', COALESCE(max(ModifiedDate), TIMESTAMP '1970-01-01 00:00:00')
FROM salesorderheader WHERE ModifiedDate > (SELECT mark FROM marks)""",
    "incremental_read": _with(f"tgt AS ({_HDR_SNAPSHOT})") + f"""
SELECT * FROM salesorderheader
WHERE ModifiedDate > COALESCE((SELECT max(ModifiedDate) FROM tgt), {_EPOCH})""",
    "upsert_single_key": _with(
        f"tgt AS ({_HDR_SNAPSHOT})",
        f"upd AS (SELECT * FROM salesorderheader WHERE ModifiedDate > "
        f"COALESCE((SELECT max(ModifiedDate) FROM tgt), {_EPOCH}))",
    ) + "\n" + _upsert_full_join(HEADER_COLS, ["SalesOrderID"]),
    "upsert_composite_key": _with(
        f"tgt AS ({_DET_SNAPSHOT})",
        f"upd AS (SELECT * FROM salesorderdetail_unique WHERE ModifiedDate > "
        f"COALESCE((SELECT max(ModifiedDate) FROM tgt), {_EPOCH}))",
    ) + "\n" + _upsert_full_join(DETAIL_COLS, ["SalesOrderID", "SalesOrderDetailID"]),
    "surrogate_keys": standin_ctes("salesorderheader") + f"""
SELECT SalesOrderID, {_sha('SalesOrderID')} AS id, {_sha('CustomerID')} AS customer_fk,
       CASE WHEN ShipToAddressID IS NOT NULL THEN {_sha('ShipToAddressID')} END AS shto_address_fk,
       {_sha('BillToAddressID')} AS blto_address_fk
FROM salesorderheader""",
    "nest_unnest": standin_ctes("salesorderheader", "salesorderdetail") + f"""
SELECT {_sha('h.SalesOrderID')} AS id, {_sha('h.CustomerID')} AS customer_fk,
       CAST(h.OrderDate AS DATE) AS order_date,
       {_sha('d.SalesOrderDetailID')} AS line_item_id, {_sha('d.ProductID')} AS product_fk,
       CAST(d.OrderQty AS DOUBLE) AS quantity, CAST(d.UnitPrice AS DOUBLE) AS unit_price,
       CAST(d.UnitPriceDiscount AS DOUBLE) AS discount
FROM salesorderheader h JOIN salesorderdetail d ON h.SalesOrderID = d.SalesOrderID""",
    "nested_line_counts": standin_ctes("salesorderheader", "salesorderdetail") + f"""
SELECT {_sha('h.SalesOrderID')} AS id, CAST(count(*) AS INTEGER) AS n_lines
FROM salesorderheader h JOIN salesorderdetail d ON h.SalesOrderID = d.SalesOrderID
GROUP BY h.SalesOrderID""",
    "language_map": _with(_SILVER_CTES) + """
SELECT ProductModelID, desc_en, desc_de, desc_fr, desc_es, n_cultures FROM descs""",
    "attr_maps": standin_ctes("salesorderheader") + """
SELECT SalesOrderID, CAST(RevisionNumber AS DOUBLE) AS revision_number,
       CAST(ShipDate AS DATE) AS ship_date, CAST(DueDate AS DATE) AS due_date,
       SalesOrderNumber AS sales_order_no, PurchaseOrderNumber AS purchase_order_no,
       AccountNumber AS account_number, CAST(NULL AS VARCHAR) AS missing_key
FROM salesorderheader""",
    "hierarchy_join": standin_ctes("product", "productcategory") + """
SELECT p.ProductID, pc.Name AS category_name, ppc.Name AS parent_category_name
FROM product p
LEFT JOIN productcategory pc ON p.ProductCategoryID = pc.ProductCategoryID
LEFT JOIN productcategory ppc ON pc.ParentProductCategoryID = ppc.ProductCategoryID""",
    "lookup_left_join": _with(_SILVER_CTES) + """
SELECT p.ProductID, pm.Name AS model_name, ds.desc_en AS model_description
FROM product p
LEFT JOIN productmodel pm ON p.ProductModelID = pm.ProductModelID
LEFT JOIN descs ds ON p.ProductModelID = ds.ProductModelID""",
    "role_playing_join": standin_ctes("salesorderheader", "address") + """
SELECT h.SalesOrderID, sa.City AS shipment_city, ba.City AS billing_city
FROM salesorderheader h
LEFT JOIN address sa ON h.ShipToAddressID = sa.AddressID
LEFT JOIN address ba ON h.BillToAddressID = ba.AddressID""",
    "conform_addresses": standin_ctes("address") + f"""
SELECT {_sha('AddressID')} AS id,
       CASE WHEN AddressLine2 IS NULL THEN AddressLine1
            ELSE AddressLine1 || chr(10) || AddressLine2 END AS full_address,
       City AS city, StateProvince AS state, CountryRegion AS country, PostalCode AS postcode,
       TRUE AS num_attrs_is_null, TRUE AS date_attrs_is_null, TRUE AS text_attrs_is_null,
       '{CTX.source_id}' AS _source_id, ModifiedDate AS _source_modstamp
FROM address""",
    "conform_customers": _with(_SILVER_CTES) + f"""
SELECT id, name, email, phone, company, TRUE AS num_attrs_is_null, title, suffix, sales_person,
       '{CTX.source_id}' AS _source_id, ModifiedDate AS _source_modstamp
FROM customers""",
    "conform_products": _with(_SILVER_CTES) + f"""
SELECT id, sku, name, list_price, category_name, parent_category_name, model_name,
       desc_en, desc_de, n_cultures AS n_descriptions, cost, weight,
       sell_start_ts, sell_end_ts, discontinued_ts, color, size,
       '{CTX.source_id}' AS _source_id, ModifiedDate AS _source_modstamp
FROM products""",
    "conform_orders": _with(_SILVER_CTES) + """
SELECT * FROM order_rows""",
    "conform_orders_changed": _with(_SILVER_CTES, f"snap AS ({_HDR_SNAPSHOT})") + """
SELECT * FROM order_rows
WHERE _source_modstamp > (SELECT COALESCE(max(ModifiedDate), TIMESTAMP '1970-01-01 00:00:00') FROM snap)""",
    "orders_flattened": _with(_SILVER_CTES) + """
SELECT CAST(h.OrderDate AS DATE) AS order_date, CAST(d.OrderQty AS DOUBLE) AS quantity,
       CAST(d.UnitPrice AS DOUBLE) AS unit_price, CAST(d.UnitPriceDiscount AS DOUBLE) AS discount,
       h.OnlineOrderFlag AS was_online_order, h.ShipMethod AS shipping_method,
       CAST(h.ShipDate AS DATE) AS ship_date, CAST(h.DueDate AS DATE) AS due_date,
       p.name AS product_name, p.sku, p.list_price, p.category_name, p.parent_category_name,
       p.model_name, p.desc_en AS model_description,
       c.name AS customer_name, c.company,
       sa.full_address AS shipment_address, sa.city AS shipment_city, sa.state AS shipment_state,
       sa.country AS shipment_country, sa.postcode AS shipment_postcode,
       ba.full_address AS billing_address, ba.city AS billing_city, ba.state AS billing_state,
       ba.country AS billing_country, ba.postcode AS billing_postcode
FROM salesorderheader h
JOIN salesorderdetail d ON h.SalesOrderID = d.SalesOrderID
LEFT JOIN products p ON d.ProductID = p.ProductID
LEFT JOIN customers c ON h.CustomerID = c.CustomerID
LEFT JOIN addresses sa ON h.ShipToAddressID = sa.AddressID
LEFT JOIN addresses ba ON h.BillToAddressID = ba.AddressID""",
    "fk_full_outer_single": _with(_RECONCILE_CTES) + "\n"
    + _foj_missing("sales_order_header", "snap_h", "now_h", ["SalesOrderID"]),
    "fk_full_outer_composite": _with(_RECONCILE_CTES) + "\n"
    + _foj_missing("sales_order_detail", "snap_d", "now_d", ["SalesOrderID", "SalesOrderDetailID"]),
    "validation_keys": _with(_RECONCILE_CTES) + "\nSELECT table_name, pk, max(missing_in) AS missing_in FROM ("
    + "\n UNION \n".join(_foj_missing(t, c, s_, list(k)) for t, c, s_, k in RECONCILED)
    + "\n) u GROUP BY table_name, pk",
    "validation_totals": _with(_RECONCILE_CTES) + "\nSELECT *, source_count = bronze_count AS totals_do_match FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {s_}) AS source_count, (SELECT count(*) FROM {c}) AS bronze_count"
        for t, c, s_, _ in RECONCILED
    ) + ") t",
    "validation_gate": _with(
        f"snap_h AS ({_HDR_SNAPSHOT})",
        f"snap_d AS ({_DET_SNAPSHOT})",
        "copy_h AS (SELECT * FROM snap_h WHERE SalesOrderID NOT IN (SELECT SalesOrderID FROM salesorderheader "
        "WHERE ModifiedDate > (SELECT max(ModifiedDate) FROM snap_h)) "
        "UNION ALL SELECT * FROM salesorderheader WHERE ModifiedDate > (SELECT max(ModifiedDate) FROM snap_h))",
        "copy_d AS (SELECT s.* FROM snap_d s WHERE NOT EXISTS (SELECT 1 FROM salesorderdetail_unique u "
        "WHERE u.ModifiedDate > (SELECT max(ModifiedDate) FROM snap_d) AND u.SalesOrderID = s.SalesOrderID "
        "AND u.SalesOrderDetailID = s.SalesOrderDetailID) "
        "UNION ALL SELECT * FROM salesorderdetail_unique WHERE ModifiedDate > (SELECT max(ModifiedDate) FROM snap_d))",
        """totals AS (
    SELECT (SELECT count(*) FROM copy_h) = (SELECT count(*) FROM salesorderheader) AS ok
    UNION ALL SELECT (SELECT count(*) FROM copy_d) = (SELECT count(*) FROM salesorderdetail_unique)
    UNION ALL SELECT (SELECT count(*) FROM customer) = (SELECT count(*) FROM customer))""",
    ) + """
SELECT CASE WHEN bool_and(ok) THEN 'SUCCESS' ELSE error('counts differ') END AS status
FROM totals""",
}


# the tables written must hold what the frames do
ORACLE_SQL["table_upsert_single"] = ORACLE_SQL["ingest_two_runs"] = ORACLE_SQL["upsert_single_key"]
ORACLE_SQL["table_upsert_composite"] = ORACLE_SQL["upsert_composite_key"]
ORACLE_SQL["table_upsert_surrogate"] = (
    f"SELECT *, {_sha('SalesOrderID')} AS id FROM (" + ORACLE_SQL["upsert_single_key"] + ")"
)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end-to-end query: silver (nested orders, dimensions) to the gold report."""
    return q_orders_flattened(spark, sf_dir)


__all__ = ["CTX", "ORACLE_SQL", "QUERIES", "flagship"]
