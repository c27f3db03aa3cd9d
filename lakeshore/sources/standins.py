"""The ten ERP source tables, derived from the driver's parquet tables.

The studied pipeline replicates an external order-management database. The
test data is TPC-H shaped, so each ERP table is defined as a projection of it
(see FIXTURES.md section 2). Every stand-in reads its whole input table; only
the columns it uses are read (column pruning reaches the parquet scan, so the
large ``documents.text`` column is never read).

Each stand-in exists twice, as a Spark DataFrame and as SQL text, so the DuckDB
oracle queries see exactly the same source rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Constant stamps of tables without a modification time, and the
# number of categories / models the product keys are spread over.
CONSTANT_STAMP = "2000-01-01 00:00:00"
SELL_START = "1995-01-01 00:00:00"
SELL_END = "2001-06-30 00:00:00"
N_CATEGORIES = 30
N_MODELS = 60
N_DESCRIBED_MODELS = 50
N_ADDRESSES = 30

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's (read-only) tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _null(type_name: str):
    return F.lit(None).cast(type_name)


def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    return j.select(
        F.col("n_nationkey").alias("AddressID"),
        F.col("n_name").alias("AddressLine1"),
        F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name")).alias("AddressLine2"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("StateProvince"),
        F.col("r_name").alias("CountryRegion"),
        (F.lit(10000) + F.col("n_nationkey")).cast("string").alias("PostalCode"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("CustomerID"),
        F.when(F.col("c_acctbal") < 0, F.lit("Ms.")).otherwise(F.lit("Mr.")).alias("Title"),
        F.col("c_name").alias("FirstName"),
        _null("string").alias("MiddleName"),
        F.col("c_mktsegment").alias("LastName"),
        _null("string").alias("Suffix"),
        F.col("c_mktsegment").alias("CompanyName"),
        F.concat(F.lit("rep"), F.col("c_nationkey").cast("string")).alias("SalesPerson"),
        F.concat(F.col("c_name"), F.lit("@mail.test")).alias("EmailAddress"),
        F.concat(F.lit("ph"), F.col("c_custkey").cast("string")).alias("Phone"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )


def customeraddress(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_nationkey").alias("AddressID"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("ProductNumber"),
        F.col("p_type").alias("Color"),
        (F.col("p_retailprice") * F.lit(0.75)).alias("StandardCost"),
        F.col("p_retailprice").alias("ListPrice"),
        F.col("p_size").cast("string").alias("Size"),
        F.col("p_size").cast("double").alias("Weight"),
        (F.col("p_partkey") % N_CATEGORIES).alias("ProductCategoryID"),
        (F.col("p_partkey") % N_MODELS).alias("ProductModelID"),
        _ts(SELL_START).alias("SellStartDate"),
        F.when(F.col("p_size") > 45, _ts(SELL_END)).alias("SellEndDate"),
        _null("timestamp_ntz").alias("DiscontinuedDate"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )


def productcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    child = n.select(
        F.col("n_nationkey").alias("ProductCategoryID"),
        (F.lit(100) + F.col("n_regionkey")).alias("ParentProductCategoryID"),
        F.col("n_name").alias("Name"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )
    root = r.select(
        (F.lit(100) + F.col("r_regionkey")).alias("ProductCategoryID"),
        _null("int").alias("ParentProductCategoryID"),
        F.col("r_name").alias("Name"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )
    return child.unionByName(root)


def productmodel(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("ProductModelID"),
        F.col("s_name").alias("Name"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )


def productdescription(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("ProductDescriptionID"),
        F.col("source").alias("Description"),
        _ts(CONSTANT_STAMP).alias("ModifiedDate"),
    )


def productmodelproductdescription(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return (
        d.select((F.col("doc_id") % N_DESCRIBED_MODELS).alias("ProductModelID"), "lang", "doc_id")
        .groupBy("ProductModelID", F.col("lang").alias("Culture"))
        .agg(F.min("doc_id").alias("ProductDescriptionID"))
        .select(
            "ProductModelID", "ProductDescriptionID", "Culture", _ts(CONSTANT_STAMP).alias("ModifiedDate")
        )
    )


def salesorderheader(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("SalesOrderID"),
        (F.col("o_custkey") % 5).alias("RevisionNumber"),
        F.col("o_orderdate").alias("OrderDate"),
        (F.col("o_orderdate") + F.expr("INTERVAL 12 DAYS")).alias("DueDate"),
        (F.col("o_orderdate") + F.expr("INTERVAL 5 DAYS")).alias("ShipDate"),
        F.col("o_orderstatus").alias("Status"),
        (F.col("o_orderkey") % 2 == 0).alias("OnlineOrderFlag"),
        F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("SalesOrderNumber"),
        F.concat(F.lit("PO"), F.col("o_custkey").cast("string")).alias("PurchaseOrderNumber"),
        F.col("o_orderpriority").alias("AccountNumber"),
        F.col("o_custkey").alias("CustomerID"),
        F.nullif(F.col("o_custkey") % N_ADDRESSES, F.lit(N_ADDRESSES - 1)).alias("ShipToAddressID"),
        ((F.col("o_custkey") + 7) % N_ADDRESSES).alias("BillToAddressID"),
        F.col("o_orderpriority").alias("ShipMethod"),
        F.col("o_orderdate").alias("ModifiedDate"),
    )


def salesorderdetail(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_quantity").alias("OrderQty"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_extendedprice").alias("UnitPrice"),
        F.col("l_discount").alias("UnitPriceDiscount"),
        F.col("l_shipdate").alias("ModifiedDate"),
    )


def salesorderdetail_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines made unique on (SalesOrderID, SalesOrderDetailID).

    In the test data the pair repeats; a composite-key upsert needs it unique.
    """
    det = salesorderdetail(spark, sf_dir)
    return det.groupBy("SalesOrderID", "SalesOrderDetailID").agg(
        F.sum("OrderQty").alias("OrderQty"),
        F.min("ProductID").alias("ProductID"),
        F.max("UnitPrice").alias("UnitPrice"),
        F.max("UnitPriceDiscount").alias("UnitPriceDiscount"),
        F.max("ModifiedDate").alias("ModifiedDate"),
    )


BUILDERS = {
    "address": address,
    "customer": customer,
    "customeraddress": customeraddress,
    "product": product,
    "productcategory": productcategory,
    "productdescription": productdescription,
    "productmodel": productmodel,
    "productmodelproductdescription": productmodelproductdescription,
    "salesorderdetail": salesorderdetail,
    "salesorderheader": salesorderheader,
}


def erp_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """Source tables keyed by source table name (all ten, or ``names``)."""
    names = names or list(BUILDERS)
    return {name: BUILDERS[name](spark, sf_dir) for name in names}


# ---------------------------------------------------------------------------
# The same stand-ins as SQL (DuckDB dialect) over the driver's views.
# ---------------------------------------------------------------------------

STANDIN_SQL = {
    "address": f"""
        SELECT n_nationkey AS AddressID, n_name AS AddressLine1,
               CASE WHEN n_nationkey % 2 = 0 THEN r_name END AS AddressLine2,
               n_name AS City, r_name AS StateProvince, r_name AS CountryRegion,
               CAST(10000 + n_nationkey AS VARCHAR) AS PostalCode,
               TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customer": f"""
        SELECT c_custkey AS CustomerID,
               CASE WHEN c_acctbal < 0 THEN 'Ms.' ELSE 'Mr.' END AS Title,
               c_name AS FirstName, CAST(NULL AS VARCHAR) AS MiddleName,
               c_mktsegment AS LastName, CAST(NULL AS VARCHAR) AS Suffix,
               c_mktsegment AS CompanyName,
               'rep' || CAST(c_nationkey AS VARCHAR) AS SalesPerson,
               c_name || '@mail.test' AS EmailAddress,
               'ph' || CAST(c_custkey AS VARCHAR) AS Phone,
               TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM customer""",
    "customeraddress": f"""
        SELECT c_custkey AS CustomerID, c_nationkey AS AddressID,
               TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM customer""",
    "product": f"""
        SELECT p_partkey AS ProductID, p_name AS Name, p_brand AS ProductNumber,
               p_type AS Color, p_retailprice * 0.75 AS StandardCost,
               p_retailprice AS ListPrice, CAST(p_size AS VARCHAR) AS Size,
               CAST(p_size AS DOUBLE) AS Weight,
               p_partkey % {N_CATEGORIES} AS ProductCategoryID,
               p_partkey % {N_MODELS} AS ProductModelID,
               TIMESTAMP '{SELL_START}' AS SellStartDate,
               CASE WHEN p_size > 45 THEN TIMESTAMP '{SELL_END}' END AS SellEndDate,
               CAST(NULL AS TIMESTAMP) AS DiscontinuedDate,
               TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM part""",
    "productcategory": f"""
        SELECT n_nationkey AS ProductCategoryID, 100 + n_regionkey AS ParentProductCategoryID,
               n_name AS Name, TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM nation
        UNION ALL
        SELECT 100 + r_regionkey, CAST(NULL AS INTEGER), r_name, TIMESTAMP '{CONSTANT_STAMP}'
        FROM region""",
    "productmodel": f"""
        SELECT s_suppkey AS ProductModelID, s_name AS Name,
               TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM supplier""",
    "productdescription": f"""
        SELECT doc_id AS ProductDescriptionID, source AS Description,
               TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM documents""",
    "productmodelproductdescription": f"""
        SELECT doc_id % {N_DESCRIBED_MODELS} AS ProductModelID, min(doc_id) AS ProductDescriptionID,
               lang AS Culture, TIMESTAMP '{CONSTANT_STAMP}' AS ModifiedDate
        FROM documents GROUP BY doc_id % {N_DESCRIBED_MODELS}, lang""",
    "salesorderheader": f"""
        SELECT o_orderkey AS SalesOrderID, o_custkey % 5 AS RevisionNumber,
               o_orderdate AS OrderDate, o_orderdate + INTERVAL 12 DAY AS DueDate,
               o_orderdate + INTERVAL 5 DAY AS ShipDate, o_orderstatus AS Status,
               o_orderkey % 2 = 0 AS OnlineOrderFlag,
               'SO' || CAST(o_orderkey AS VARCHAR) AS SalesOrderNumber,
               'PO' || CAST(o_custkey AS VARCHAR) AS PurchaseOrderNumber,
               o_orderpriority AS AccountNumber, o_custkey AS CustomerID,
               NULLIF(o_custkey % {N_ADDRESSES}, {N_ADDRESSES - 1}) AS ShipToAddressID,
               (o_custkey + 7) % {N_ADDRESSES} AS BillToAddressID,
               o_orderpriority AS ShipMethod, o_orderdate AS ModifiedDate
        FROM orders""",
    "salesorderdetail": """
        SELECT l_orderkey AS SalesOrderID, l_linenumber AS SalesOrderDetailID,
               l_quantity AS OrderQty, l_partkey AS ProductID,
               l_extendedprice AS UnitPrice, l_discount AS UnitPriceDiscount,
               l_shipdate AS ModifiedDate
        FROM lineitem""",
    "salesorderdetail_unique": """
        SELECT l_orderkey AS SalesOrderID, l_linenumber AS SalesOrderDetailID,
               sum(l_quantity) AS OrderQty, min(l_partkey) AS ProductID,
               max(l_extendedprice) AS UnitPrice, max(l_discount) AS UnitPriceDiscount,
               max(l_shipdate) AS ModifiedDate
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
}


def standin_ctes(*names: str) -> str:
    """``WITH name AS (...), ...`` for the requested stand-ins (SQL side)."""
    return "WITH " + ",\n".join(f"{n} AS ({STANDIN_SQL[n]})" for n in names)
