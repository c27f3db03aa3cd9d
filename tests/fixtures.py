"""Hand-written ten-table source (FIXTURES.md section 1), in two batches.

Batch 2 is the source after a round of changes: a changed row, a new row, an
unchanged row, a row stamped exactly at the mark of batch 1 (missed by design),
a row with a NULL stamp and one stamped at the epoch (never loaded), and a
row deleted at the source (stays in bronze, reported by the key check).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

EPOCH = dt.datetime(1970, 1, 1)
T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
T1 = dt.datetime(2024, 1, 2, 9, 30, 0)  # max stamp of batch 1 = mark after it
T2 = dt.datetime(2024, 2, 1, 12, 0, 0)
SELL = dt.datetime(2020, 5, 1)

SCHEMAS = {
    "address": "AddressID int, AddressLine1 string, AddressLine2 string, City string, "
    "StateProvince string, CountryRegion string, PostalCode string, ModifiedDate timestamp",
    "customer": "CustomerID int, Title string, FirstName string, MiddleName string, LastName string, "
    "Suffix string, CompanyName string, SalesPerson string, EmailAddress string, Phone string, "
    "ModifiedDate timestamp",
    "customeraddress": "CustomerID int, AddressID int, ModifiedDate timestamp",
    "product": "ProductID int, Name string, ProductNumber string, Color string, "
    "StandardCost decimal(19,4), ListPrice decimal(19,4), Size string, Weight decimal(8,2), "
    "ProductCategoryID int, ProductModelID int, SellStartDate timestamp, SellEndDate timestamp, "
    "DiscontinuedDate timestamp, ModifiedDate timestamp",
    "productcategory": "ProductCategoryID int, ParentProductCategoryID int, Name string, ModifiedDate timestamp",
    "productmodel": "ProductModelID int, Name string, ModifiedDate timestamp",
    "productdescription": "ProductDescriptionID int, Description string, ModifiedDate timestamp",
    "productmodelproductdescription": "ProductModelID int, ProductDescriptionID int, Culture string, "
    "ModifiedDate timestamp",
    "salesorderheader": "SalesOrderID int, RevisionNumber int, OrderDate timestamp, DueDate timestamp, "
    "ShipDate timestamp, Status int, OnlineOrderFlag boolean, SalesOrderNumber string, "
    "PurchaseOrderNumber string, AccountNumber string, CustomerID int, ShipToAddressID int, "
    "BillToAddressID int, ShipMethod string, ModifiedDate timestamp",
    "salesorderdetail": "SalesOrderID int, SalesOrderDetailID int, OrderQty int, ProductID int, "
    "UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), ModifiedDate timestamp",
}

D = Decimal

BATCH1 = {
    "address": [
        (1, "1 Main St", "Apt 2", "Seattle", "WA", "US", "98101", T0),
        (2, "2 Oak Ave", None, "Portland", "OR", "US", "97201", T0),
        (3, None, "Suite 9", "Austin", "TX", "US", "73301", T1),
        (4, "4 Pine Rd", None, "Denver", "CO", "US", "80201", None),
        (5, "5 Elm St", None, "Boston", "MA", "US", "02101", EPOCH),
    ],
    "customer": [
        (1, "Mr.", "John", "Q", "Public", None, "Acme Bikes", "rep-01", "john@mail.test", "555-0100", T0),
        (2, "Ms.", "Jane", None, "Doe", "Jr.", "Beta Cycles", "rep-02", "jane@mail.test", "555-0101", T0),
    ],
    "customeraddress": [(1, 12, T0), (11, 2, T0), (2, 2, T0)],
    "product": [
        (680, "Road Frame 58", "FR-58-BK", "Black", D("1059.3100"), D("1431.5000"), "58", D("1016.04"),
         18, 6, SELL, None, None, T0),
        (706, "Sport Helmet", "HM-100-R", "Red", D("13.0863"), D("34.9900"), None, None,
         None, 33, SELL, dt.datetime(2022, 1, 1), None, T0),
        (707, "Racing Socks", "SK-200-M", None, D("3.3963"), D("8.9900"), "M", None,
         3, 35, SELL, None, dt.datetime(2023, 6, 30), T0),
        (708, "Touring Tire", "TR-300", None, D("9.3463"), D("28.9900"), None, None,
         41, 36, SELL, None, None, T0),
    ],
    "productcategory": [
        (18, 3, "Road Frames", T0),
        (3, None, "Components", T0),
        (41, 77, "Tires", T0),
    ],
    "productmodel": [(6, "Road Frame 58", T0), (33, "Helmet One", T0), (35, "Racing Socks", T0), (36, "Touring Tire", T0)],
    "productdescription": [(1, "Light frame", T0), (2, "Cadre léger", T0), (3, None, T0)],
    "productmodelproductdescription": [
        (6, 1, "en", T0), (6, 2, "fr", T0), (33, 3, "en", T0), (36, 2, "fr", T0),
    ],
    "salesorderheader": [
        (5001, 2, T0, T0 + dt.timedelta(days=12), T0 + dt.timedelta(days=7), 5, False, "SO5001",
         "PO-1001", "AC-0001", 1, 1, 2, "FREIGHT", T0),
        (5002, 2, T0, T0 + dt.timedelta(days=12), T0 + dt.timedelta(days=7), 5, True, "SO5002",
         "PO-1002", "AC-0002", 2, None, 2, "FREIGHT", T0),
        (5003, 1, T0, None, None, 1, False, "SO5003", None, "AC-0003", 1, 1, 1, "OVERNIGHT", T0),
    ],
    "salesorderdetail": [
        (5001, 9001, 1, 680, D("356.8980"), D("0.0000"), T0),
        (5001, 9002, 2, 999, D("63.9000"), D("0.1000"), T0),
        (5002, 9004, 1, 706, D("20.9940"), D("0.0000"), T0),
        (5999, 9005, 1, 707, D("8.9900"), D("0.0000"), T0),
    ],
}


def _replace(rows, key_index, key, new_row):
    return [new_row if r[key_index] == key else r for r in rows]


BATCH2 = {name: list(rs) for name, rs in BATCH1.items()}
# changed row
BATCH2["address"] = _replace(
    BATCH2["address"], 0, 1, (1, "1 Main St", "Apt 3", "Seattle", "WA", "US", "98101", T2)
)
# deleted at the source: address 3 (stays in bronze, reported by the key check)
BATCH2["address"] = [r for r in BATCH2["address"] if r[0] != 3]
# new row, and a late row stamped exactly at the mark of batch 1 (missed)
BATCH2["address"] += [
    (6, "6 Bay Rd", None, "Miami", "FL", "US", "33101", T2),
    (7, "7 Late Ln", None, "Tampa", "FL", "US", "33601", T1),
]
# changed order header and a changed line of another order (the line alone
# does not refresh the silver order: the header stamp drives)
BATCH2["salesorderheader"] = _replace(
    BATCH2["salesorderheader"], 0, 5001,
    (5001, 3, T0, T0 + dt.timedelta(days=12), T0 + dt.timedelta(days=8), 5, False, "SO5001",
     "PO-1001", "AC-0001", 1, 1, 2, "FREIGHT", T2),
)
BATCH2["salesorderdetail"] = BATCH2["salesorderdetail"] + [
    (5001, 9003, 4, 707, D("8.9900"), D("0.0000"), T2),
]


def frames(spark, batch):
    return {name: spark.createDataFrame(rs, SCHEMAS[name]) for name, rs in batch.items()}
