"""Sources: the external catalog (JDBC) and the test-data stand-ins."""

from lakeshore.sources.catalog import (
    attach_jdbc_catalog,
    keep_configured,
    list_tables,
    read_table,
)
from lakeshore.sources.standins import STANDIN_SQL, erp_tables, standin_ctes

__all__ = [
    "STANDIN_SQL",
    "attach_jdbc_catalog",
    "erp_tables",
    "keep_configured",
    "list_tables",
    "read_table",
    "standin_ctes",
]
