"""lakeshore: layered retail pipelines (bronze / silver / gold) on PySpark."""

from lakeshore.context import PipelineContext
from lakeshore.specs import ERP_TABLES, DatasetSpec

__all__ = ["ERP_TABLES", "DatasetSpec", "PipelineContext"]
__version__ = "0.1.0"
