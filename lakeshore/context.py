"""Names and parameters of one deployment (company x environment).

The reference spreads these over notebook widgets and ``{{…}}`` templates; here
they are one frozen value passed to every job.
"""

from __future__ import annotations

from dataclasses import dataclass

# Allowed environments and the layer / schema layout.
ENVIRONMENTS = ("dev", "stg", "uat", "prod")
PERSONAS = ("data_engineering", "data_science", "business_intelligence")
SCHEMAS = {
    "bronze_erp": "data_engineering",
    "conformed_dims": "data_engineering",
    "sales_facts": "data_engineering",
    "common_information_model": "business_intelligence",
}


@dataclass(frozen=True)
class PipelineContext:
    """Company and environment, and every name derived from them.

    ``key_sep`` is the text between the source tag and the natural key inside
    the surrogate-key hash: ``"_"`` gives ``sha256("dev_erp_42")`` (the SQL form),
    ``""`` gives ``sha256("dev_erp42")`` (the notebook form).
    """

    company: str = "acme"
    env: str = "dev"
    key_sep: str = "_"
    source_system: str = "erp"

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"env must be one of {ENVIRONMENTS}, got {self.env!r}")
        if not self.company or not self.company.replace("_", "").isalnum():
            raise ValueError(f"company must be a plain identifier, got {self.company!r}")

    # -- source tag ------------------------------------------------------
    @property
    def source_id(self) -> str:
        return f"{self.env}_{self.source_system}"

    @property
    def key_prefix(self) -> str:
        return f"{self.source_id}{self.key_sep}"

    # -- namespaces ------------------------------------------------------
    def catalog(self, persona: str) -> str:
        return f"{self.company}_{self.env}_{persona}"

    @property
    def external_catalog(self) -> str:
        return f"{self.company}_ext_{self.env}_{self.source_system}"

    def database(self, schema: str) -> str:
        """Session-catalog database for ``catalog.schema`` (one level only)."""
        return f"{self.catalog(SCHEMAS[schema])}__{schema}"

    def table(self, schema: str, name: str) -> str:
        return f"{self.database(schema)}.{name}"

    def bronze(self, name: str) -> str:
        return self.table("bronze_erp", name)

    def silver_dim(self, name: str) -> str:
        return self.table("conformed_dims", name)

    def silver_fact(self, name: str) -> str:
        return self.table("sales_facts", name)

    def gold(self, name: str) -> str:
        return self.table("common_information_model", name)

    @property
    def control_db(self) -> str:
        """Holds the committed marks and the run records of the ingest."""
        return self.database("bronze_erp")
