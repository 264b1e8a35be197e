"""Sources and sinks: driver tables, the canonical sales adapter, stage I/O."""

from demandops.sources.tables import read_table, maybe_broadcast, fits_broadcast  # noqa: F401
from demandops.sources.adapter import sales_fact, sales_raw, product_dim  # noqa: F401
from demandops.sources.io import (  # noqa: F401
    load_sales, load_stage, write_stage, profile_sales, SALES_SCHEMA,
)
