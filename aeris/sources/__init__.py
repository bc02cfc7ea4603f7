"""Sources: landed API pages, cell tables, warehouse tables."""

from aeris.sources.cells import read_limit_cells, union_batches
from aeris.sources.landed import (
    measurement_rows,
    page_quarantine,
    page_rows,
    page_warnings,
    parse_documents,
    parse_pages,
    read_countries,
    read_locations,
    read_measurements,
    read_pages,
    read_parameters,
    read_providers,
    split_pages,
    write_pages,
)

__all__ = [
    "measurement_rows",
    "page_quarantine",
    "page_rows",
    "page_warnings",
    "parse_documents",
    "parse_pages",
    "read_countries",
    "read_locations",
    "read_measurements",
    "read_pages",
    "read_parameters",
    "read_providers",
    "split_pages",
    "write_pages",
    "read_limit_cells",
    "union_batches",
]
