"""Reading landing files and reference data, writing layer tables."""

from .landing import ingest_transactions, read_transactions_csv, to_bronze, with_provenance
from .reference_data import accounting_from_rows, customers_from_rows, read_accounting_csv
from .tables import LAYERS, create_layers, with_lineage, write_table

__all__ = [
    "LAYERS",
    "accounting_from_rows",
    "create_layers",
    "customers_from_rows",
    "ingest_transactions",
    "read_accounting_csv",
    "read_transactions_csv",
    "to_bronze",
    "with_lineage",
    "with_provenance",
    "write_table",
]
