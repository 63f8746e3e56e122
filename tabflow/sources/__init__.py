from tabflow.sources.tables import load_table, sales, SALES_SQL
from tabflow.sources.scan import load_data, normalize_missing, read_table

__all__ = ["load_table", "sales", "SALES_SQL", "load_data", "normalize_missing", "read_table"]
