"""Film-knowledge analytics on Spark DataFrames."""

from celluloid.schema import TABLES, table_schema
from celluloid.session import build_session, scratch_path
from celluloid.sources.warehouse import Tables, Warehouse

__all__ = ["TABLES", "Tables", "Warehouse", "build_session", "scratch_path", "table_schema"]
