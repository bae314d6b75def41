"""Declared schemas: payload records as they land, and warehouse tables with their keys."""

from waybill.schemas.tables import TABLES, WAITING, Table, table

__all__ = ["TABLES", "WAITING", "Table", "table"]
