"""Names of layers, databases, tables and raw folders."""

from __future__ import annotations

from dataclasses import dataclass

# The four layers in the order records move through them.
LAYERS = ("raw", "bronze", "silver", "gold")

# A layer run reads one layer and writes the next; both namespaces must exist.
LAYERS_OF_RUN = {
    "bronze": ("raw", "bronze"),
    "silver": ("bronze", "silver"),
    "gold": ("silver", "gold"),
}

SESSION_CATALOG = "spark_catalog"


def quote(identifier: str) -> str:
    """Back-quote one identifier part for use in SQL text."""
    return "`" + identifier.replace("`", "``") + "`"


@dataclass(frozen=True)
class TableRef:
    """Catalog, database and table; ``sql`` is the quoted three-part name."""

    database: str
    table: str
    catalog: str = SESSION_CATALOG

    @property
    def sql(self) -> str:
        return ".".join(quote(part) for part in (self.catalog, self.database, self.table))

    @property
    def database_sql(self) -> str:
        return f"{quote(self.catalog)}.{quote(self.database)}"


def layer_table(source: str, entity: str, layer: str) -> str:
    """``{source}_{entity}_{layer}``, the table name every layer uses by default."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return f"{source}_{entity}_{layer}"


def layer_database(layer: str) -> str:
    """``{layer}_zone``, the database name every layer uses by default."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return f"{layer}_zone"


def raw_folder(raw_root: str, source: str, entity: str) -> str:
    """Folder that holds the landed JSON Lines of one entity."""
    return f"{raw_root.rstrip('/')}/{source}/{entity}/"
