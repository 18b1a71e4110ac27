"""Registry of the 100 declared tables."""

from switchboard.schemas import dm, ods, staging
from switchboard.schemas.table import Table

LAYERS: dict[str, list[Table]] = {"staging": staging.TABLES, "ods": ods.TABLES, "dm": dm.TABLES}
TABLES: dict[str, Table] = {t.name: t for tables in LAYERS.values() for t in tables}


def layer_of(name: str) -> str:
    return next(layer for layer, tables in LAYERS.items() if any(t.name == name for t in tables))


def conform(df, name: str):
    """Project ``df`` to the declared schema of table ``name``."""
    return TABLES[name].conform(df)


__all__ = ["LAYERS", "TABLES", "Table", "conform", "layer_of"]
