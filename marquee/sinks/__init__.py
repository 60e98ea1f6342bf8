"""Writers and catalogue commands."""

from marquee.sinks.catalogue import (
    create_country_table,
    create_database,
    load_countries,
    register_staging,
    register_tables,
)
from marquee.sinks.files import published_path, table_path, write_staging, write_table

__all__ = [
    "create_country_table",
    "create_database",
    "load_countries",
    "published_path",
    "register_staging",
    "register_tables",
    "table_path",
    "write_staging",
    "write_table",
]
