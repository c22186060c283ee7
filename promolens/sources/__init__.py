from promolens.sources.readers import (
    Clustering,
    drop_tables,
    read_json,
    read_table,
    replace_table,
    scratch_dir,
    table_versions,
    write_tables,
)
from promolens.sources.schemas import EVENT_SCHEMA, OFFER_SCHEMA, PROFILE_SCHEMA

__all__ = [
    "Clustering",
    "EVENT_SCHEMA",
    "OFFER_SCHEMA",
    "PROFILE_SCHEMA",
    "drop_tables",
    "read_json",
    "read_table",
    "replace_table",
    "scratch_dir",
    "table_versions",
    "write_tables",
]
