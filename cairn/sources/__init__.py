"""Sources, seeds, sinks and table inspection."""

from cairn.sources.inspect import describe, list_tables, sample, table_overview
from cairn.sources.readers import (
    entity_descriptions,
    load_catalog_dir,
    load_seed,
    load_source,
    register_views,
)
from cairn.sources.sinks import export, materialize, store_clustered, store_partitions

__all__ = ["describe", "entity_descriptions", "export", "list_tables",
           "load_catalog_dir", "load_seed", "load_source", "materialize", "register_views", "sample",
           "store_clustered", "store_partitions", "table_overview"]
