from starmill.sources.shared import Scratch, fresh_dir, shared_dir
from starmill.sources.store import Store
from starmill.sources.tables import OpenOnUse, read_table, read_tables

__all__ = ["OpenOnUse", "Scratch", "Store", "fresh_dir", "read_table", "read_tables", "shared_dir"]
