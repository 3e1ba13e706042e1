from quillframe.sources.artifacts import (
    discard,
    load_model,
    materialize,
    save_model,
    save_run_metadata,
    save_table,
    shared_path,
)
from quillframe.sources.tables import SCHEMAS, load_table

__all__ = [
    "SCHEMAS",
    "discard",
    "load_model",
    "load_table",
    "materialize",
    "save_model",
    "save_run_metadata",
    "save_table",
    "shared_path",
]
