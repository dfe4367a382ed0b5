"""Reading inputs and storing results."""

from riskloom.session import small_table  # noqa: F401
from riskloom.sources.tables import (  # noqa: F401
    export_arrays, ingest_csv, preview, read_csv_text, read_params_table, read_table,
    write_json, write_result_csv, write_table,
)
