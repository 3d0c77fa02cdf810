from quarry.sources.readers import (  # noqa: F401
    DRIVER_TABLES,
    json_schema,
    read_catalog_table,
    read_csv,
    read_json,
    read_json_inferred,
    read_lines,
    read_stream,
    read_table,
    register_tables,
    rows,
    table,
)
