from docket.sources.tables import TABLE_SCHEMAS, read_table, tables  # noqa: F401
