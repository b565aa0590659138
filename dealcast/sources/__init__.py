from dealcast.sources.tables import TABLES, load_table, load_tables  # noqa: F401
