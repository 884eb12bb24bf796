from lakeward.sources.tables import TableRegistry, read_product, read_table  # noqa: F401
