"""Reading a table over JDBC in parallel key ranges."""


def jdbc_options(url, table, schema=None, key=None, bounds=None, partitions=8, fetch_size=50_000, **extra):
    """Options for spark.read.format("jdbc").

    With a numeric key and its bounds the table is read in `partitions` ranges;
    rows outside the bounds fall into the first and last range, so none are lost.
    """
    name = f"{schema}.{table}" if schema else table
    options = {"url": url, "dbtable": name, "fetchsize": str(fetch_size), **extra}
    if key is not None:
        low, high = bounds
        options |= {
            "partitionColumn": key,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_table(spark, url, table, **arguments):
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **arguments)).load()


def existence_query(table, schema):
    """Query that returns a row when the table exists; names are escaped literals."""
    schema, table = schema.replace("'", "''"), table.replace("'", "''")
    return (
        "SELECT 1 AS present FROM INFORMATION_SCHEMA.TABLES "
        f"WHERE TABLE_SCHEMA = '{schema}' AND TABLE_NAME = '{table}'"
    )


def missing_tables(exists, tables):
    """Names for which exists(name) is false, all tested before any work starts."""
    return [table for table in tables if not exists(table)]


def missing_in_catalog(spark, tables):
    return missing_tables(spark.catalog.tableExists, tables)


def missing_over_jdbc(spark, url, schema, tables, **options):
    def exists(table):
        reader = spark.read.format("jdbc").options(url=url, query=existence_query(table, schema), **options)
        return bool(reader.load().take(1))

    return missing_tables(exists, tables)
