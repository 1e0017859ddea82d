"""Every named query: how Spark builds it and, where SQL can say it, the check."""

from functools import partial

from spendgrid.params import SMALL_DATA
from spendgrid.plans import queries_core, queries_more, queries_reports  # noqa: F401  (fill the registry)
from spendgrid.plans.oracle import sql_for
from spendgrid.plans.registry import QUERIES
from spendgrid.plans.warehouse import Warehouse
from spendgrid.sources.order_tables import raw_tables


def warehouse(spark, folder, modelled=False, params=SMALL_DATA):
    return Warehouse(spark, folder, lambda: raw_tables(spark, folder), params, modelled)


def run(name, spark, folder):
    query = QUERIES[name]
    w = warehouse(spark, folder, query.modelled)
    return w.finished(query.build(w))


def spark_queries():
    return {name: partial(run, name) for name in QUERIES}


def oracle_queries():
    return {name: sql_for(query.sql) for name, query in QUERIES.items() if query.sql}
