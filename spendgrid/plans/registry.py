"""The registry of named queries and the arguments shared by their definitions."""

from dataclasses import dataclass

from spendgrid.plans.oracle import mean, rnd, text

# Arguments of the parameterised reports.
CATEGORY, SECOND_CATEGORY = "Groceries", "Restaurants"
CLIENT, OTHER_CLIENTS = "Supplier#000000007", "%00000_"
IN_CATEGORY = f"CATEGORY_TWO = {text(CATEGORY)}"
OF_CLIENT = f"DESTINATION = {text(CLIENT)}"

RISKY = "churn_risk_level in ('Critical', 'High')"
CHURN_MEAN = rnd(mean("churn_probability", 4) + " * 100::double", 1)


@dataclass(frozen=True)
class Query:
    build: object  # Warehouse -> DataFrame
    sql: str | None = None  # query over the oracle relations
    modelled: bool = False  # fit models instead of the fixed formulas


QUERIES = {}


def add(name, build, sql=None, modelled=False):
    QUERIES[name] = Query(build, sql, modelled)
