"""DuckDB SQL for every query that has an SQL form."""

from oracles import (
    changes,
    core,
    extended,
    features,
    gold,
    lakehouse,
    layers,
    reports,
    scripts,
    storage,
)
from shopgrain.plans.analyses import ANALYSES

_AREAS = (storage, layers, changes, gold, core, scripts, extended, lakehouse, reports, features)

ORACLES = {name: sql for area in _AREAS for name, sql in area.ORACLE.items()}

ORACLES["run_named"] = ORACLES["top_customers"]
# All analyses; the one whose query gives a row for each cell has one for each category itself.
_ROWS = {"pivot_country": "count(DISTINCT category)"}
ORACLES["run_all"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS name, {_ROWS.get(name, 'count(*)')} AS n FROM (\n{ORACLES[name]}\n)" for name in ANALYSES
)
