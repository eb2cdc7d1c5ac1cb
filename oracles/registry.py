"""All DuckDB texts by query name."""

from oracles import analysis, business
from oracles.tables import with_tables


def texts() -> dict[str, str]:
    bodies = {**business.TEXTS, **analysis.TEXTS}
    bodies["g03_history_function"] = bodies["q37_customer_history"]
    return {name: with_tables(body) for name, body in bodies.items()}
