"""Published models: each a catalog view or table that any session can read by its name.

The staging model is a view over the Silver sales table; the marts are tables,
created or replaced through a fresh folder (``sinks.replace_table``), so readers
see the rows of one build or of the next, never part of one.
"""

from __future__ import annotations

from typing import NamedTuple

from strata.plans.lakehouse import Lakehouse
from strata.sources.sinks import register_external_table, replace_table


class Model(NamedTuple):
    kind: str  # view or table
    source: str  # the Silver table that a view selects from, or the mart that a table holds
    select: str = ""


# The staging model's columns, in order.
_STAGING = ("customer_name, city, country, latitude, longitude, channel, sub_channel, product_name, product_class, "
            "quantity, price, sales, month, year, distributor, name_of_sales_rep AS sales_rep, manager, sales_team")

#: name -> how it is materialised; marts of model outputs come from the written predictions and segments
MODELS = {
    "stg_sales": Model("view", "silver_sales", _STAGING),
    "mart_product_performance": Model("table", "mart_product_performance"),
    "mart_sales_rep_performance": Model("table", "mart_sales_rep_performance"),
    "mart_geographic_analysis": Model("table", "mart_geographic_analysis"),
    "mart_cluster_analysis": Model("table", "mart_cluster_analysis_kmeans"),
    "mart_forecast_analysis": Model("table", "mart_forecast_analysis_gbt"),
}
#: the deterministic stand-ins that SQL can check
STAND_INS = MODELS | {name: Model("table", name) for name in ("mart_cluster_analysis", "mart_forecast_analysis")}


def materialise_models(lh: Lakehouse, names: list[str] | None = None, prefix: str = "", models: dict[str, Model] = MODELS) -> dict[str, str]:
    """Create or replace the models in the session's catalog; returns model -> catalog name.

    Tables lie below the lakehouse's folder.  A view reads a registered Silver
    table, so it follows that table and needs no session that knows a temp view.
    """
    out = {}
    for name in names or list(models):
        model = models[name]
        out[name] = prefix + name
        if model.kind == "view":
            getattr(lh, model.source)()
            lh.spark.sql(f"DROP TABLE IF EXISTS {prefix}{model.source}")
            source = register_external_table(lh.spark, prefix + model.source, lh.path(model.source))
            lh.spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS SELECT {model.select} FROM {source}")
        else:
            replace_table(lh.mart(model.source), prefix + name, lh.path("models"))
    return out
