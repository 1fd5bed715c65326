"""Tenant views bound by the SQL session: a session variable, a scalar function over it, and views that use the function."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from screenmart.catalog import Catalog

VARIABLE = "app_white_label_id"
FUNCTION = "current_white_label_id"
#: Prefix of the views that hold all tenants' rows. Who may name them is the business of the catalog's permissions.
WHOLE = "all_tenants_"


def declare_tenant(spark: SparkSession) -> None:
    """Declare the variable, unset, and the function: the tenant id, NULL where the variable is unset or blank.

    The function is one SQL expression, so the optimizer folds it to a literal: a view's condition prunes
    tenant partitions. A value that is no number is an error, not another tenant.
    """
    spark.sql(f"DECLARE OR REPLACE VARIABLE {VARIABLE} STRING")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {FUNCTION}() RETURNS INT RETURN CAST(nullif(btrim({VARIABLE}), '') AS INT)")


def set_tenant(spark: SparkSession, value: str | None) -> None:
    """The tenant that queries analysed from now on see; a DataFrame made before keeps the one of its time."""
    spark.sql(f"SET VAR {VARIABLE} = :value", args={"value": value}) if value is not None else spark.sql(f"SET VAR {VARIABLE} = NULL")


def register_tenant_views(catalog: Catalog, names: Iterable[str], column: str = "white_label_id") -> None:
    """Views named like the datasets that show the session's tenant alone; without a tenant, no rows.

    Datasets without a tenant column are shown as they are.
    """
    for name in names:
        df = catalog[name]
        if column not in df.columns:
            df.createOrReplaceTempView(name)
            continue
        df.createOrReplaceTempView(f"{WHOLE}{name}")
        # As text, so that each use of the view reads the variable anew.
        catalog.spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {WHOLE}{name} WHERE {column} = {FUNCTION}()")
