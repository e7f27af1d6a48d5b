from datetime import datetime

from dialtide.schemas import RAW_CDR

DEFAULTS = {
    "call_id": "c1",
    "customer_id": "CUST000001",
    "call_time": datetime(2024, 1, 3, 12, 0, 0),
    "call_duration_seconds": 60,
    "call_type": "VOICE",
    "destination_number": "+15550000000",
    "network_type": "4G",
    "cell_tower_id": "TOWER0001",
    "call_result": "COMPLETED",
    "call_charge": 1.0,
    "promotion_code": "NONE",
}


def calls(spark, *rows):
    """Call records, each given as changes to :data:`DEFAULTS`."""
    full = [{**DEFAULTS, "call_id": f"c{i}", **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f.name] for f in RAW_CDR.fields) for r in full], RAW_CDR)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles of a plan that has not run yet."""
    return plan_text(df).count("Exchange hashpartitioning") + plan_text(df).count("Exchange rangepartitioning")


__all__ = ["calls", "exchanges", "plan_text", "rows_of"]
