"""JSON record parsers: raw ``value`` string column -> typed columns.

Each parser is a projection over the input DataFrame (batch or streaming), so it runs
inside the scan's codegen stage. Malformed lines come back as a row of nulls from
``from_json``; ``valid_*`` helpers flag them by a required key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.functions import masking, timefmt

# Records that cannot be parsed keep null fields instead of failing the batch.
JSON_OPTIONS = {"mode": "PERMISSIVE"}


def _parsed(df: DataFrame, schema, value_col: str) -> DataFrame:
    keep = [c for c in df.columns if c != value_col]
    return df.select(*keep, F.from_json(F.col(value_col), schema, JSON_OPTIONS).alias("_j")) \
             .select(*keep, "_j.*")


def parse_startup(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Startup log JSON -> the 11 DAU columns (``log_date``/``log_hour`` derived from ``ts``)."""
    out = _parsed(df, schemas.STARTUP_SCHEMA, value_col)
    return (out.withColumn("log_date", timefmt.log_date("ts"))
               .withColumn("log_hour", timefmt.log_hour("ts")))


def parse_event(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Event log JSON -> event record. Numeric ``itemid``/``pgid``/``npgid`` become strings."""
    out = _parsed(df, schemas.EVENT_SCHEMA, value_col)
    return (out.withColumn("log_date", timefmt.log_date("ts"))
               .withColumn("log_hour", timefmt.log_hour("ts")))


def parse_order(df: DataFrame, value_col: str = "value", mask=masking.mask_tel_tail) -> DataFrame:
    """Order JSON (all values quoted) -> 20-column order row.

    ``total_amount`` is cast from its quoted string; ``create_date``/``create_hour`` come
    from splitting ``create_time``; the phone is masked (``mask=None`` keeps it)."""
    out = _parsed(df, schemas.ORDER_SCHEMA, value_col)
    out = (out.withColumn("total_amount", F.col("total_amount").try_cast("double"))
              .withColumn("create_date", timefmt.create_date("create_time"))
              .withColumn("create_hour", timefmt.create_hour("create_time")))
    if mask is not None:
        out = out.withColumn("consignee_tel", mask("consignee_tel"))
    return out


def parse_detail(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Order-detail JSON -> detail row with ``order_price`` cast to double."""
    out = _parsed(df, schemas.DETAIL_SCHEMA, value_col)
    return out.withColumn("order_price", F.col("order_price").try_cast("double"))


def parse_user(df: DataFrame, value_col: str = "value") -> DataFrame:
    """User JSON -> user row (all strings)."""
    return _parsed(df, schemas.USER_SCHEMA, value_col)


def record_json(*cols) -> Column:
    """Serialise the given columns (all columns of the row when none are given) as one
    JSON object; null fields are left out."""
    fields = [F.col(c) if isinstance(c, str) else c for c in cols] or [F.col("*")]
    return F.to_json(F.struct(*fields))


def valid_record(key: str = "mid") -> Column:
    """True when the required key was present, i.e. the line parsed."""
    return F.col(key).isNotNull()
