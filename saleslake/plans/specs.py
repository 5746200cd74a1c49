"""Specs of the stand-in tables (declared types chosen to exercise each rule)."""

from __future__ import annotations

from saleslake.spec import TableSpec, parse_columns

# Invoice lines (stand-in for fact_invoice_secondary), cleaned from RAW_LINES.
FACT_LINES = TableSpec(
    "fact_lines",
    parse_columns(
        "invoice_key:BIGINT, invoice_date:INT, sales_group_code:SMALLINT, record_type:VARCHAR(2), "
        "quantity:SMALLINT, value:DOUBLE, discount:FLOAT, ship_date:DATE, line_number:TINYINT, "
        "line_status:VARCHAR(1), big_qty:INT"
    ),
    keys=("invoice_key",), buckets=20, partition_by=("sales_group_code",),
)

# The typed facts, declared narrower than the data.
FACT_NARROW = TableSpec(
    "fact_narrow",
    parse_columns("invoice_key:SMALLINT, sales_group_code:TINYINT, record_type:VARCHAR(1), value:FLOAT, ship_ymd:SMALLINT"),
)

# Documents with deliberately short text limits.
DOCUMENTS = TableSpec(
    "documents",
    parse_columns("doc_id:BIGINT, text:VARCHAR(2000), lang:VARCHAR(2), source:VARCHAR(8), n_chars:INT"),
    keys=("doc_id",),
)

# lineitem keys declared narrower than the data.
LINE_INTS = TableSpec(
    "line_ints",
    parse_columns(
        "l_orderkey:SMALLINT, l_partkey:SMALLINT, l_suppkey:TINYINT, l_linenumber:TINYINT, "
        "v_int:INT, v_big:BIGINT, v_neg:TINYINT"
    ),
)

# events: a DATE column that holds times, a FLOAT column that holds doubles.
EVENTS = TableSpec(
    "events",
    parse_columns("event_id:BIGINT, ts:DATE, day_ts:DATE, user_id:INT, event_type:VARCHAR(20), value:FLOAT"),
)

# Customer master stand-in: incoming headers exercise every rename rule.
DIM_CUSTOMER = TableSpec(
    "dim_customer",
    parse_columns(
        'customer_code:BIGINT, customer_name:VARCHAR(150), nation_code:INT<-"nation code", '
        'account_balance:DOUBLE<-"acct bal", market_segment:VARCHAR(20), customer_group:VARCHAR(5), '
        'cm_customer_group:VARCHAR(120)<-"customer group", div_col_rf:VARCHAR(105)<-"div", phone:VARCHAR(20)'
    ),
    keys=("customer_code",), prefixes=("cm",),
)

# Order lines stand-in for fact_invoice_details.
FACT_DETAILS = TableSpec(
    "fact_invoice_details",
    parse_columns("order_number:BIGINT!, posting_date:INT, sales_group_code:SMALLINT, net_value:DOUBLE, status:VARCHAR(3)"),
    keys=("order_number",), partition_by=("sales_group_code",),
)

DECIMALS = TableSpec("decimals", parse_columns("part_key:BIGINT, amount:DECIMAL(38, 10)"))

# The wide stand-in's declared types (see standins.wide_exprs).
def wide_spec():
    from saleslake.plans.standins import wide_exprs

    return TableSpec("wide_lines", parse_columns(", ".join(f"{n}:{t}" for n, t, _ in wide_exprs())))

# Tables that are created from their specs.
K13_CUSTOMER = TableSpec("k13_customer", parse_columns("customer_code:BIGINT, nation_code:INT, account_balance:DOUBLE"), keys=("customer_code",))
K13_NATION = TableSpec("k13_nation", parse_columns("nation_code:INT, nation_name:VARCHAR(30)"), keys=("nation_code",))
