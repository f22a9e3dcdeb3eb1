"""The driver tables seen as loans, transactions, names and table history.

These stand for the landed data. They are built to hold what real feeds hold: footer rows,
unreadable dates, missing rates, unlisted statuses, replayed and unparseable messages.
Defects are placed by key so that the SQL oracles see the same ones; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.functions.dates import MONTH_END, date_spine
from ledgerlens.operators import engine_input, exposure, rwa
from ledgerlens.operators.loans import loan_master
from ledgerlens.operators.portfolio import portfolio_as_of, positions
from ledgerlens.operators.transactions import conform, replay_messages

REPORTING_DATE = "1998-12-31"
FIRST_MONTH, LAST_MONTH = "1998-09-30", "1999-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- credit --------------------------------------------------------------------------


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extract row per order. The last shipment stands for the last payment."""
    paid = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    # Both sides grow with the orders. The hint keeps the join a shuffle at any size, so the
    # lifecycle arithmetic after it runs on every core also where one side would fit memory.
    return table(spark, sf_dir, "orders").join(paid.hint("merge"), "o_orderkey", "left").select(
        F.expr(
            "case when o_orderkey % 211 = 0 then concat('Total rows ', o_orderkey) "
            "else cast(o_orderkey as string) end"
        ).alias("id"),
        F.expr(
            "case when o_orderkey % 223 = 0 then 'n/a' "
            "else date_format(o_orderdate, 'MMM-yyyy') end"
        ).alias("issue_d"),
        F.expr(
            "case when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end"
        ).alias("term"),
        # Interest-free loans are for amounts that divide into whole instalments.
        F.expr(
            "case when o_custkey % 37 = 0 then floor(o_totalprice / 360) * 360.0D "
            "else o_totalprice end"
        ).alias("loan_amnt"),
        F.col("o_totalprice").alias("funded_amnt"),
        F.expr(
            "case when o_orderkey % 509 = 0 then null when o_custkey % 37 = 0 then 0.0D "
            "else cast(5 + o_custkey % 20 as double) end"
        ).alias("int_rate"),
        F.expr(
            "o_totalprice / case when o_orderkey % 3 = 0 then 60 else 36 end"
        ).alias("installment"),
        F.expr("substr('ABCDEFG', cast(1 + o_custkey % 7 as int), 1)").alias("grade"),
        F.expr(
            "concat(substr('ABCDEFG', cast(1 + o_custkey % 7 as int), 1), "
            "cast(1 + o_orderkey % 5 as string))"
        ).alias("sub_grade"),
        F.col("o_orderpriority").alias("purpose"),
        F.expr("concat('NATION_', o_custkey % 25)").alias("addr_state"),
        F.expr("cast(20000 + (o_custkey % 1000) * 100 as double)").alias("annual_inc"),
        F.expr("cast(o_custkey % 400 as double) / 10").alias("dti"),
        F.expr(
            "case when o_orderkey % 29 = 0 then 'Joint App' else 'Individual' end"
        ).alias("application_type"),
        F.expr(
            "case o_custkey % 3 when 0 then 'RENT' when 1 then 'OWN' else 'MORTGAGE' end"
        ).alias("home_ownership"),
        F.expr(
            "case when o_custkey % 17 = 0 then null else concat(o_custkey % 10, ' years') end"
        ).alias("emp_length"),
        F.expr(
            "case when o_custkey % 2 = 0 then 'Verified' else 'Not Verified' end"
        ).alias("verification_status"),
        F.expr("cast(600 + o_custkey % 200 as double)").alias("fico_range_low"),
        F.expr("cast(604 + o_custkey % 200 as double)").alias("fico_range_high"),
        F.expr(
            "case when o_orderstatus = 'O' then 'Current' "
            "when o_orderstatus = 'F' and o_orderkey % 19 = 0 "
            "then 'Does not meet the credit policy. Status:Fully Paid' "
            "when o_orderstatus = 'F' then 'Fully Paid' "
            "when o_orderkey % 23 = 0 then 'Default' "
            "when o_orderkey % 19 = 0 then 'Does not meet the credit policy. Status:Charged Off' "
            "else 'Charged Off' end"
        ).alias("loan_status"),
        F.expr("o_totalprice / 2").alias("out_prncp"),
        F.expr("o_totalprice / 4").alias("total_pymnt"),
        F.expr("o_totalprice / 8").alias("total_rec_prncp"),
        F.expr(
            "case when shipped > o_orderdate then date_format(shipped, 'MMM-yyyy') end"
        ).alias("last_pymnt_d"),
        F.expr("case when o_orderstatus = 'P' then o_totalprice * 0.05D end").alias("recoveries"),
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_master(raw_loans(spark, sf_dir))


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position on the reporting date."""
    return portfolio_as_of(master(spark, sf_dir), REPORTING_DATE)


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five month-end positions from one pass over the master."""
    return positions(master(spark, sf_dir), date_spine(FIRST_MONTH, LAST_MONTH, MONTH_END))


def _loan_number() -> Column:
    return F.substring("exposure_id", 4, 18).try_cast("bigint")


def broken_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position with unknown grades, negative days, missing parties, inflated balances."""
    number = _loan_number()
    return book(spark, sf_dir).withColumns({
        "grade": F.when(number % 50 == 0, "Z").otherwise(F.col("grade")),
        "days_past_due": F.when(number % 97 == 0, -5).otherwise(F.col("days_past_due")),
        "customer_id": F.when(number % 101 != 0, F.col("customer_id")),
        "outstanding_amount": F.when(
            number % 103 == 0, F.col("outstanding_amount") * 3
        ).otherwise(F.col("outstanding_amount")),
    })


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exposure.conform(book(spark, sf_dir), "snapshot_date")


def silver_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exposure.conform(books(spark, sf_dir), "snapshot_date")


def rwa_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RWA output for every month-end."""
    sent = engine_input.build(silver_months(spark, sf_dir), F.col("snapshot_date"))
    return rwa.run_engine(sent)


def rwa_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rwa.run_engine(engine_input.build(silver(spark, sf_dir), REPORTING_DATE))


# ---- transactions --------------------------------------------------------------------


def bronze_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed transaction per event, amounts still floating point."""
    return table(spark, sf_dir, "events").select(
        F.expr(
            "1 + cast(floor((unix_seconds(cast(ts as timestamp)) "
            "- unix_seconds(timestamp'2024-01-01 00:00:00')) / 3600) as int)"
        ).alias("step"),
        F.expr(
            "case event_type when 'purchase' then 'TRANSFER' when 'error' then 'CASH_OUT' "
            "when 'click' then 'PAYMENT' when 'view' then 'CASH_IN' else 'DEBIT' end"
        ).alias("type"),
        F.col("value").alias("amount"),
        F.expr("concat('C', user_id)").alias("name_orig"),
        F.expr(
            "round(case when event_id % 10 = 0 then value else value * (2 + event_id % 5) end, 2)"
        ).alias("old_balance_orig"),
        F.expr(
            "round(case when event_id % 10 = 0 then 0 else value * (1 + event_id % 5) end, 2)"
        ).alias("new_balance_orig"),
        F.expr("concat('M', user_id, '-', event_id % 40)").alias("name_dest"),
        F.expr("round(value * 3, 2)").alias("old_balance_dest"),
        F.expr("round(value * 4, 2)").alias("new_balance_dest"),
        F.expr(
            "case when event_id % 10 = 0 and event_id % 70 <> 0 "
            "and event_type in ('purchase', 'error') then 1 else 0 end"
        ).alias("is_fraud"),
        F.expr("case when event_id % 630 = 0 then 1 else 0 end").alias("is_flagged_fraud"),
        F.expr("cast(user_id % 6 as int)").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
    )


def silver_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(bronze_txn(spark, sf_dir))


def broken_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with missing amounts, unknown types, negative balances and lost parties."""
    offset = F.col("kafka_offset")
    return bronze_txn(spark, sf_dir).withColumns({
        "amount": F.when(offset % 97 != 0, F.col("amount")),
        "type": F.when(offset % 89 == 0, "REFUND").otherwise(F.col("type")),
        "old_balance_orig": F.when(offset % 101 == 0, -1.0).otherwise(F.col("old_balance_orig")),
        "name_dest": F.when(offset % 103 != 0, F.col("name_dest")),
        "is_fraud": F.when(offset % 107 == 0, 2).otherwise(F.col("is_fraud")),
    })


def replayed_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a replay: the transfers were consumed twice."""
    txns = silver_txn(spark, sf_dir)
    return txns.unionByName(txns.filter(F.col("type") == "TRANSFER"))


def poisoned_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message in one of seven states, from well formed to not JSON at all; the
    partition tells the state."""
    txns = bronze_txn(spark, sf_dir)
    log = replay_messages(txns).withColumn("kind", (F.col("position") % 7).cast("int"))
    value, kind = F.col("value"), F.col("kind")
    spoiled = (
        F.when(kind == 1, F.substring(value, 1, 60))
        .when(kind == 2, F.concat_ws(",", F.lit("TRANSFER"), F.col("key")))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.regexp_replace(value, '"name_dest":"[^"]*",', ""))
        .when(
            kind == 5,
            F.regexp_replace(value, '"amount":[0-9.E-]+', '"amount":"five thousand"'),
        )
        .when(kind == 6, F.regexp_replace(value, "}$", ',"channel":"mobile"}'))
        .otherwise(value)
    )
    return log.select(
        spoiled.cast("binary").alias("value"),
        kind.alias("partition"),
        F.col("position").alias("offset"),
        F.lit("2018-01-01").cast("timestamp").alias("timestamp"),
    )


# ---- names ---------------------------------------------------------------------------


# The letters that stand for the hexadecimal digits in a supplier's name.
HEX_LETTERS = "aeiounrstlmdkvbz"


def _supplier_name(key: str) -> Column:
    """Two words of letters, another one for each key."""
    letters = f"translate(md5(cast({key} as string)), '0123456789abcdef', '{HEX_LETTERS}')"
    return F.expr(f"concat(substr({letters}, 1, 7), ' ', substr({letters}, 8, 8))")


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part name and every supplier is listed, so the list grows with the suppliers."""
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    suppliers = table(spark, sf_dir, "supplier").select(_supplier_name("s_suppkey").alias("name"))
    return parts.unionByName(suppliers).withColumn("h", F.sha2("name", 256)).select(
        F.concat(F.lit("WL-"), F.substring("h", 1, 8)).alias("entity_id"), "name",
        F.expr(
            "case substr(h, 2, 1) when '0' then 'SDN' when '1' then 'EU' else 'UN' end"
        ).alias("program"),
    )


def dest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One beneficiary name per destination account, made from a part's or a supplier's.

    A third are slips of a listed name; the rest are that name's words turned round with the
    account's initial put in front.
    """
    accounts = table(spark, sf_dir, "events").select("user_id", F.expr("event_id % 40").alias("k"))
    parts = table(spark, sf_dir, "part")
    size = parts.select(F.max("p_partkey") + 1).scalar()
    suppliers = table(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    named = (
        accounts.distinct()
        .withColumn("n", F.expr("user_id * 40 + k"))
        .withColumn("p_partkey", F.col("n") % size)
        .withColumn("supplier", F.col("n") % suppliers)
        .join(parts.select("p_partkey", "p_name"), "p_partkey")
        .withColumn("base", F.when(F.col("n") % 3 == 0, _supplier_name("supplier")).otherwise(F.col("p_name")))
    )
    return named.select(
        F.expr("concat('M', user_id, '-', k)").alias("name_dest"),
        F.expr(
            "case n % 11 when 0 then substr(base, 1, length(base) - 1) "
            "when 1 then replace(base, ' ', '  ') "
            "when 2 then replace(base, 'e', 'i') "
            "when 3 then upper(base) "
            "else concat(chr(cast(97 + n % 26 as int)), '. ', split_part(base, ' ', 2), ' ', "
            "split_part(base, ' ', 1)) end"
        ).alias("dest_name"),
        F.expr("n % 11 < 4").alias("seeded_hit"),
    )


# ---- table history -------------------------------------------------------------------


def versioned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as append-only rows: the supplier is the partition, the year the version."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("part"),
        F.year("l_shipdate").cast("bigint").alias("version"),
        "l_orderkey", "l_linenumber",
        F.expr("cast(l_quantity * 1000 as bigint)").alias("bytes"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One commit per month with orders."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("committed_at"))
        .agg(F.count("*").alias("added_rows"))
        .withColumn(
            "version",
            (F.year("committed_at") * 12 + F.month("committed_at")).cast("bigint"),
        )
    )
