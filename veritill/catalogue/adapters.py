"""The given star-schema tables seen as raw exports: transactions, customers, holidays.

Dirty values are put in by fixed arithmetic on the keys, so the Spark adapter here and the SQL
in ``oracle`` produce the same rows.  No row of a table is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritill.functions import lookup, strip
from veritill.model import COUNTRY_ISO2, ROW_ID

#: The explicit "now" of all registered queries; all order dates lie before it.
AS_OF = "2002-01-01 00:00:00"
RUN_DATE = "2002-01-01"

#: Nation keys take the mapped country names in order; keys beyond them stay unmapped.
NATION_NAMES = {str(key): name for key, name in enumerate(COUNTRY_ISO2)}

#: Source position of a line: every column that can differ between lines of one invoice and part.
LINE_ORDER = (
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


#: Schemas of the tables read here; with them a read needs no job to look into the files.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    name = F.coalesce(lookup(F.col("n_nationkey").cast("string"), NATION_NAMES), "n_name")
    return nation.select("n_nationkey", name.alias("country"))


#: Slices of the orders whose lines are joined one after the other, where the rows are stored.
ORDER_SLICES = 2


def _of_slice(df: DataFrame, key: str, n: int | None) -> DataFrame:
    return df if n is None else df.where(F.pmod(F.xxhash64(key), F.lit(ORDER_SLICES)) == n)


#: Texts are made above all joins, so the joins shuffle the narrow columns they are made of.
_TRANSACTION_COLUMNS = (
    "cast(l_orderkey as string) as InvoiceNo",
    "cast(l_partkey as string) as StockCode",
    """case p_partkey % 3
         when 0 then upper(p_name)
         when 1 then concat('  ', p_name, ' ')
         else concat(replace(p_name, ' ', '-'), ' 3d') end as Description""",
    """case when l_orderkey % 101 = 0 then 'dozen'
            when l_returnflag = 'R' then cast(-cast(l_quantity as int) as string)
            else cast(cast(l_quantity as int) as string) end as Quantity""",
    """case when l_orderkey % 83 = 0 then 'not-a-date'
            when l_orderkey % 79 = 0 then '2099-01-01'
            when l_linenumber = 7 then cast(cast(l_shipdate as date) as string)
            else concat(cast(cast(l_shipdate as date) as string), ' ',
                        lpad(cast((l_orderkey + 5 * l_linenumber) % 24 as string), 2, '0'), ':15:00')
       end as InvoiceDate""",
    """case when l_orderkey % 97 = 0 then null
            when l_orderkey % 89 = 0 then '-1.50'
            else cast(cast((cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)) * 0.01
                           as decimal(14, 2)) as string) end as UnitPrice""",
    """case when o_custkey % 31 = 0 then null
            when o_custkey % 29 = 0 then concat('GHOST', o_custkey)
            when l_linenumber = 3 then concat(' ', o_custkey, '  ')
            else cast(o_custkey as string) end as CustomerID""",
    "country as Country",
    """case when o_custkey % 23 = 0 then 'On Hold'
            when o_orderkey % 11 = 0 then null
            when o_orderkey % 7 = 0 then ' Completed'
            when o_orderstatus = 'O' then 'done'
            when o_orderstatus = 'F' then 'VOID '
            when o_orderkey is not null then 'return' end as Status""",
    "if(l_linestatus = 'O', 'card', ' PayPal') as PaymentMethod",
    f"struct({', '.join(LINE_ORDER)}) as {ROW_ID}",
)


def raw_transactions(spark: SparkSession, sf_dir: str, exported: bool = False, nth: int | None = None) -> DataFrame:
    """Line items as a raw transactions export: all text, with dirty values.

    The last shuffled join is keyed on the trimmed invoice number, by which cleaning de-duplicates: rows of an invoice
    then lie together and are not shuffled once more for it.  A sort works that text out for every comparison, the more
    often the longer the numbers are, so rows that are ``exported`` are joined by the number itself and shuffled again later.

    ``nth`` names one slice of the invoices, of ``ORDER_SLICES``; together the slices are all rows.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = (
        _of_slice(table(spark, sf_dir, "orders"), "o_orderkey", nth).select("o_orderkey", "o_custkey", "o_orderstatus")
        .join(customer, F.expr("o_custkey = c_custkey"), "left").drop("c_custkey")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    invoice, order = F.col("l_orderkey"), F.col("o_orderkey")
    if not exported:
        invoice, order = (strip(key.cast("string")) for key in (invoice, order))
    return (
        _of_slice(table(spark, sf_dir, "lineitem"), "l_orderkey", nth)
        .join(part, F.expr("l_partkey = p_partkey"), "left")
        .join(orders, invoice == order, "left")
        .join(F.broadcast(_nations(spark, sf_dir)), F.expr("c_nationkey = n_nationkey"), "left")
        .selectExpr(*_TRANSACTION_COLUMNS)
    )


_CUSTOMER_COLUMNS = (
    """case when c_custkey % 53 = 0 then null
            when c_custkey % 7 = 0 then concat('  ', c_custkey, ' ')
            else cast(c_custkey as string) end as CustomerID""",
    """case when c_custkey % 50 = 1 then upper(country)
            when c_custkey % 50 = 2 then 'uk'
            when c_custkey % 50 = 3 then 'EIRE'
            when copy = 1 then lower(country)
            else country end as Country""",
    """case when c_custkey % 61 = 0 then 'bad-date'
            when c_custkey % 67 = 0 then null
            else cast(date_add(date'1995-01-01', cast(c_custkey % 1800 as int)) as string) end as SignupDate""",
    "if(c_custkey % 43 = 0, null, concat(' ', c_mktsegment)) as Segment",
    """case when c_custkey % 59 = 0 then 'maybe'
            when c_acctbal < 0 then 'false'
            when c_custkey % 2 = 0 then 'True'
            else '1' end as IsActive""",
    f"c_custkey * 2 + copy as {ROW_ID}",
)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a raw export: all text, with dirty values and second copies."""
    customer = table(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.expr("c_nationkey = n_nationkey"), "left"
    )
    copied = customer.withColumn("copy", F.expr("explode(if(c_custkey % 41 = 0, array(0, 1), array(0)))"))
    return copied.selectExpr(*_CUSTOMER_COLUMNS)


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar drawn from the order dates: some days of a month, some with several names."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customer, F.expr("o_custkey = c_custkey"), "left").join(
        _nations(spark, sf_dir), F.expr("c_nationkey = n_nationkey"), "left"
    )
    days = joined.where("day(o_orderdate) in (1, 15, 25)").withColumn(
        "country_code", lookup(F.col("country"), COUNTRY_ISO2)
    )
    return days.selectExpr(
        "country_code",
        "to_date(o_orderdate) as date",
        "concat('jour ', o_orderpriority) as local_name",
        "concat('Day ', o_orderpriority) as name",
        "if(o_orderpriority <> '5-LOW', true, null) as is_global",
    ).distinct()


# --------------------------------------------------------------------------- output form
def plain(df: DataFrame) -> DataFrame:
    """Portable result types: dates, times and flags as text, decimals as doubles."""
    casts = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.BooleanType)):
            value = value.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            value = value.cast("double")
        casts.append(value.alias(f.name))
    return df.select(*casts)


def brief(results: DataFrame) -> DataFrame:
    """The comparable columns of check results."""
    return results.select("table", "check", "status", "severity", "message", "rows_affected")
