"""Section G: sorts, set operations and scalar functions; section J: data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.catalog import base as b
from pairloom.catalog.base import BARS, BAR_SERIES, DATES, PREDICTIONS, query
from pairloom.functions import columns as C
from pairloom.operators import quality as q
from pairloom.operators.series import running

COLS = ["symbol", "date", "open", "high", "low", "close", "volume"]
SQL_COLS = ", ".join(COLS)


@query("g1_order_by", f"WITH {BARS} SELECT {SQL_COLS} FROM bars ORDER BY date, symbol")
def g1(spark, d):
    return b.bars(spark, d).select(*COLS).orderBy("date", "symbol")


@query("g2_latest_row", f"WITH {BARS} SELECT {SQL_COLS} FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1")
def g2(spark, d):
    df = b.bars(spark, d)
    row = F.struct(*COLS[1:])
    return df.groupBy("symbol").agg(F.max_by(row, "date").alias("r")).select("symbol", "r.*")


@query("g3_union_by_name", f"WITH {BARS} SELECT symbol, date, close, CASE WHEN symbol = 'A' THEN volume END AS volume FROM bars")
def g3(spark, d):
    df = b.bars(spark, d)
    first = df.where("symbol = 'A'").select("symbol", "date", "close", "volume")
    return first.unionByName(df.where("symbol <> 'A'").select("close", "date", "symbol"), allowMissingColumns=True)


@query("g4_union_all", "SELECT l_orderkey AS k, l_quantity AS v FROM lineitem UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def g4(spark, d):
    items = b.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("v"))
    return items.union(b.table(spark, d, "orders").select("o_orderkey", "o_totalprice"))


@query("g5_index_union", """
SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem UNION SELECT CAST(o_orderdate AS DATE) FROM orders""")
def g5(spark, d):
    ship = b.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return ship.union(b.table(spark, d, "orders").select(F.col("o_orderdate").cast("date"))).distinct()


@query("g5_index_intersect", """
SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem INTERSECT SELECT CAST(o_orderdate AS DATE) FROM orders""")
def g5_intersect(spark, d):
    ship = b.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return ship.intersect(b.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")))


@query("g6_scalar_date", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS dom,
       CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS parsed, CAST(CAST(o_orderdate AS DATE) + 2 AS DATE) AS plus_2d,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 10 MONTH AS DATE) AS minus_10m FROM orders""")
def g6(spark, d):
    day = F.col("o_orderdate").cast("date")
    return b.table(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("dom"),
        F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("parsed"), F.date_add(day, 2).alias("plus_2d"),
        F.add_months(day, -10).alias("minus_10m"))


@query("g7_scalar_math", """
SELECT c_custkey, abs(c_acctbal) AS a, CAST(sign(c_acctbal) AS DOUBLE) AS s, greatest(0.0, c_acctbal) AS pos,
       round(sqrt(abs(c_acctbal)), 6) AS root, round(ln(1 + abs(c_acctbal)), 6) AS lg, c_acctbal / NULLIF(c_nationkey, 0) AS ratio FROM customer""")
def g7(spark, d):
    x = F.col("c_acctbal")
    return b.table(spark, d, "customer").select(
        "c_custkey", F.abs(x).alias("a"), F.signum(x).alias("s"), F.greatest(F.lit(0.0), x).alias("pos"),
        F.round(F.sqrt(F.abs(x)), 6).alias("root"), F.round(F.log(1 + F.abs(x)), 6).alias("lg"), C.ratio(x, F.col("c_nationkey")).alias("ratio"))


@query("g8_scalar_string", """
SELECT p_partkey, lower(p_type) AS lo, upper(p_name) AS up, replace(p_name, ' ', '_') AS rep, trim('  ' || p_name || ' ') AS tr,
       p_brand || '_' || CAST(p_size AS VARCHAR) AS cat FROM part""")
def g8(spark, d):
    return b.table(spark, d, "part").select(
        "p_partkey", F.lower("p_type").alias("lo"), F.upper("p_name").alias("up"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("rep"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("tr"), F.concat_ws("_", "p_brand", F.col("p_size").cast("string")).alias("cat"))


@query("g9_scalar_json_map", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(json_extract(props, '$.k') AS INTEGER) AS first_value,
       '{"' || event_type || '":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS body FROM events""")
def g9(spark, d):
    k = F.from_json("props", "k int")["k"]
    m = F.map_from_arrays(F.array("event_type"), F.array(k))
    return b.table(spark, d, "events").withColumn("m", m).select(
        "event_id", F.try_element_at("m", F.col("event_type")).alias("k"), F.get(F.map_values("m"), F.lit(0)).alias("first_value"),
        F.to_json("m").alias("body"))


@query("g10_scalar_null_handling", f"""WITH {BARS},
h AS (SELECT symbol, date, NULLIF(floor(close / 2000), 0) AS v FROM bars)
SELECT symbol, date, v, coalesce(v, 0) AS filled_zero,
       last_value(v IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS filled_forward FROM h""")
def g10(spark, d):
    h = b.bars(spark, d).select("symbol", "date", F.nullif(F.floor(F.col("close") / 2000).cast("double"), F.lit(0.0)).alias("v"))
    return running(h.withColumn("filled_zero", F.coalesce("v", F.lit(0.0))), BAR_SERIES, lasts={"filled_forward": F.col("v")})


@query("g11_scalar_array", f"""WITH {BARS}
SELECT symbol, date, CAST(list_position([open, high, low, close], list_max([open, high, low, close])) - 1 AS INTEGER) AS arg,
       open + high + low + close AS total FROM bars""")
def g11(spark, d):
    a = F.array("open", "high", "low", "close")
    return b.bars(spark, d).select("symbol", "date", C.argmax(a).alias("arg"),
                                   F.aggregate(a, F.lit(0.0), lambda s, x: s + x).alias("total"))


# --- J: data quality --------------------------------------------------------------------------


@query("j1_not_null", f"""WITH {PREDICTIONS}
SELECT 'date' AS column_name, CAST(count(*) FILTER (WHERE date IS NULL) AS BIGINT) AS n_null FROM predictions
UNION ALL SELECT 'prediction', count(*) FILTER (WHERE prediction IS NULL) FROM predictions
UNION ALL SELECT 'confidence', count(*) FILTER (WHERE confidence IS NULL) FROM predictions
UNION ALL SELECT 'actual', count(*) FILTER (WHERE actual IS NULL) FROM predictions""")
def j1(spark, d):
    return q.null_counts(b.predictions(spark, d), ["date", "prediction", "confidence", "actual"])


@query("j2_unique", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def j2(spark, d):
    return q.duplicates(b.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("j3_accepted_range", f"WITH {DATES} SELECT date_code, month FROM dates WHERE NOT (month BETWEEN 1 AND 11)")
def j3(spark, d):
    return q.outside_range(b.dates(spark, d), "month", 1, 11).select("date_code", "month")


@query("j3_calendar_ranges", f"""WITH {DATES}
SELECT date_code, 'year' AS column_name, year AS found FROM dates WHERE NOT (year BETWEEN 2000 AND 2100)
UNION ALL SELECT date_code, 'month', month FROM dates WHERE NOT (month BETWEEN 1 AND 12)
UNION ALL SELECT date_code, 'day', day FROM dates WHERE NOT (day BETWEEN 1 AND 31)""")
def j3_calendar(spark, d):
    dates, out = b.dates(spark, d), None
    for column, low, high in (("year", 2000, 2100), ("month", 1, 12), ("day", 1, 31)):
        bad = q.outside_range(dates, column, low, high).select("date_code", F.lit(column).alias("column_name"), F.col(column).alias("found"))
        out = bad if out is None else out.unionByName(bad)
    return out


@query("j4_check_non_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def j4(spark, d):
    return q.negatives(b.table(spark, d, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query("j5_range_assertion", f"WITH {BARS} SELECT symbol, date, close FROM bars WHERE close < 0 OR close > 2000 OR high < 0 OR high > 2000")
def j5(spark, d):
    return q.outside_any(b.bars(spark, d), ["close", "high"], 0, 2000).select("symbol", "date", "close")


@query("j6_batch_null_gate", f"""WITH {PREDICTIONS}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE confidence IS NULL) AS BIGINT) AS n_bad,
       count(*) FILTER (WHERE confidence IS NULL) = 0 AS accepted FROM predictions""")
def j6(spark, d):
    return q.null_gate(b.predictions(spark, d))
