"""Names, types, text, dates and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.labels import country_label
from ..operators.shape import cast_columns, first_non_null, rename, sanitise_columns, strip_and_cast
from ..plans import fixed_values as fixed
from ..sources.readers import parse_dictionary
from .registry import keyword_sql, query, replace_sql, table, title_sql


@query(
    """SELECT o_orderkey AS order_key, o_totalprice AS total_price_usd, o_orderpriority AS "order-priority",
              o_orderstatus AS "status.code" FROM orders"""
)
def sanitise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = rename(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"),
        {
            "o_orderkey": "Order Key",
            "o_totalprice": "Total Price (USD)",
            "o_orderpriority": "Order-Priority;",
            "o_orderstatus": "{Status}.Code=\n",
        },
    )
    return sanitise_columns(raw)


@query(
    """SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
              TRY_CAST(o_orderstatus AS INTEGER) AS status_number, 'orders' AS source,
              CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS size_class,
              coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS status_or_priority FROM orders"""
)
def rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("double").alias("o_orderkey"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.col("o_orderstatus").alias("status_number"),
        F.lit("orders").alias("source"),
        F.when(F.col("o_totalprice") > 250000, "large").otherwise("small").alias("size_class"),
        first_non_null(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority").alias("status_or_priority"),
    )
    named = rename(raw, {"o_orderkey": "order_id"})
    return cast_columns(named, ["order_id", "priority", "status_number"], "int")


@query(
    """SELECT p_partkey, p_brand AS brand, regexp_replace(p_name, '[ "]', '', 'g') AS name,
              p_retailprice AS price, CAST(NULL AS DOUBLE) AS bad_number FROM part"""
)
def strip_chars_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit(' "'), "p_brand", F.lit('"')).alias("brand"),
        F.concat(F.lit('""'), "p_name", F.lit(' "')).alias("name"),
        F.concat(F.lit(' "'), F.col("p_retailprice").cast("string"), F.lit('"')).alias("price"),
        F.concat(F.lit("n/a "), "p_brand").alias("bad_number"),
    )
    return strip_and_cast(strip_and_cast(raw, ["brand", "name"]), ["price", "bad_number"], type_="double")


def _day_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival and departure as day numbers since 1960, as doubles; pending orders have not departed."""
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1960-01-01").cast("date")).cast("double")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", days.alias("arrdate"), F.when(F.col("o_orderstatus") != "P", days + 14).alias("depdate")
    )


def _day_numbers_sql(null_day: str) -> str:
    return f"""
        SELECT o_orderkey, DATE '1960-01-01' + CAST(arr AS INTEGER) AS arrival_date,
               DATE '1960-01-01' + CAST(CASE WHEN o_orderstatus <> 'P' THEN arr + 14 ELSE {null_day} END AS INTEGER)
                   AS departure_date
        FROM (SELECT *, date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS arr FROM orders)"""


@query(_day_numbers_sql("NULL"))
def epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day_numbers(spark, sf_dir).select(
        "o_orderkey",
        fn.epoch_days_to_date("arrdate").alias("arrival_date"),
        fn.epoch_days_to_date("depdate").alias("departure_date"),
    )


@query(_day_numbers_sql("0"))
def epoch_dates_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day_numbers(spark, sf_dir).select(
        "o_orderkey",
        fn.epoch_days_to_date("arrdate").alias("arrival_date"),
        fn.epoch_days_to_date("depdate", null_as=0).alias("departure_date"),
    )


@query(
    """SELECT event_id, CAST(ts AS DATE) AS date, CAST(day(ts) AS INTEGER) AS day_of_month,
              CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(ts) AS INTEGER) AS week_of_year
       FROM events"""
)
def date_parts_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("dt"))
    dated = raw.select("event_id", fn.to_date_part("dt").alias("date"))
    return dated.withColumns(fn.date_parts("date"))


@query(
    """SELECT c_custkey, CASE WHEN right(t, 1) IN ('S', 'W') THEN -1.0 ELSE 1.0 END
                         * TRY_CAST(left(t, greatest(length(t) - 1, 0)) AS DOUBLE) AS longitude
       FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN '' WHEN c_mktsegment = 'FURNITURE' THEN NULL
             WHEN c_acctbal < 2500 THEN CAST(abs(c_acctbal) AS VARCHAR) || 'W'
             ELSE CAST(c_acctbal AS VARCHAR) || 'E' END AS t FROM customer)"""
)
def hemisphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "")
        .when(F.col("c_mktsegment") == "FURNITURE", None)
        .when(F.col("c_acctbal") < 2500, F.concat(F.abs("c_acctbal").cast("string"), F.lit("W")))
        .otherwise(F.concat(F.col("c_acctbal").cast("string"), F.lit("E")))
    )
    raw = table(spark, sf_dir, "customer").select("c_custkey", text.alias("longitude"))
    return raw.select("c_custkey", fn.parse_hemisphere("longitude").alias("longitude"))


@query(
    """SELECT s_suppkey, CASE WHEN s_nationkey = 7 THEN NULL ELSE s_acctbal END AS latitude,
              CASE WHEN s_nationkey IN (7, 8) THEN NULL ELSE CAST(-s_suppkey AS DOUBLE) END AS longitude FROM supplier"""
)
def coordinate_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("s_nationkey") == 7, "unknown")
        .when(F.col("s_nationkey") == 8, F.col("s_acctbal").cast("string"))
        .otherwise(F.concat_ws(", ", F.col("s_acctbal").cast("string"), (-F.col("s_suppkey")).cast("string")))
    )
    raw = table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("coordinates"))
    latitude, longitude = fn.split_coordinates("coordinates")
    return raw.select("s_suppkey", latitude.alias("latitude"), longitude.alias("longitude"))


@query(
    """SELECT c_custkey, substr(c_mktsegment, 1, 3) AS code,
              CASE WHEN c_nationkey <> 0 THEN c_name || ', ' || c_mktsegment END AS label FROM customer"""
)
def code_label_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    sep = F.when(F.col("c_nationkey") == 0, F.lit(" ")).otherwise(F.lit(": "))
    text = F.concat(F.lit("US"), F.substring("c_mktsegment", 1, 3), sep, "c_name", F.lit(", "), "c_mktsegment")
    code, label = fn.split_code_label("text")
    raw = table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
    return raw.select("c_custkey", code.alias("code"), label.alias("label"))


_TITLE_TEXT = "upper(p_name) || '-' || p_type || ' o''hare st. x2' || lower(p_brand)"


@query(f"SELECT p_partkey, {title_sql('t')} AS title FROM (SELECT p_partkey, {_TITLE_TEXT} AS t FROM part)")
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", fn.title_case(F.expr(_TITLE_TEXT)).alias("title"))


_PAIRS = [("small", "sm."), ("sm. r", "S-R"), ("old", "new"), ("new", "NEW"), ("NEW ", "")]


@query(f"SELECT p_partkey, {replace_sql('p_name', _PAIRS)} AS name FROM part")
def replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", fn.replace_all("p_name", _PAIRS).alias("name"))


@query(
    """SELECT p_partkey AS code, upper(p_name) || ' = ' || p_brand AS label,
              chr(9) || '''' || upper(p_name) || ' = ' || p_brand || '   ''' AS raw_label FROM part""",
    name="parse_dictionary",
)
def parse_dictionary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.expr(r"""concat("'", p_partkey, "'\t=\t'", upper(p_name), " = ", p_brand, "   '")""")
    lines = table(spark, sf_dir, "part").select(line.alias("value"))
    stripped = parse_dictionary(lines, key_type="bigint")
    raw = parse_dictionary(lines, label="raw_label", key_type="bigint", strip_label=False)
    return stripped.join(raw, "code")


_COUNTRY_TEXT = """'  ''' || CASE c_mktsegment
    WHEN 'HOUSEHOLD' THEN 'INVALID: ' || n_name
    WHEN 'MACHINERY' THEN 'ST. ' || c_name || ' (' || n_name || ')'
    WHEN 'FURNITURE' THEN n_name || ' ISLS-' || r_name
    WHEN 'BUILDING' THEN r_name || CASE n_regionkey WHEN 0 THEN ' (FRENCH)' WHEN 1 THEN ' USSR' WHEN 2 THEN ' KAMPUCHEA'
        WHEN 3 THEN ' COCOS IS.' ELSE ' LAOS (x)' END
    ELSE c_name END || ''''"""


def _country_clean_sql(x: str) -> str:
    short = f"trim({keyword_sql(x, fixed.COUNTRY_SHORTCUTS)})"
    cut = f"string_split({title_sql(short)}, ' (')[1]"
    return replace_sql(cut, fixed.COUNTRY_REPLACEMENTS)


@query(
    f"""SELECT c_custkey, label, {keyword_sql('cleaned', fixed.COUNTRY_KEYWORDS)} AS country FROM (
          SELECT c_custkey, label, {_country_clean_sql('label')} AS cleaned FROM (
            SELECT c_custkey, {_COUNTRY_TEXT} AS label FROM customer
            LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey))"""
)
def clean_country_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"), "left")
    )
    text = F.expr(_COUNTRY_TEXT.replace("''''", "\"'\"").replace("'  '''", "\"  '\""))
    return places.select("c_custkey", text.alias("label")).withColumn("country", country_label("label"))


_DECIMAL = "CASE o_orderkey % 5 WHEN 0 THEN 'x' || o_orderkey WHEN 1 THEN o_orderkey || '.0' WHEN 2 THEN o_orderkey || '.5' WHEN 3 THEN ' ' || o_orderkey || ' ' ELSE CAST(o_orderkey AS VARCHAR) END"


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (1, 3, 4) THEN CAST(o_orderkey AS INTEGER) END AS whole,
              CASE WHEN o_orderkey % 5 IN (1, 3, 4) THEN DATE '1960-01-01' + CAST(o_orderkey % 20000 AS INTEGER) END AS day
       FROM orders"""
)
def cast_decimal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a fraction of zeros or blanks are whole numbers and days; others are null and raise nothing."""
    cells = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(_DECIMAL.replace("VARCHAR", "STRING")).alias("whole"),
        F.expr(
            "CASE o_orderkey % 5 WHEN 0 THEN 'x' WHEN 2 THEN '' WHEN 1 THEN (o_orderkey % 20000) || '.0' "
            "ELSE (o_orderkey % 20000) || '' END"
        ).alias("day"),
    )
    return cast_columns(cells, ["whole"], "int").withColumn("day", fn.epoch_days_to_date("day"))
