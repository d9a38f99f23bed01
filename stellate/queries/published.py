"""Scans, sinks and repeated publishing. Tables are written below the session's shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import union_all
from ..operators.incremental import pending, publish_incremental
from ..operators.shape import conform, rejected
from ..operators.versions import Piece, publish_version, read_version
from ..sources import readers, sinks
from ..sources.workspace import new_dir
from ..streaming import stream_files
from .registry import YEAR_MONTH, dated_orders, query, table

MONTH = ["year", "month"]

_TOTALS = "count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total"


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(f"SELECT {YEAR_MONTH}, {_TOTALS} FROM orders GROUP BY ALL")
def partition_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "orders")
    sinks.publish(dated_orders(spark, sf_dir), path, partition_by=MONTH, sort_within=["arrival_date"])
    return _totals(readers.read_table(spark, path))


@query(f"SELECT {YEAR_MONTH}, {_TOTALS} FROM orders WHERE year(o_orderdate) = 1997 GROUP BY ALL")
def partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year below the table root, with its partition columns kept."""
    path = new_dir(spark, "orders")
    sinks.publish(dated_orders(spark, sf_dir), path, partition_by=MONTH)
    return _totals(readers.read_table(spark, f"{path}/year=1997", base_path=path))


@query(f"SELECT {YEAR_MONTH}, {_TOTALS} FROM orders GROUP BY ALL")
def publish_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishing the same months again changes nothing."""
    path = new_dir(spark, "orders")
    orders = dated_orders(spark, sf_dir)
    publish_incremental(orders, path, MONTH)
    publish_incremental(orders, path, MONTH)
    return _totals(readers.read_table(spark, path))


@query(f"SELECT {YEAR_MONTH}, {_TOTALS} FROM orders GROUP BY ALL")
def publish_in_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months arrive in pieces, one of them twice; each is merged with what is published."""
    path = new_dir(spark, "orders")
    orders = dated_orders(spark, sf_dir)
    for statuses in (["O"], ["F", "P"], ["O"]):
        piece = orders.where(F.col("o_orderstatus").isin(statuses))
        publish_incremental(piece, path, MONTH, key=["o_orderkey"])
    return _totals(readers.read_table(spark, path))


@query(
    f"""SELECT o_orderkey, {YEAR_MONTH} FROM orders ANTI JOIN (SELECT DISTINCT
        CASE WHEN year(l_shipdate) < 2000 THEN year(l_shipdate) ELSE -year(l_shipdate) END AS y,
        month(l_shipdate) AS m FROM lineitem) ON year(o_orderdate) = y AND month(o_orderdate) = m""",
    name="pending_files",
)
def pending_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of months that no published line covers; lines from 2000 on are in other years."""
    year = F.expr("IF(year(l_shipdate) < 2000, year(l_shipdate), -year(l_shipdate))")
    published = table(spark, sf_dir, "lineitem").select(year.alias("year"), F.month("l_shipdate").alias("month"))
    candidates = dated_orders(spark, sf_dir).select("o_orderkey", "year", "month")
    return pending(candidates, published, MONTH).select("o_orderkey", "year", "month")


@query(
    f"""SELECT {YEAR_MONTH}, count(*) AS n_orders, CAST(sum(CAST(CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE o_totalprice END
        AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY ALL"""
)
def publish_late_piece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months in key buckets; a late piece corrects the price of every fiftieth order and rewrites its buckets only."""
    path = new_dir(spark, "orders")
    orders = dated_orders(spark, sf_dir)
    late = orders.where("o_orderkey % 50 = 1").withColumn("o_totalprice", F.lit(1.0))
    for piece in (orders, late):
        publish_incremental(piece, path, MONTH, key=["o_orderkey"], buckets=8)
    return _totals(readers.read_table(spark, path))


@query(
    f"""SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS o_orderkey, o_orderkey AS line, {YEAR_MONTH} FROM orders"""
)
def publish_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows has no key. Published twice, by batch and by stream, all of them are there once."""
    path, source, schema = new_dir(spark, "orders"), new_dir(spark, "orders-source"), "o_orderkey long, line long, year int, month int"
    orders = dated_orders(spark, sf_dir).select(
        F.expr("IF(o_orderkey % 3 <> 0, o_orderkey, NULL)").alias("o_orderkey"), F.col("o_orderkey").alias("line"), *MONTH
    )
    orders.write.parquet(source)
    publish_incremental(orders, path, MONTH, key=["o_orderkey"])
    publish_incremental(orders, path, MONTH, key=["o_orderkey"])
    stream_files(spark, schema, source, path, new_dir(spark, "orders-checkpoint"), partition_by=MONTH, key=["o_orderkey"])
    return readers.read_table(spark, path).select("o_orderkey", "line", *MONTH)


@query("SELECT lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS st, count(*) AS n FROM orders GROUP BY 1")
def publish_text_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions that are text, though they look like numbers, are the same the second time."""
    path = new_dir(spark, "orders")
    orders = dated_orders(spark, sf_dir).select("o_orderkey", F.lpad(F.col("month").cast("string"), 2, "0").alias("st"))
    publish_incremental(orders, path, ["st"], key=["o_orderkey", "st"])
    publish_incremental(orders, path, ["st"], key=["o_orderkey", "st"])
    return readers.read_table(spark, path, schema=orders.schema).groupBy("st").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_nationkey, 2 * count(*) AS n FROM customer GROUP BY 1")
def publish_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is appended twice is there twice."""
    path = new_dir(spark, "customer")
    for _ in range(2):
        sinks.publish(table(spark, sf_dir, "customer"), path, mode="append")
    return readers.read_table(spark, path).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT 'four' AS kind, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_files FROM lineitem
       UNION ALL SELECT 'short', count(*), CAST(ceil(count(*) / 5000.0) AS BIGINT) FROM lineitem"""
)
def file_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in four files, and in as few files of at most 5,000 rows as hold it."""
    four, short, lines = new_dir(spark, "four"), new_dir(spark, "short"), table(spark, sf_dir, "lineitem")
    sinks.publish(lines, four, n_files=4)
    sinks.publish(lines, short, n_files=1, max_records_per_file=5000)

    def count(path: str, kind: str) -> DataFrame:
        files = readers.read_table(spark, path).groupBy(F.input_file_name().alias("file")).count()
        return files.agg(F.lit(kind).alias("kind"), F.sum("count").alias("n_rows"), F.count("file").alias("n_files"))

    return union_all(count(four, "four"), count(short, "short"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events", name="stream_files")
def stream_files_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same files; the second finds nothing new."""
    dst, checkpoint = new_dir(spark, "events"), new_dir(spark, "events-checkpoint")
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        stream_files(spark, schema, sf_dir, dst, checkpoint, partition_by=["event_type"], pathGlobFilter="events.parquet")
    published = readers.read_table(spark, dst)
    return published.select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with their own checkpoints deliver the same files; records are merged on their key."""
    dst = new_dir(spark, "events")
    schema = table(spark, sf_dir, "events").schema
    for i in range(2):
        stream_files(
            spark,
            schema,
            sf_dir,
            dst,
            new_dir(spark, f"events-checkpoint-{i}"),
            transform=lambda df: df.select("event_id", "user_id", "event_type", "value"),
            partition_by=["event_type"],
            key=["event_id"],
            pathGlobFilter="events.parquet",
        )
    return readers.read_table(spark, dst).select("event_id", "user_id", "event_type", "value")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as delimited text, scanned under a declared schema, landed and read back."""
    source = table(spark, sf_dir, "customer")
    path = new_dir(spark, "customer") + ".csv"
    source.write.options(header=True, sep=";").csv(path)
    scanned = readers.read_any(spark, path, schema=source.schema, sep=";")
    return sinks.land(scanned, new_dir(spark, "customer-landed"))


@query("SELECT DISTINCT o_custkey AS code, CAST(o_orderpriority AS VARCHAR) AS label FROM orders")
def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary lines written as text, scanned and parsed."""
    path = new_dir(spark, "lines") + ".txt"
    pairs = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()
    pairs.select(F.concat("o_custkey", F.lit(" =  '"), "o_orderpriority", F.lit("'"))).write.text(path)
    return readers.parse_dictionary(readers.read_any(spark, path), key_type="bigint")


@query(
    """SELECT s_suppkey AS supplier_key, s_name AS supplier_name,
              CASE WHEN s_nationkey < 10 THEN 'first' ELSE 'second' END AS batch FROM supplier"""
)
def land_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches land next to each other; each landing returns its own batch only."""
    target = new_dir(spark, "supplier")
    raw = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Supplier Key"), F.col("s_name").alias("Supplier Name"), "s_nationkey"
    )
    first = sinks.land(raw.where("s_nationkey < 10").drop("s_nationkey"), target, batch="first")
    second = sinks.land(raw.where("s_nationkey >= 10").drop("s_nationkey"), target, batch="second")
    return union_all(first.withColumn("batch", F.lit("first")), second.withColumn("batch", F.lit("second")))


@query(
    f"""SELECT 'fact' AS name, {YEAR_MONTH}, count(*) AS n FROM orders GROUP BY ALL
        UNION ALL SELECT 'time', CAST(year(d) AS INTEGER), CAST(month(d) AS INTEGER), count(*)
          FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL
        UNION ALL SELECT 'log', NULL, NULL, count(DISTINCT o_orderstatus) FROM orders"""
)
def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact, dates and the log of what was published become visible together, in three versions, one of them twice."""
    root, orders = new_dir(spark, "orders"), dated_orders(spark, sf_dir)
    for statuses in (["O"], ["F", "P"], ["O"]):
        piece = orders.where(F.col("o_orderstatus").isin(statuses))
        pieces = {
            "fact": Piece(piece, MONTH, key=["o_orderkey"]),
            "time": Piece(piece.select(F.col("arrival_date").alias("date"), *MONTH).distinct(), MONTH, key=["date"]),
            "log": Piece(piece.select("o_orderstatus").distinct(), [], key=["o_orderstatus"]),
        }
        publish_version(spark, root, pieces)
    count = lambda t, cols: read_version(spark, root, t).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    nothing = [F.lit(None).cast("int").alias(c) for c in MONTH]
    dated = [count(t, MONTH).select(F.lit(t).alias("name"), *MONTH, "n") for t in ("fact", "time")]
    return union_all(*dated, count("log", []).select(F.lit("log").alias("name"), *nothing, "n"))


_MONTH_LABEL = "strftime(o_orderdate, '%Y-%m')"


def _monthly_files(spark: SparkSession, sf_dir: str, columns: list[str]) -> dict[str, str]:
    """Orders as delimited text, a folder for each month; label -> folder."""
    path = new_dir(spark, "months")
    labelled = table(spark, sf_dir, "orders").selectExpr(*columns, "date_format(o_orderdate, 'yyyy-MM') AS month").hint("rebalance", "month")
    labelled.write.partitionBy("month").options(header=True).csv(path)
    months = labelled.select("month").distinct().collect()  # some dozen labels
    return {r.month: f"{path}/month={r.month}" for r in months}


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus, {_MONTH_LABEL} AS batch FROM orders")
def land_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files landed by one scan and one write; each row knows its file's label."""
    files = _monthly_files(spark, sf_dir, ["o_orderkey AS `Order Key`", "o_orderstatus"])
    return union_all(*sinks.land_files(spark, files, new_dir(spark, "landed"), fmt="csv")).select("order_key", "o_orderstatus", "batch")


_ODD_PRICE = "CASE WHEN o_orderkey % 7 = 0 THEN 'about ' || o_totalprice WHEN o_orderkey % 11 = 0 THEN '  ' ELSE CAST(o_totalprice AS VARCHAR) END"


@query(
    f"""SELECT {_MONTH_LABEL} AS batch, 'o_totalprice' AS "column", {_ODD_PRICE} AS text FROM orders WHERE o_orderkey % 7 = 0
        UNION ALL SELECT {_MONTH_LABEL}, 'o_orderkey', o_orderkey || '.5' FROM orders WHERE o_orderkey % 13 = 0
        UNION ALL SELECT {_MONTH_LABEL}, 'o_orderdate', 'no date' FROM orders WHERE o_orderstatus = 'P'"""
)
def rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the monthly files that does not have its declared type, with file, column and text; blanks are none."""
    odd = [
        "IF(o_orderkey % 13 = 0, concat(o_orderkey, '.5'), CAST(o_orderkey AS STRING)) AS o_orderkey",
        f"{_ODD_PRICE.replace('VARCHAR', 'STRING')} AS o_totalprice",
        "IF(o_orderstatus = 'P', 'no date', CAST(CAST(o_orderdate AS DATE) AS STRING)) AS o_orderdate",
    ]
    files = _monthly_files(spark, sf_dir, odd)
    raw = union_all(*sinks.land_files(spark, files, new_dir(spark, "landed"), fmt="csv"))
    typed = conform(raw, {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "date"}, rejects="rejects")
    return rejected(typed, "rejects", "batch")


@query(
    """SELECT 'rows' AS what, count(*) AS n FROM orders UNION ALL SELECT 'o_custkey', count(*) FILTER (o_custkey % 5 = 0) FROM orders
       UNION ALL SELECT 'o_orderkey', CAST(0 AS BIGINT)"""
)
def observed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and null keys counted by the write itself."""
    orders = dated_orders(spark, sf_dir).withColumn("o_custkey", F.expr("IF(o_custkey % 5 = 0, NULL, o_custkey)"))
    counts = sinks.publish(orders, new_dir(spark, "orders"), partition_by=MONTH, observe_nulls=["o_custkey", "o_orderkey"])
    return spark.createDataFrame(list(counts.items()), "what string, n long")


@query("SELECT DISTINCT p_name FROM part")
def reference_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "names")
    sinks.publish_reference(table(spark, sf_dir, "part").select("p_name").distinct(), path)
    return sinks.load_reference(spark, path)
