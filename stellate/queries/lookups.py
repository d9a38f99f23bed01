"""Reference joins, lookup chains, fuzzy lookup and label conforming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import location_label
from ..operators import fuzzy, joins, labels
from ..plans import fixed_values as fixed
from ..sources.workspace import store
from .registry import best_match_sql, norm_sql, query, replace_sql, table, title_sql


@query(
    """SELECT c_custkey, c_nationkey, ref_key, ref_name, coalesce(ref_name, c_mktsegment) AS place
       FROM customer LEFT JOIN (
         SELECT CASE WHEN n_regionkey = 4 THEN -1 - n_nationkey ELSE n_nationkey END AS ref_key, n_name AS ref_name
           FROM nation
         UNION ALL SELECT n_nationkey, n_name || ' (' || r_name || ')' FROM nation
         JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey = 0) ON c_nationkey = ref_key"""
)
def enrich_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one region repeat in the reference and fan out; those of another are other numbers there."""
    return joins.enrich(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
        _repeating_reference(spark, sf_dir),
        {"c_nationkey": "ref_key"},
        prefer={"place": ("ref_name", "c_mktsegment")},
    ).drop("c_mktsegment")


@query(
    """SELECT c_custkey, c_nationkey, ref_key, ref_name, coalesce(ref_name, c_mktsegment) AS place
       FROM customer LEFT JOIN (SELECT n_nationkey AS ref_key, n_name AS ref_name FROM nation
         WHERE n_regionkey <> 4) ON c_nationkey = ref_key"""
)
def enrich_reference_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but only the first name of a repeated key is used."""
    return joins.enrich(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
        _repeating_reference(spark, sf_dir),
        {"c_nationkey": "ref_key"},
        prefer={"place": ("ref_name", "c_mktsegment")},
        fanout="first",
        order_by=["ref_name"],
    ).drop("c_mktsegment")


def _repeating_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    other = F.when(F.col("n_regionkey") == 4, -1 - F.col("n_nationkey")).otherwise(F.col("n_nationkey"))
    known = nation.select(other.alias("ref_key"), F.col("n_name").alias("ref_name"))
    alias = (
        nation.where("n_regionkey = 0")
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .select("n_nationkey", F.concat("n_name", F.lit(" ("), "r_name", F.lit(")")))
    )
    return known.union(alias)


@query(
    """SELECT s_suppkey, s_name, s_nationkey, n_name AS country, n_regionkey AS region FROM supplier
       LEFT JOIN nation ON s_nationkey = n_nationkey"""
)
def dictionary_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.attach_reference(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"),
        table(spark, sf_dir, "nation"),
        {"s_nationkey": "n_nationkey"},
        {"n_name": "country", "n_regionkey": "region"},
        fanout="error",
    )


@query(
    """SELECT o_orderkey, p_brand FROM orders LEFT JOIN (SELECT CASE WHEN p_size > 10 THEN p_partkey ELSE -p_partkey END AS k,
       p_brand FROM part) ON o_orderkey = k"""
)
def map_codes_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping too long for a literal is a frame; its keys are integers while the codes are doubles."""
    codes = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("double").alias("code"))
    key = F.when(F.col("p_size") > 10, F.col("p_partkey")).otherwise(-F.col("p_partkey"))
    mapping = table(spark, sf_dir, "part").select(key.cast("int").alias("key"), "p_brand")
    return joins.map_codes(codes, "code", mapping, "p_brand").drop("code")


@query(
    """SELECT c_custkey, coalesce(a, b, c) AS place FROM customer
       LEFT JOIN (SELECT CASE WHEN s_acctbal > 9000 THEN s_nationkey ELSE -1 - s_nationkey END AS k, min(s_name) AS a
                  FROM supplier GROUP BY 1) sa
         ON c_nationkey = sa.k
       LEFT JOIN (SELECT CASE WHEN n_regionkey = 2 THEN -1 - n_nationkey ELSE n_nationkey END AS k, min(n_name) AS b
                  FROM nation GROUP BY 1) sb
         ON c_nationkey = sb.k
       LEFT JOIN (SELECT s_nationkey AS k, min(CAST(s_suppkey AS VARCHAR)) AS c FROM supplier GROUP BY 1) sc
         ON c_nationkey = sc.k"""
)
def lookup_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return joins.lookup_chain(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        "c_nationkey",
        [
            (supplier.withColumn("k", F.expr("IF(s_acctbal > 9000, s_nationkey, -1 - s_nationkey)")), "k", "s_name"),
            (nation.withColumn("k", F.expr("IF(n_regionkey = 2, -1 - n_nationkey, n_nationkey)")), "k", "n_name"),
            (supplier.withColumn("id", F.col("s_suppkey").cast("string")), "s_nationkey", "id"),
        ],
        "place",
    ).select("c_custkey", "place")


@query(
    """SELECT s_suppkey, CASE WHEN r_name = 'AMERICA' THEN city || ', ' || n_nationkey ELSE city || ', ' || n_name END
         AS location
       FROM (SELECT *, CASE WHEN s_acctbal > 1000 THEN s_name END AS city FROM supplier) LEFT JOIN nation
         ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    name="location_label",
)
def location_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and state at home (one region), city and country elsewhere; a missing city gives null."""
    placed = joins.star(
        table(spark, sf_dir, "supplier").withColumn("city", F.when(F.col("s_acctbal") > 1000, F.col("s_name"))),
        [
            (
                table(spark, sf_dir, "nation").withColumn("iso2_region", F.concat(F.lit("US-"), "n_nationkey")),
                {"s_nationkey": "n_nationkey"},
                {"n_name": "n_name", "n_regionkey": "n_regionkey", "iso2_region": "iso2_region"},
            ),
            (table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}),
        ],
    )
    label = location_label("city", "r_name", "iso2_region", "n_name", home="AMERICA")
    return placed.select("s_suppkey", label.alias("location"))


# ---- joins of two long tables ------------------------------------------------------------------------------------

_JOINED = "SELECT l_orderkey, l_linenumber, o_orderstatus AS status FROM lineitem LEFT JOIN orders"


@query(f"{_JOINED} ON l_orderkey = o_orderkey")
def lookup_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides meet by shuffle."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders")
    return joins.attach_reference(lines, orders, {"l_orderkey": "o_orderkey"}, {"o_orderstatus": "status"}, small=False)


_HOT_KEY = "CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 10 = 1 THEN NULL ELSE l_orderkey END"


@query(
    f"""SELECT l_orderkey, l_linenumber, CAST(k AS BIGINT) AS k, o_orderstatus AS status
        FROM (SELECT *, {_HOT_KEY} AS k FROM lineitem) LEFT JOIN orders ON k = o_orderkey"""
)
def lookup_join_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows holds one key, a tenth has none; such rows are dealt to many tasks."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_HOT_KEY).cast("long").alias("k"))
    orders = table(spark, sf_dir, "orders")
    return joins.attach_reference(lines, orders, {"k": "o_orderkey"}, {"o_orderstatus": "status"}, small=False, hot=1000)


@query(
    """SELECT l_orderkey, l_linenumber, o_orderstatus AS status, p_brand AS brand, s_name AS supplier, n_name AS nation
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
         LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey"""
)
def star_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four dimensions by shuffle, the last one on a key that the third has added."""
    dims = [
        ("orders", {"l_orderkey": "o_orderkey"}, {"o_orderstatus": "status"}),
        ("part", {"l_partkey": "p_partkey"}, {"p_brand": "brand"}),
        ("supplier", {"l_suppkey": "s_suppkey"}, {"s_name": "supplier", "s_nationkey": "s_nationkey"}),
        ("nation", {"s_nationkey": "n_nationkey"}, {"n_name": "nation"}),
    ]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    found = joins.star(lines, [(table(spark, sf_dir, t), k, c) for t, k, c in dims], small=False, hot_rows=500)
    return found.select("l_orderkey", "l_linenumber", "status", "brand", "supplier", "nation")


@query(
    """SELECT l_orderkey, l_linenumber, label FROM lineitem LEFT JOIN (SELECT o_orderkey, min(flags) AS label
       FROM (SELECT l_orderkey AS o_orderkey, l_returnflag || l_linestatus AS flags FROM lineitem) GROUP BY 1) ON l_orderkey = o_orderkey"""
)
def map_codes_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes with several labels each take the smallest; no row is multiplied."""
    lines = table(spark, sf_dir, "lineitem")
    flags = lines.select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("flags"))
    return joins.map_codes(lines.select("l_orderkey", "l_linenumber"), "l_orderkey", flags, "label")


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey BETWEEN 1 AND 200 THEN 'part ' || l_partkey END AS label
       FROM lineitem"""
)
def map_codes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dict of 200 codes."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.map_codes(lines, "l_partkey", {i: f"part {i}" for i in range(1, 201)}, "label").drop("l_partkey")


# ---- fuzzy lookup: part names misspelt by a rule that depends on the part's type ---------------------------------

_MISSPELT = """CASE p_type WHEN 'PROMO' THEN replace(p_name, ' ', '') WHEN 'SMALL' THEN upper(p_name) || '!'
    WHEN 'ECONOMY' THEN reverse(p_name) WHEN 'LARGE' THEN replace(replace(p_name, 'o', '0'), 'l', '')
    WHEN 'MEDIUM' THEN 'the ' || p_name || ' deluxe edition' ELSE replace(p_name, 'e', 'ee') || 's' END"""

_LABELS = f"(SELECT p_partkey, {_MISSPELT} AS label FROM part)"


def _misspelt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.expr(_MISSPELT).alias("label"))


def _fuzzy_sql(min_score: int | None) -> str:
    return f"""WITH best AS ({best_match_sql(_LABELS, 'label', 'part', 'p_name', min_score)})
        SELECT p_partkey, label, coalesce(match, 'No match found') AS match, score FROM {_LABELS} LEFT JOIN best USING (label)"""


@query(_fuzzy_sql(70))
def fuzzy_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.fuzzy_lookup(_misspelt(spark, sf_dir), "label", table(spark, sf_dir, "part"), "p_name")


@query(_fuzzy_sql(None))
def fuzzy_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.fuzzy_lookup(_misspelt(spark, sf_dir), "label", table(spark, sf_dir, "part"), "p_name", min_score=None)


@query(_fuzzy_sql(70))
def fuzzy_lookup_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the blocks and word joins that a long reference list takes."""
    return fuzzy.fuzzy_lookup(_misspelt(spark, sf_dir), "label", table(spark, sf_dir, "part"), "p_name", max_packed=0)


# ---- and many distinct names: hashes of customers' names as words; suppliers have those of some customers, misspelt ---


def _hashed(name: str) -> str:
    return f"concat(substr(translate(base64(unhex(md5({name}))), '+/', 'ab'), 1, 5), ' ', substr(translate(base64(unhex(md5({name}))), '+/', 'ab'), 6, 9))"


_CUSTOMER = "concat('Customer#', lpad({}, 9, '0'))"


def _hashed_misspelt(key_as_text: str) -> str:
    name = _hashed(_CUSTOMER.format(key_as_text))
    return f"""CASE s_nationkey % 5 WHEN 0 THEN concat('x', {name}) WHEN 1 THEN substr({name}, 3, 20) WHEN 2 THEN upper({name})
        WHEN 3 THEN concat(substr({name}, 7, 9), '! ', substr({name}, 1, 4)) ELSE reverse({name}) END"""


_MANY = f"(SELECT s_suppkey, {_hashed_misspelt('CAST(s_suppkey AS VARCHAR)')} AS label FROM supplier)"
_MANY_NAMES = f"(SELECT {_hashed('c_name')} AS name FROM customer)"


def _many_sql(min_score: int | None) -> str:
    return f"""WITH best AS ({best_match_sql(_MANY, 'label', _MANY_NAMES, 'name', min_score)})
        SELECT s_suppkey, label, coalesce(match, 'No match found') AS match, score FROM {_MANY} LEFT JOIN best USING (label)"""


def _many(spark: SparkSession, sf_dir: str, min_score: int | None) -> DataFrame:
    # a table of one file is read by few tasks, and hashing costs more than reading; stored, as the lookup reads them repeatedly
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").repartition(tasks, "s_suppkey")
    customers = table(spark, sf_dir, "customer").select("c_name").repartition(tasks, "c_name")
    labelled = store(suppliers.select("s_suppkey", F.expr(_hashed_misspelt("CAST(s_suppkey AS STRING)")).alias("label")), "labelled")
    names = store(customers.select(F.expr(_hashed("c_name")).alias("name")), "names")
    return fuzzy.fuzzy_lookup(labelled, "label", names, "name", min_score, max_packed=100)


@query(_many_sql(70))
def fuzzy_lookup_many_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _many(spark, sf_dir, 70)


@query(_many_sql(None))
def fuzzy_best_many_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _many(spark, sf_dir, None)


_RETIRED_NAME = "CASE WHEN r_name = 'ASIA' THEN 'once ' || n_name ELSE n_name END"
_NATION_LABEL = """CASE c_mktsegment WHEN 'HOUSEHOLD' THEN lower(n_name) WHEN 'MACHINERY' THEN ' ' || n_name || '. '
    WHEN 'FURNITURE' THEN replace(n_name, '_', '-') ELSE c_name END"""


@query(
    f"""SELECT c_custkey, label, coalesce(r_name, label) AS country
        FROM (SELECT c_custkey, {_NATION_LABEL} AS label FROM customer JOIN nation ON c_nationkey = n_nationkey)
        LEFT JOIN (SELECT {norm_sql(_RETIRED_NAME)} AS norm, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) ON {norm_sql('label')} = norm"""
)
def resolve_former(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of all regions but one are retired in favour of their region; those of one were called otherwise."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    former = nation.join(region, F.expr("n_regionkey = r_regionkey")).select(F.expr(_RETIRED_NAME).alias("n_name"), "r_name")
    labelled = table(spark, sf_dir, "customer").join(nation, F.expr("c_nationkey = n_nationkey")).select(
        "c_custkey", F.expr(_NATION_LABEL).alias("label")
    )
    return fuzzy.resolve_former(labelled, "label", former, out="country")


_OTHER_REGION = "(SELECT r_regionkey AS k, replace(lower(r_name), 'a', 'e') AS near FROM region)"
_SUCCESSORS = """CASE n_nationkey % 3 WHEN 0 THEN near || ', ' || r_name WHEN 1 THEN r_name || ', ' || near ELSE near END"""
_RETIRED = f"""(SELECT n_name, {_SUCCESSORS} AS now FROM nation JOIN region ON n_regionkey = r_regionkey
    JOIN {_OTHER_REGION} ON (n_regionkey + 1) % 5 = k)"""


@query(
    f"""WITH labels AS (SELECT c_custkey, {_NATION_LABEL} AS label FROM customer JOIN nation ON c_nationkey = n_nationkey),
        cells AS (SELECT label, string_split(now, ', ') AS p FROM (SELECT DISTINCT label FROM labels)
                  LEFT JOIN {_RETIRED} ON {norm_sql('label')} = {norm_sql('n_name')}),
        candidates AS (SELECT label, CASE WHEN p IS NULL THEN label ELSE array_to_string(p[i : i + n - 1], ', ') END AS name, i, n
                       FROM (SELECT label, p, unnest(range(1, coalesce(len(p), 1) + 1)) AS i FROM cells), range(1, 3) AS t(n)
                       WHERE i + n - 1 <= coalesce(len(p), 1)),
        best AS ({best_match_sql('candidates', 'name', 'region', 'r_name')}),
        chosen AS (SELECT candidates.label, match FROM candidates LEFT JOIN best ON best.label = name
                   QUALIFY row_number() OVER (PARTITION BY candidates.label ORDER BY coalesce(score, -1) DESC, i, n) = 1)
        SELECT c_custkey, label, coalesce(match, 'No match found') AS region FROM labels LEFT JOIN chosen USING (label)"""
)
def former_successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retired nations with one or two successors, some misspelt; the nearest one counts."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    other = region.select(F.col("r_regionkey").alias("k"), F.expr("replace(lower(r_name), 'a', 'e')").alias("near"))
    retired = nation.join(region, F.expr("n_regionkey = r_regionkey")).join(other, F.expr("(n_regionkey + 1) % 5 = k"))
    now = F.expr(_SUCCESSORS)
    former = retired.select("n_name", now.alias("now"), F.split(now, ", ").alias("successors"))
    labelled = table(spark, sf_dir, "customer").join(nation, F.expr("c_nationkey = n_nationkey")).select("c_custkey", F.expr(_NATION_LABEL).alias("label"))
    return labels.standardise_labels(labelled, "label", "region", region, "r_name", former, clean=lambda c: c, guard_words=())


# ---- port labels: built from parts, brands and nations in every shape the formatter knows ------------------------

_PORT_TEXT = """CASE p_type WHEN 'PROMO' THEN upper(p_name) || ', ' || upper(substr(p_name, 1, 2))
    WHEN 'SMALL' THEN upper(p_name) || ' ARPT, HWY. STATION, N' || p_size || ' NATION'
    WHEN 'ECONOMY' THEN 'INVALID - ' || upper(p_name) || ' #ARPT, NATION ' || p_size
    WHEN 'LARGE' THEN upper(p_name) || '-ARPT,' || p_brand
    WHEN 'MEDIUM' THEN p_name || ' (BPS), ' || substr(p_name, 1, 1)
    ELSE '  ' || upper(p_name) || ' - WASHINGTON DC' END"""


_OLD_NATION = "CASE WHEN n_regionkey = 1 THEN 'NATION ' ELSE 'PLACE ' END || n_nationkey"


def _formatted_sql() -> str:
    noise = "t0"
    for word in fixed.PORT_NOISE:
        noise = f"replace(trim({noise}), '{word}', '')"
    return f"""
        WITH raw AS (SELECT p_partkey, {_PORT_TEXT} AS t0 FROM part),
        shaped AS (SELECT p_partkey, t0, t, string_split(t, ', ')[-1] AS last FROM (
            SELECT p_partkey, t0, {replace_sql(noise, fixed.PORT_REPLACEMENTS)} AS t FROM raw)),
        former AS (SELECT {norm_sql(f"({_OLD_NATION})")} AS fnorm, r_name FROM nation
            JOIN region ON n_regionkey = r_regionkey),
        countries AS (SELECT last, coalesce(r_name, last) AS cur FROM (
            SELECT DISTINCT last FROM shaped WHERE contains(t, ',') AND length(last) > 2)
            LEFT JOIN former ON {norm_sql('last')} = fnorm),
        names AS (SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region),
        best AS ({best_match_sql('countries', 'cur', 'names', 'name', None)})
        SELECT p_partkey, t0 AS label, CASE WHEN NOT contains(t, ',') THEN t
            WHEN length(shaped.last) > 2 THEN trim({title_sql("string_split(t, ', ')[1]")}) || ', ' || match
            WHEN length(shaped.last) = 2 THEN {title_sql("string_split(t, ',')[1]")} || ',' || string_split(t, ',')[-1]
            END AS reference_port_loc
        FROM shaped LEFT JOIN countries ON contains(t, ',') AND shaped.last = countries.last
        LEFT JOIN best ON best.label = cur"""


@query(_formatted_sql())
def format_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    former = (
        nation.join(region, F.expr("n_regionkey = r_regionkey"))
        .select(F.expr(_OLD_NATION).alias("old"), F.col("r_name").alias("new"))
    )
    names = nation.select(F.col("n_name").alias("name")).union(region.select("r_name"))
    raw = table(spark, sf_dir, "part").select("p_partkey", F.expr(_PORT_TEXT).alias("label"))
    return labels.format_location(raw, "label", names, "name", former)
