"""The published tables, built from raw inputs that are derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import union_all
from ..operators.incremental import publish_incremental
from ..operators.shape import sanitise_columns
from ..plans import arrivals as arr
from ..plans import dictionaries, geography
from ..plans import fixed_values as fixed
from ..plans.warehouse import check_warehouse
from ..sources import readers, sinks
from ..sources.workspace import new_dir
from .lookups import _PORT_TEXT
from .registry import SQL, YEAR_MONTH, best_match_sql, dated_orders, keyword_sql, norm_sql, query, replace_sql, table, title_sql


def _twice(df: DataFrame) -> DataFrame:
    return df.unionByName(df)


@query(
    """SELECT 'S' || s_suppkey AS state_code, s_name AS state_name, s_acctbal AS latitude,
              CAST(-s_suppkey AS DOUBLE) AS longitude FROM supplier"""
)
def state_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "supplier").selectExpr(
        "concat('S', s_suppkey) AS stusab",
        "s_name AS name",
        "s_acctbal AS centlat",
        "CAST(-s_suppkey AS DOUBLE) AS centlon",
        "s_nationkey AS region",
    )
    return geography.state_boundaries(_twice(raw))


@query(
    """SELECT 'ST' || c_nationkey AS state_code, c_mktsegment AS state, c_name AS city,
              CAST(c_custkey AS INTEGER) AS male_population, CAST(c_custkey + 1 AS INTEGER) AS female_population,
              c_acctbal AS median_age FROM customer WHERE c_nationkey <> 3"""
)
def city_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two races per city; one state has no populations."""
    city = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS City",
        "c_mktsegment AS State",
        "c_acctbal AS `Median Age`",
        "CAST(CASE WHEN c_nationkey <> 3 THEN c_custkey END AS INT) AS `Male Population`",
        "CAST(c_custkey + 1 AS INT) AS `Female Population`",
        "concat('ST', c_nationkey) AS `State Code`",
    )
    races = F.explode(F.array(F.lit("first race"), F.lit("second race"))).alias("Race")
    return geography.city_demographics(sanitise_columns(city.select("*", races)))


def _iso_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise_columns(
        table(spark, sf_dir, "supplier").selectExpr(
            "s_name AS Country",
            "concat('A', s_suppkey) AS `Alpha-2 code`",
            "concat('B', s_suppkey) AS `Alpha-3 code`",
            "CAST(s_suppkey AS INT) AS Numeric",
        )
    )


_ISO_SQL = """SELECT s_name AS iban_country, 'A' || s_suppkey AS iban_iso2, 'B' || s_suppkey AS iban_iso3,
              s_nationkey FROM supplier"""


@query(f"SELECT iban_country, iban_iso2, iban_iso3 FROM ({_ISO_SQL})")
def iso_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geography.iso_codes(_iso_raw(spark, sf_dir))


def _coordinates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted cells; suppliers of nation 0 occur under a second name, those of nation 1 under other codes."""
    quoted = lambda c: f"""concat(' "', {c}, '"')"""
    cells = [
        "country AS Country",
        f"{quoted('concat(chr(65), code)')} AS `Alpha-2 code`",
        f"{quoted('concat(chr(66), code)')} AS `Alpha-3 code`",
        f"{quoted('s_suppkey')} AS `Numeric code`",
        f"{quoted('s_acctbal')} AS `Latitude (average)`",
        f"{quoted('-s_acctbal')} AS `Longitude (average)`",
    ]
    known = table(spark, sf_dir, "supplier").withColumn("code", F.expr("IF(s_nationkey = 1, -s_suppkey, s_suppkey)"))
    named = known.withColumn("country", F.concat(F.lit("Land of "), "s_name"))
    again = known.where("s_nationkey = 0").withColumn("country", F.concat("s_name", F.lit(" (also)")))
    return sanitise_columns(named.unionByName(again).selectExpr(*cells))


_COORDINATES_SQL = """SELECT 'B' || code AS ccc_iso3, 'A' || code AS ccc_iso2, country AS ccc_country,
      s_acctbal AS ccc_lat, -s_acctbal AS ccc_long
    FROM (SELECT *, CASE WHEN s_nationkey = 1 THEN -s_suppkey ELSE s_suppkey END AS code, 'Land of ' || s_name AS country
          FROM supplier
          UNION ALL SELECT *, s_suppkey, s_name || ' (also)' FROM supplier WHERE s_nationkey = 0)"""


@query(_COORDINATES_SQL)
def code_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geography.code_coordinates(_coordinates_raw(spark, sf_dir))


_WORLD_SQL = f"""SELECT iban_country, iban_iso2, iban_iso3, ccc_iso3, ccc_iso2, ccc_country, ccc_lat, ccc_long,
      coalesce(ccc_country, iban_country) AS reference_country
    FROM ({_ISO_SQL}) LEFT JOIN ({_COORDINATES_SQL}) ON iban_iso3 = ccc_iso3"""


def _world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geography.world_reference(
        geography.iso_codes(_iso_raw(spark, sf_dir)), geography.code_coordinates(_coordinates_raw(spark, sf_dir))
    )


@query(_WORLD_SQL)
def world_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _world(spark, sf_dir)


@query(f"SELECT DISTINCT reference_country FROM ({_WORLD_SQL})")
def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geography.country_names(_world(spark, sf_dir))


@query(
    """SELECT p_brand || ' ' || p_partkey AS former_country_name,
              CASE WHEN p_type = 'PROMO' THEN '[' || p_name || ', ' || p_brand || ']' ELSE p_name END AS new_country_names,
              CASE WHEN p_type = 'PROMO' THEN p_name || '|' || p_brand ELSE p_name END AS successors FROM part"""
)
def former_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "part").selectExpr(
        "concat(p_brand, ' ', p_partkey) AS `Former country name`",
        "CASE WHEN p_type = 'PROMO' THEN concat('[', p_name, ', ', p_brand, ']') ELSE p_name END AS `New country names`",
    )
    former = geography.former_countries(sanitise_columns(raw))
    return former.withColumn("successors", F.array_join("successors", "|"))


def _airports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('ID', s_suppkey) AS ident",
        "'small_airport' AS type",
        "s_name AS name",
        "CAST(s_suppkey AS INT) AS elevation_ft",
        "'NA' AS continent",
        "CASE WHEN s_nationkey < 5 THEN 'US' ELSE concat('N', s_nationkey) END AS iso_country",
        "concat('US-', s_nationkey) AS iso_region",
        "CASE WHEN s_acctbal > 500 THEN concat('City ', s_suppkey) END AS municipality",
        "concat('P', s_suppkey) AS gps_code",
        "CASE WHEN s_nationkey = 6 THEN '0' ELSE concat('P', s_suppkey + 3) END AS iata_code",
        "'local' AS local_code",
        "CASE WHEN s_nationkey = 2 THEN '0, 0' ELSE concat(s_acctbal, ', ', -s_suppkey) END AS coordinates",
    )


_AIRPORTS_SQL = """SELECT 'ID' || s_suppkey AS ident, 'small_airport' AS type, s_name AS name,
      CAST(s_suppkey AS INTEGER) AS elevation_ft, 'NA' AS continent,
      CASE WHEN s_nationkey < 5 THEN 'US' ELSE 'N' || s_nationkey END AS iso2_country,
      'US-' || s_nationkey AS iso2_region, CASE WHEN s_acctbal > 500 THEN 'City ' || s_suppkey END AS municipality,
      'P' || s_suppkey AS gps_code, CASE WHEN s_nationkey = 6 THEN '0' ELSE 'P' || (s_suppkey + 3) END AS iata_code,
      s_acctbal AS latitude, CAST(-s_suppkey AS DOUBLE) AS longitude
    FROM supplier WHERE s_nationkey <> 2"""


@query(_AIRPORTS_SQL)
def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geography.airports(_twice(_airports_raw(spark, sf_dir)))


@query(
    """SELECT DISTINCT substr(c_mktsegment, 1, 3) AS us_port_city_code, n_name || ', ' || c_mktsegment AS us_locode_loc
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
)
def port_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
        .selectExpr("concat('US', substr(c_mktsegment, 1, 3), ': ', n_name, ', ', c_mktsegment) AS value")
    )
    return geography.port_codes(lines)


# ---- country names shared by the next tables: nations and regions; those of region 1 are retired, others have
# retired names of their own -----------


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.select(F.col("n_name").alias("reference_country")).union(region.select("r_name"))


_OLD_NAME = "CASE WHEN n_regionkey = 1 THEN n_name ELSE 'once ' || n_name END"


def _former(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, F.expr("n_regionkey = r_regionkey"))
        .select(F.expr(_OLD_NAME).alias("former_country_name"), F.col("r_name").alias("new_country_names"))
    )


_NAMES_SQL = "names AS (SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region)"
_FORMER_SQL = f"""former AS (SELECT {norm_sql(f'({_OLD_NAME})')} AS fnorm, r_name FROM nation
    JOIN region ON n_regionkey = r_regionkey)"""


def _standardised_sql(source: str, col: str, cleaned: str | None = None, min_score: int | None = 70) -> str:
    """CTEs that end in ``std(label, country_iso3166)``."""
    if cleaned is None:
        cut = f"string_split({title_sql(f'trim({keyword_sql(col, fixed.COUNTRY_SHORTCUTS)})')}, ' (')[1]"
        cleaned = replace_sql(cut, fixed.COUNTRY_REPLACEMENTS)
    return f"""{_NAMES_SQL}, {_FORMER_SQL},
        cleaned AS (SELECT label, {keyword_sql('c', fixed.COUNTRY_KEYWORDS)} AS c FROM
            (SELECT DISTINCT {col} AS label, {cleaned} AS c FROM {source} WHERE {col} IS NOT NULL)),
        cur AS (SELECT label AS raw, coalesce(r_name, c) AS c FROM cleaned LEFT JOIN former ON {norm_sql('c')} = fnorm),
        best AS ({best_match_sql('cur', 'c', 'names', 'name', min_score)}),
        std AS (SELECT raw AS label, coalesce(match, 'No match found') AS country_iso3166
                FROM cur LEFT JOIN best ON best.label = cur.c)"""


_EVENT_PLACE = """CASE event_type WHEN 'click' THEN 'Invalid: ' || n_name WHEN 'error' THEN n_name || ' (part)'
    WHEN 'view' THEN 'x' || n_name WHEN 'signup' THEN 'nowhere' ELSE n_name END"""


@query(
    f"""WITH raw AS (SELECT DISTINCT CAST(ts AS DATE) AS date, {_EVENT_PLACE} AS country, 'City ' || user_id AS city,
               value AS averagetemperature, value / 4 AS averagetemperatureuncertainty,
               CAST(user_id AS DOUBLE) + 0.5 AS latitude,
               CASE WHEN event_type = 'view' THEN -1.0 ELSE 1.0 END * (CAST(user_id AS DOUBLE) + 0.25) AS longitude
             FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
             WHERE value >= 2),
        {_standardised_sql('raw', 'country')}
        SELECT date, country_iso3166, city, averagetemperature, averagetemperatureuncertainty, latitude, longitude
        FROM raw LEFT JOIN std ON country = label"""
)
def temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from events; small values are missing, every reading occurs twice."""
    raw = (
        table(spark, sf_dir, "events")
        .join(table(spark, sf_dir, "customer"), F.expr("user_id = c_custkey"), "left")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
        .selectExpr(
            "CAST(ts AS STRING) AS dt",
            "CASE WHEN value >= 2 THEN value END AS AverageTemperature",
            "value / 4 AS AverageTemperatureUncertainty",
            "concat('City ', user_id) AS City",
            f"{_EVENT_PLACE} AS Country",
            "concat(user_id, '.5N') AS Latitude",
            "concat(user_id, '.25', CASE WHEN event_type = 'view' THEN 'W' ELSE 'E' END) AS Longitude",
        )
    )
    return geography.temperatures(sanitise_columns(_twice(raw)), _names(spark, sf_dir), _former(spark, sf_dir))


_LINE_LABEL = """CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'INVALID: ' || n_name WHEN 'MACHINERY' THEN lower(n_name)
    WHEN 'FURNITURE' THEN n_name || ' (FORMER)' WHEN 'BUILDING' THEN 'No Country Code (' || c_custkey || ')'
    ELSE replace(n_name, 'T', '') END"""


@query(
    f"""WITH raw AS (SELECT c_custkey AS code, '  ''' || {_LINE_LABEL} || '''' AS lab FROM customer
                     JOIN nation ON c_nationkey = n_nationkey),
        {_standardised_sql('raw', 'lab')},
        world AS (SELECT n_name AS name, 'C' || n_nationkey AS iso3, CAST(n_nationkey AS DOUBLE) AS lat,
                         CAST(-n_regionkey AS DOUBLE) AS long FROM nation
                  UNION ALL SELECT n_name, 'D' || n_nationkey, 0.5, 0.5 FROM nation WHERE n_regionkey = 0)
        SELECT code AS i94_cntyl_code, lab AS country_i94, country_iso3166, iso3 AS country_code_iso3,
               lat AS latitude, long AS longitude
        FROM raw LEFT JOIN std ON lab = label LEFT JOIN world ON country_iso3166 = name"""
)
def country_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines from customers. The countries of one region have two codes, so their lines fan out."""
    nation = table(spark, sf_dir, "nation")
    lines = table(spark, sf_dir, "customer").join(nation, F.expr("c_nationkey = n_nationkey")).select(
        F.concat("c_custkey", F.lit(" =  '"), F.expr(_LINE_LABEL), F.lit("'")).alias("value")
    )
    one = nation.selectExpr(
        "n_name AS reference_country",
        "concat('C', n_nationkey) AS iban_iso3",
        "CAST(n_nationkey AS DOUBLE) AS ccc_lat",
        "CAST(-n_regionkey AS DOUBLE) AS ccc_long",
    )
    two = nation.where("n_regionkey = 0").selectExpr(
        "n_name AS reference_country",
        "concat('D', n_nationkey) AS iban_iso3",
        "CAST(0.5 AS DOUBLE) AS ccc_lat",
        "CAST(0.5 AS DOUBLE) AS ccc_long",
    )
    return dictionaries.country_dictionary(
        lines, _names(spark, sf_dir), _former(spark, sf_dir), one.unionByName(two)
    )


_PORT_LABEL = f"""CASE WHEN p_size < 10 THEN 'No PORT Code (' || p_partkey || ')' WHEN p_size < 20 THEN 'Collapsed (x)'
    ELSE {_PORT_TEXT} END"""


def _port_format_sql() -> str:
    noise = "lab"
    for word in fixed.PORT_NOISE:
        noise = f"replace(trim({noise}), '{word}', '')"
    return replace_sql(noise, fixed.PORT_REPLACEMENTS)


def _port_dictionary_sql(use_iata: bool) -> str:
    iata = "WHEN ia.loc IS NOT NULL THEN ia.loc" if use_iata else ""
    return f"""
        WITH raw AS (SELECT 'P' || p_partkey AS code, trim({_PORT_LABEL}) AS lab FROM part),
        unusable AS (SELECT * FROM raw WHERE lab LIKE 'No PORT Code%' OR lab LIKE 'Collapsed%'),
        air AS (SELECT gps_code, iata_code, CASE WHEN iso2_country = 'US' THEN municipality || ', ' ||
                    string_split(iso2_region, '-')[2] ELSE municipality || ', ' || n_name END AS loc
                FROM ({_AIRPORTS_SQL}) LEFT JOIN nation ON iso2_country = 'N' || n_nationkey),
        gps AS (SELECT gps_code AS k, min(loc) AS loc FROM air GROUP BY 1),
        ia AS (SELECT iata_code AS k, min(loc) AS loc FROM air WHERE iata_code <> '0' GROUP BY 1),
        ports AS (SELECT CASE WHEN c_acctbal > 8000 THEN 'P' ELSE 'Q' END || c_custkey AS k, min(c_name) AS loc FROM customer GROUP BY 1),
        found AS (SELECT code, lab, CASE WHEN ports.loc IS NOT NULL THEN ports.loc WHEN gps.loc IS NOT NULL THEN gps.loc
                    {iata} END AS loc
                  FROM unusable LEFT JOIN ports ON code = ports.k LEFT JOIN gps ON code = gps.k LEFT JOIN ia ON code = ia.k),
        usable AS (SELECT *, string_split(t, ', ')[-1] AS last FROM (SELECT code, lab, {_port_format_sql()} AS t FROM raw
                   WHERE NOT (lab LIKE 'No PORT Code%' OR lab LIKE 'Collapsed%'))),
        {_NAMES_SQL}, {_FORMER_SQL},
        countries AS (SELECT last, coalesce(r_name, last) AS cur FROM (SELECT DISTINCT last FROM usable
                      WHERE contains(t, ',') AND length(last) > 2) LEFT JOIN former ON {norm_sql('last')} = fnorm),
        best AS ({best_match_sql('countries', 'cur', 'names', 'name', None)})
        SELECT code AS i94_prtl_code, lab AS portloc_state_i94, CASE WHEN NOT contains(t, ',') THEN t
            WHEN length(usable.last) > 2 THEN trim({title_sql("string_split(t, ', ')[1]")}) || ', ' || match
            WHEN length(usable.last) = 2 THEN {title_sql("string_split(t, ',')[1]")} || ',' || string_split(t, ',')[-1]
            END AS reference_port_loc
        FROM usable LEFT JOIN countries ON contains(t, ',') AND usable.last = countries.last
        LEFT JOIN best ON best.label = cur
        UNION ALL SELECT code, lab, loc FROM found WHERE loc IS NOT NULL"""


def _port_dictionary(spark: SparkSession, sf_dir: str, use_iata: bool) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(
        F.concat(F.lit("'P"), "p_partkey", F.lit("'\t=\t'"), F.expr(_PORT_LABEL), F.lit("'")).alias("value")
    )
    iso = table(spark, sf_dir, "nation").selectExpr("n_name AS iban_country", "concat('N', n_nationkey) AS iban_iso2")
    ports = table(spark, sf_dir, "customer").selectExpr(
        "concat(IF(c_acctbal > 8000, 'P', 'Q'), c_custkey) AS us_port_city_code", "c_name AS us_locode_loc"
    )
    return dictionaries.port_dictionary(
        lines,
        geography.airports(_airports_raw(spark, sf_dir)),
        iso,
        ports,
        _names(spark, sf_dir),
        _former(spark, sf_dir),
        use_iata,
    )


@query(_port_dictionary_sql(use_iata=False))
def port_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines from parts; a third have no usable label and take a port or airport location, or vanish."""
    return _port_dictionary(spark, sf_dir, use_iata=False)


@query(_port_dictionary_sql(use_iata=True))
def port_dictionary_with_iata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _port_dictionary(spark, sf_dir, use_iata=True)


# ---- the fact ----------------------------------------------------------------------------------------------------


def _arrivals_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated_orders(spark, sf_dir).selectExpr(
        "CAST(o_orderkey AS DOUBLE) AS cicid",
        "CAST(year AS DOUBLE) AS i94yr",
        "CAST(month AS DOUBLE) AS i94mon",
        "CAST(year - 30 AS STRING) AS biryear",
        "nullif(o_orderstatus, 'P') AS gender",
        "CAST(o_custkey AS DOUBLE) AS i94res",
        "CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS DOUBLE) END AS i94cit",
        "CAST(datediff(arrival_date, DATE '1960-01-01') AS DOUBLE) AS arrdate",
        "CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS i94mode",
        "substr(o_orderpriority, 3, 3) AS i94port",
        "o_orderpriority AS airline",
        "CAST(o_orderkey AS STRING) AS fltno",
        "CAST(ascii(o_orderstatus) AS DOUBLE) AS i94visa",
        "CAST(o_custkey AS STRING) AS i94addr",
        "CASE WHEN o_orderstatus <> 'O' THEN CAST(datediff(arrival_date, DATE '1960-01-01') + 14 AS DOUBLE) END AS depdate",
        "o_totalprice AS admnum",
    )


def _arrivals_sql(missing: str) -> str:
    return f"""SELECT CAST(o_orderkey AS INTEGER) AS cicid, {YEAR_MONTH},
          CAST(year(o_orderdate) - 30 AS INTEGER) AS birth_year, nullif(o_orderstatus, 'P') AS gender,
          CAST(o_custkey AS INTEGER) AS residence_country,
          CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS INTEGER) END AS citizenship_country,
          substr(o_orderpriority, 3, 3) AS port_of_entry, o_orderpriority AS airline,
          CAST(o_orderkey AS VARCHAR) AS flight_no, CAST(o_custkey AS VARCHAR) AS address_state,
          CAST(o_orderdate AS DATE) AS arrival_date,
          CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 14 ELSE {missing} END AS departure_date,
          CASE WHEN o_orderpriority NOT IN ('3-MEDIUM', '5-LOW') THEN substr(o_orderpriority, 3) END AS transport_mode,
          'Visa ' || o_orderstatus AS visa_category
        FROM orders"""


def _code_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dictionary lines come many times; the mode dictionary has another code for one mode."""
    orders = table(spark, sf_dir, "orders")
    mode_lines = orders.selectExpr(
        "concat(IF(o_orderpriority = '5-LOW', '9', substr(o_orderpriority, 1, 1)), \" = '\", substr(o_orderpriority, 3), \"'\") AS value"
    )
    visa_lines = orders.selectExpr("concat(ascii(o_orderstatus), ' = Visa ', o_orderstatus) AS value")
    return dictionaries.code_labels(mode_lines, "transport_mode"), dictionaries.code_labels(visa_lines, "visa_category")


def _arrivals(spark: SparkSession, sf_dir: str, missing: int | None) -> DataFrame:
    """Raw arrivals come twice."""
    return arr.arrivals(_twice(_arrivals_raw(spark, sf_dir)), *_code_labels(spark, sf_dir), missing)


@query(_arrivals_sql("NULL"))
def arrivals_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrivals(spark, sf_dir, None)


@query(_arrivals_sql("DATE '1960-01-01'"))
def arrivals_fact_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrivals(spark, sf_dir, 0)


@query(
    f"""SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, {YEAR_MONTH}, CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
        CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year
        FROM orders"""
)
def time_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arr.time_dimension(dated_orders(spark, sf_dir))


@query(_arrivals_sql("NULL").replace("CAST(o_orderkey AS INTEGER) AS cicid", "CASE WHEN o_orderkey % 100 <> 7 THEN CAST(o_orderkey AS INTEGER) END AS cicid"))
def arrivals_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as delimited text: numbers are texts such as 5748517.0, some keys are no numbers. Published twice."""
    path, out = new_dir(spark, "arrivals") + ".csv", new_dir(spark, "fact")
    bad = F.when(F.col("i94addr").isNotNull() & (F.col("cicid") % 100 == 7), "no number").otherwise(F.col("cicid").cast("string"))
    _arrivals_raw(spark, sf_dir).withColumn("cicid", bad).write.options(header=True).csv(path)
    fact = arr.arrivals(readers.read_any(spark, path), *_code_labels(spark, sf_dir), distinct=False)
    for _ in range(2):
        publish_incremental(fact, out, ["year", "month"], key=fixed.ARRIVAL_KEY)
    return readers.read_table(spark, out, schema=fact.schema).select(fact.columns)


_PUBLISHED = {
    "state_boundaries": state_boundaries, "city_demographics": city_demographics, "countries": country_dictionary,
    "ports": port_dictionary, "arrivals": arrivals_fact, "temperatures": temperatures, "time": time_dimension,
}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM ({SQL[q.__name__]})" for t, q in _PUBLISHED.items()))
def warehouse_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of the job published and checked by its own suite, which names those that passed."""
    out = new_dir(spark, "warehouse")
    made = {f"{out}/{name}": lambda build=build: build(spark, sf_dir).hint("rebalance") for name, build in _PUBLISHED.items()}
    sinks.publish_together(made)
    passed = check_warehouse(spark, out)
    count = lambda t: readers.read_table(spark, f"{out}/{t}").agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
    return union_all(*[count(t) for t in passed])
