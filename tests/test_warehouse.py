"""The whole job on small raw files with the known irregularities."""

import dataclasses
import datetime as dt
import json

import pytest

import build_warehouse as build_warehouse_job
from stellate.operators import quality
from stellate.plans import arrivals as arr
from stellate.plans import fixed_values as fixed
from stellate.plans.warehouse import Inputs, build_warehouse, check_warehouse, fact_view, pending_inputs
from stellate.sources.readers import read_table
from stellate.streaming import stream_files

FILES = {
    "states.csv": "stusab;name;centlat;centlon;extra\nCA;California;37.2;-119.3;x\nCA;California;37.2;-119.3;y\nNY;New York;42.9;-75.6;z\n",
    "cities.csv": (
        "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;"
        "Average Household Size;State Code;Race;Count\n"
        "Fresno;California;30.0;100;110;210;1;2;2.5;CA;White;5\n"
        "Fresno;California;30.0;100;110;210;1;2;2.5;CA;Asian;7\n"
        "Albany;New York;31.5;;;50;1;2;2.1;NY;White;5\n"
    ),
    "iso.csv": (
        "Country,Alpha-2 code,Alpha-3 code,Numeric\nAfghanistan,AF,AFG,4\nColombia,CO,COL,170\nMexico,MX,MEX,484\n"
        "Russian Federation (the),RU,RUS,643\nDenmark,DK,DNK,208\nAland Islands,AX,ALA,248\n"
    ),
    "coordinates.csv": (
        "Country,Alpha-2 code,Alpha-3 code,Numeric code,Latitude (average),Longitude (average)\n"
        'Afghanistan," ""AF"""," ""AFG"""," ""4"""," ""33"""," ""65"""\n'
        'Colombia," ""CO"""," ""COL"""," ""170"""," ""4"""," ""-72"""\n'
        'Mexico," ""MX"""," ""MEX"""," ""484"""," ""23"""," ""-102"""\n'
        'Russian Federation," ""RU"""," ""RUS"""," ""643"""," ""60"""," ""100"""\n'
        'Russia," ""RU"""," ""RUS"""," ""643"""," ""60"""," ""100"""\n'
        'Denmark," ""DK"""," ""DNK"""," ""208"""," ""56"""," ""10"""\n'
    ),
    "former.csv": 'Former country name,New country names\nUSSR,Russian Federation\nCzechoslovakia,"[Czechia, Slovakia]"\n',
    "airports.csv": (
        "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates\n"
        'A1,small_airport,One,10,NA,US,US-AK,Nome,ZZ1,ZI1,L1,"64.5, -165.4"\n'
        'A1,small_airport,One,10,NA,US,US-AK,Nome,ZZ1,ZI1,L1,"64.5, -165.4"\n'
        'A2,small_airport,Two,,SA,CO,CO-DC,Bogota,ZZ2,0,,"4.7, -74.1"\n'
        'A3,small_airport,Three,,SA,CO,CO-DC,Cali,ZZ3,ZI3,,"0, 0"\n'
        'A4,small_airport,Four,,SA,CO,CO-DC,,ZZ4,ZI4,,"1.5, 2.5"\n'
    ),
    "ports.txt": "USAVO: Avoca, NY\nUSAVO: Avoca, NY\nUSZZ1: Port One, AK\nno separator\n",
    "temperatures.csv": (
        "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
        "1743-11-01 00:00:00,6.068,1.737,Aarhus,Denmark,57.05N,10.33E\n"
        "1743-11-01 00:00:00,6.068,1.737,Aarhus,Denmark,57.05N,10.33E\n"
        "1743-12-01 00:00:00,,,Aarhus,Denmark,57.05N,10.33E\n"
        "2013-01-01,25.5,0.3,Cali,Colombia,4.02S,76.34W\n"
        "2013-01-01,1.5,0.3,Moscow,Ussr,55.45N,36.85E\n"
        "2013-01-01,1.5,0.3,Atlantis,Qqqqq,55.45N,36.85E\n"
    ),
    "countries.txt": "236 =  'AFGHANISTAN'\n582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'\n"
    "299 =  'INVALID: USSR'\n54 =  'No Country Code (54)'",
    "port_lines.txt": (
        "'ALC'\t=\t'ALCAN, AK             '\n'AVO'\t=\t'No PORT Code (AVO)'\n'ZZ1'\t=\t'Collapsed (ZZ1) 06/15'\n"
        "'ZZ2'\t=\t'No PORT Code (ZZ2)'\n'ZZ4'\t=\t'No PORT Code (ZZ4)'\n'ZI1'\t=\t'No PORT Code (ZI1)'\n"
        "'BOG'\t=\t'BOGOTA, EL DORADO #ARPT, COLOMBIA'\n'UNK'\t=\t'UNKNOWN POE           '"
    ),
    "modes.txt": "1 = 'Air'\n2 = 'Sea'\n3 = 'Land'\n9 = 'Not reported'",
    "visas.txt": "1 = Business\n2 = Pleasure\n3 = Student",
}


def raw_arrivals(spark, month, ids, day=20454):
    columns = {
        "cicid": "double", "i94yr": "double", "i94mon": "double", "i94cit": "double", "i94res": "double", "i94port": "string",
        "arrdate": "double", "i94mode": "double", "i94addr": "string", "depdate": "double", "i94bir": "double",
        "i94visa": "double", "biryear": "string", "gender": "string", "airline": "string", "fltno": "string",
    }
    rows = [
        (
            float(i), 2016.0, float(month), None, 236.0 if i % 2 else 299.0, "ALC", day + i + 31.0 * (month - 1),
            1.0 if i % 2 else None, "CA", None if i % 3 == 0 else day + i + 40.0, 30.0, 2.0, "1980", None, "AA", "1",
        )
        for i in ids
    ]
    return spark.createDataFrame(rows + rows[:1], ", ".join(f"{c} {t}" for c, t in columns.items()))


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    for name, text in FILES.items():
        (raw / name).write_text(text)
    months = {}
    for m, ids in ((1, [1, 2, 3]), (2, [1, 2])):
        months[f"m{m}"] = f"{raw}/arrivals_{m}.parquet"
        raw_arrivals(spark, m, ids).write.parquet(months[f"m{m}"])
    p = lambda n: f"{raw}/{n}"
    inputs = Inputs(
        p("states.csv"), p("cities.csv"), p("iso.csv"), p("coordinates.csv"), p("former.csv"), p("airports.csv"),
        p("ports.txt"), p("temperatures.csv"), p("countries.txt"), p("port_lines.txt"), p("modes.txt"), p("visas.txt"), months,
    )
    out = str(tmp_path_factory.mktemp("out"))
    first = build_warehouse(spark, inputs, out)
    second = build_warehouse(spark, inputs, out)
    return inputs, out, first, second


def rows(spark, out, table, *cols):
    return {tuple(r) for r in read_table(spark, f"{out}/{table}").select(*cols).collect()}


def test_second_run_publishes_nothing_new(spark, job):
    inputs, out, first, second = job
    assert first == ["m1", "m2"] and second == []
    assert pending_inputs(spark, inputs, out) == []
    fact = read_table(spark, f"{out}/arrivals")
    assert {r.month: r["count"] for r in fact.groupBy("month").count().collect()} == {1: 3, 2: 2}
    assert quality.check_unique(fact, fixed.ARRIVAL_KEY).first().passed


def test_fact(spark, job):
    _, out, _, _ = job
    got = rows(spark, out, "arrivals", "cicid", "month", "arrival_date", "departure_date", "transport_mode", "visa_category")
    day = dt.date(2016, 1, 1)
    step = dt.timedelta
    assert got == {
        (1, 1, day + step(1), day + step(41), "Air", "Pleasure"),
        (2, 1, day + step(2), day + step(42), None, "Pleasure"),
        (3, 1, day + step(3), None, "Air", "Pleasure"),
        (1, 2, day + step(32), day + step(41), "Air", "Pleasure"),
        (2, 2, day + step(33), day + step(42), None, "Pleasure"),
    }
    want = (
        "cicid int, birth_year int, gender string, residence_country int, citizenship_country int, port_of_entry string, "
        "airline string, flight_no string, address_state string, arrival_date date, departure_date date, "
        "transport_mode string, visa_category string, year int, month int"
    )
    assert ", ".join(f"{c} {t}" for c, t in read_table(spark, f"{out}/arrivals").dtypes) == want


def test_time(spark, job):
    _, out, _, _ = job
    got = rows(spark, out, "time", "date", "year", "month", "day_of_month", "day_of_week", "week_of_year")
    assert (dt.date(2016, 1, 3), 2016, 1, 3, 1, 53) in {(d, y, m, a, b, c) for d, y, m, a, b, c in got} and len(got) == 5


def test_geography(spark, job):
    _, out, _, _ = job
    assert rows(spark, out, "state_boundaries", "state_code", "latitude") == {("CA", 37.2), ("NY", 42.9)}
    assert rows(spark, out, "city_demographics", "city", "male_population") == {("Fresno", 100)}
    assert rows(spark, out, "temperatures", "date", "country_iso3166", "latitude", "longitude") == {
        (dt.date(1743, 11, 1), "Denmark", 57.05, 10.33),
        (dt.date(2013, 1, 1), "Colombia", -4.02, -76.34),
        (dt.date(2013, 1, 1), "Russian Federation", 55.45, 36.85),
        (dt.date(2013, 1, 1), "No match found", 55.45, 36.85),
    }
    assert read_table(spark, f"{out}/temperatures").count() == 4
    assert rows(spark, out, "reference/country_names", "reference_country") == {
        (n,) for n in ("Afghanistan", "Aland Islands", "Colombia", "Denmark", "Mexico", "Russia", "Russian Federation")
    }
    assert rows(spark, out, "reference/airports", "ident", "latitude") == {("A1", 64.5), ("A2", 4.7), ("A4", 1.5)}


def test_dictionaries(spark, job):
    _, out, _, _ = job
    countries = rows(spark, out, "countries", "i94_cntyl_code", "country_iso3166", "country_code_iso3", "latitude")
    assert countries == {
        (236, "Afghanistan", "AFG", 33.0),
        (582, "Mexico", "MEX", 23.0),
        (299, "Russian Federation", "RUS", 60.0),
        (54, "No match found", None, None),
    }
    assert rows(spark, out, "ports", "i94_prtl_code", "reference_port_loc") == {
        ("ALC", "Alcan, AK"),
        ("AVO", "Avoca, NY"),
        ("ZZ1", "Port One, AK"),
        ("ZZ2", "Bogota, Colombia"),
        ("BOG", "Bogota, Colombia"),
        ("UNK", "Unknown code"),
    }


def test_reports(spark, job):
    _, out, _, _ = job
    fact = fact_view(spark, out)
    assert fact.count() == 5
    by_country = arr.monthly_by_country(
        read_table(spark, f"{out}/arrivals"), read_table(spark, f"{out}/countries"), "residence_country", "i94_cntyl_code",
        "country_iso3166",
    )
    assert {(r.month, r.country_iso3166): r.visitors for r in by_country.collect()} == {
        (1, "Afghanistan"): 2, (1, "Russian Federation"): 1, (2, "Afghanistan"): 1, (2, "Russian Federation"): 1,
    }
    best = {r.country: r.state for r in arr.favourite_per_group(fact, "country", "state").collect()}
    assert best == {"Afghanistan": "California", "Russian Federation": "California"}


def test_checks_stop_at_the_first_failure(spark, job):
    _, out, _, _ = job
    assert check_warehouse(spark, out) == list(fixed.TABLE_KEYS)
    with pytest.raises(ValueError, match="nowhere: check exists"):
        check_warehouse(spark, out, {"nowhere": ["x"], "arrivals": ["cicid"]})
    with pytest.raises(ValueError, match="not_null failed for 5 rows"):
        check_warehouse(spark, out, {"arrivals": ["cicid", "gender"]})


def test_the_fact_can_be_streamed(spark, job, tmp_path):
    src, dst, check = (str(tmp_path / d) for d in ("src", "dst", "check"))
    codes = lambda label: spark.createDataFrame([(1, "Air"), (2, "Pleasure")], f"code int, {label} string")
    modes, visas = codes("transport_mode"), codes("visa_category")
    for ids in ([1, 2], [2, 3]):
        batch = raw_arrivals(spark, 1, ids)
        batch.write.mode("append").parquet(src)
        stream_files(
            spark, batch.schema, src, dst, check, partition_by=["year", "month"], key=fixed.ARRIVAL_KEY,
            transform=lambda df: arr.arrivals(df, modes, visas),
        )
    got = {(r.cicid, r.transport_mode, r.visa_category) for r in read_table(spark, dst).collect()}
    assert got == {(1, "Air", "Pleasure"), (2, None, "Pleasure"), (3, "Air", "Pleasure")}
    assert read_table(spark, dst).count() == 3


def test_command_line(spark, job, tmp_path):
    inputs, out, _, _ = job
    config = tmp_path / "inputs.json"
    config.write_text(json.dumps(dataclasses.asdict(inputs)))
    assert build_warehouse_job.main([str(config), out]) == []
    assert build_warehouse_job.main([str(config), out, "--check-only"]) == list(fixed.TABLE_KEYS)
