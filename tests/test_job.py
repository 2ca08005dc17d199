"""The submitted job, the session and reading files by header name."""

import pytest

from sparkcivic import job, session
from sparkcivic.plans import city
from sparkcivic.sources import Source, ingest, read_csv
from sparkcivic.sources.schemas import CRIME

NAMES = [f.name for f in CRIME.fields]
ROWS = [
    {"DR_NO": "1", "DATE OCC": "01/08/2020 12:00:00 AM", "AREA NAME": "Central", "Status Desc": "Adult Arrest",
     "Crm Cd Desc": '"ASSAULT, AGGRAVATED ASSAULT"', "Vict Age": "30", "Mocodes": "0400 1100", "LAT": "34.05", "LON": "-118.25"},
    {"DR_NO": "2", "DATE OCC": "02/09/2020 11:00:00 PM", "AREA NAME": "Harbor", "Status Desc": "UNK",
     "Crm Cd Desc": "aggravated assault", "Vict Age": "16", "Mocodes": "0913", "LAT": "33.76", "LON": "-118.28"},
]


def crime_file(path, rows, names, pad=""):
    lines = [",".join(pad + n + pad for n in names)] + [",".join(r.get(n, "") for n in names) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def raw(tmp_path):
    """Two eras: the second has padded names in reverse order and one more column."""
    (tmp_path / "mo.txt").write_text("0400 Strong-arm\n1100 Hand gun\n0913 Weapon: knife\nbad\n")
    (tmp_path / "stations.csv").write_text("X,Y,DIVISION\n-118.25,34.05,CENTRAL \n-118.28,33.75,HARBOR\n")
    (tmp_path / "income.csv").write_text('Zip Code,Community,Estimated Median Income\n90001,"A, b","$30,000"\n90002,c,-\n')
    (tmp_path / "census.csv").write_text("Zip Code,Average Household Size\n90001,3.0\n90002,n/a\n")
    return {"crime_2010_2019": crime_file(tmp_path / "c1.csv", ROWS[:1], NAMES),
            "crime_2020_present": crime_file(tmp_path / "c2.csv", ROWS[1:], ["extra", *reversed(NAMES)], " "),
            "la_police_stations": str(tmp_path / "stations.csv"), "la_income_2015": str(tmp_path / "income.csv"),
            "census_2010_zipcode": str(tmp_path / "census.csv"), "mo_codes": str(tmp_path / "mo.txt")}


def test_read_crime_csv_by_name(spark, raw):
    crime = city.read_crime(spark, [raw["crime_2010_2019"], raw["crime_2020_present"]], fmt="csv")
    got = {r["DR_NO"]: r for r in crime.collect()}
    assert len(got) == 2 and {r["AREA NAME"] for r in got.values()} == {"Central", "Harbor"}
    assert sorted(r["Vict Age"] for r in got.values()) == [16, 30] and all(r["LAT"] > 33 for r in got.values())


def test_header_decides_and_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('inc,zip\n"$30,000",90001\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv"), "zip string, inc string").collect()] == [("90001", "$30,000")]
    with pytest.raises(ValueError, match="no column hh"):
        read_csv(spark, str(tmp_path / "a.csv"), "zip string, hh double")
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "d"), "a int, b int").collect()


def test_ingest_keeps_the_message(spark, tmp_path):
    row = ingest(spark, [Source("x", str(tmp_path / "none"), "csv")], str(tmp_path / "out")).collect()[0]
    assert not row["ok"] and row["error"] == "PATH_NOT_FOUND" and "none" in row["message"]


def test_all_jobs_from_raw_files(spark, raw, tmp_path):
    out = str(tmp_path / "prepared")
    job.main(["prepare", "--out", out, *[x for k, v in raw.items() for x in ("--raw", f"{k}={v}")]], spark)
    crime = [f"{out}/crime_2010_2019", f"{out}/crime_2020_present"]

    def run(*args):
        path = str(tmp_path / args[0])
        job.main([*args, "--out", path, "--write", "parquet"], spark)
        return {tuple(r) for r in spark.read.parquet(path).collect()}
    assert run("age-bands", "--crime", *crime) == {("Adults", 1), ("Children", 1)}
    assert run("top-areas", "--crime", *crime, "--variant", "sql") == {(2020, "Central", 100.0, 1), (2020, "Harbor", 0.0, 2)}
    assert run("income", "--income", f"{out}/la_income_2015", "--census", f"{out}/census_2010_zipcode") == {("90001", 10000.0)}
    near = run("nearest-station", "--crime", *crime, "--mo-codes", f"{out}/mo_codes", "--stations", f"{out}/la_police_stations")
    assert {(r[0], r[2]) for r in near} == {("CENTRAL", 1), ("HARBOR", 1)}


def test_jobs_on_raw_csv_and_text(spark, raw, tmp_path):
    """No preparation: nothing is inferred, a ZIP keeps its zeros and a coordinate that is none is no site."""
    (tmp_path / "income0.csv").write_text('Zip Code,Estimated Median Income\n00601,"$30,000"\n90002,-\n')
    (tmp_path / "census0.csv").write_text("Zip Code,Average Household Size\n00601,3.0\n90002,n/a\n")
    (tmp_path / "stations0.csv").write_text("X,Y,DIVISION\n-118.25,34.05,CENTRAL\nunknown,33.75,NOWHERE\n-118.28,33.75,HARBOR\n")
    (tmp_path / "codes.csv").write_text("MO_Code,Description\n1100,Hand gun\n0913,Weapon: knife\nx,gun\n")
    crime = [raw["crime_2010_2019"], raw["crime_2020_present"]]

    def run(name, *args):
        job.main([*args, "--format", "csv", "--out", str(tmp_path / name), "--write", "parquet"], spark)
        return {tuple(r) for r in spark.read.parquet(str(tmp_path / name)).collect()}
    assert run("i", "income", "--income", str(tmp_path / "income0.csv"), "--census", str(tmp_path / "census0.csv")) == {("00601", 10000.0)}
    near = ["nearest-station", "--crime", *crime, "--stations", str(tmp_path / "stations0.csv"), "--mo-codes"]
    texts = run("t", *near, raw["mo_codes"], "--mo-format", "text")
    assert {(r[0], r[2]) for r in texts} == {("CENTRAL", 1), ("HARBOR", 1)}
    assert run("c", *near, str(tmp_path / "codes.csv")) == texts


def test_failed_source_fails_the_job(spark, tmp_path):
    with pytest.raises(SystemExit):
        job.main(["prepare", "--out", str(tmp_path / "o"), "--raw", "mo_codes=/no/such/file"], spark)


def test_absent_income_column_is_an_error(spark):
    census = spark.createDataFrame([(90001, 3.0)], "zip_code int, average_household_size double")
    with pytest.raises(ValueError, match="Income"):
        city.income_per_person(spark.createDataFrame([(90001, "x")], "`Zip Code` int, money string"), census)


class _Builder:
    def __init__(self):
        self.seen = {}

    def appName(self, _):
        return self

    def master(self, m):
        self.seen["master"] = m
        return self

    def config(self, k, v):
        self.seen[k] = v
        return self

    def getOrCreate(self):
        return self

    class sparkContext:
        setLogLevel = staticmethod(lambda _: None)


def test_submitted_master_and_partitions_are_left_alone(monkeypatch):
    class Session:
        builder = _Builder()
    monkeypatch.setattr(session, "SparkSession", Session)
    seen = session.build_session().seen
    assert "master" not in seen and "spark.sql.shuffle.partitions" not in seen and "spark.checkpoint.dir" not in seen
    seen = session.build_session("local[2]", shuffle_partitions=3, checkpoint_dir="/x").seen
    assert (seen["master"], seen["spark.sql.shuffle.partitions"], seen["spark.checkpoint.dir"]) == ("local[2]", "3", "/x")


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_cluster_without_shared_folder_is_an_error(master):
    class Context:
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}
    Context.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
