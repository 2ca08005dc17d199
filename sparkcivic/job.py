"""The city analyses as one job to submit:

    spark-submit --py-files sparkcivic.zip sparkcivic/job.py prepare --raw crime_2010_2019=/raw/c1.csv \
        --raw mo_codes=/raw/mo.txt --out /prepared
    spark-submit ... sparkcivic/job.py age-bands --crime /prepared/crime_2010_2019 /prepared/crime_2020_present --out /out
    spark-submit ... sparkcivic/job.py top-areas --crime ... --variant sql --out /out
    spark-submit ... sparkcivic/job.py income --income ... --census ... --mode bounded --out /out
    spark-submit ... sparkcivic/job.py nearest-station --crime ... --mo-codes ... --stations ... --out /out

Master, resources and ``spark.checkpoint.dir`` come from the submission.
Inputs are Parquet, or CSV with ``--format csv``, in which no type is guessed:
crime extracts have a declared schema, and the cells of the small tables stay
texts that the analyses convert (a ZIP keeps its zeros). ``--mo-codes`` may
also be the raw list of codes (``--mo-format text``). The result is written as
CSV or Parquet (``--write``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from sparkcivic.operators import sample_by_key
from sparkcivic.plans import city
from sparkcivic.session import build_session, scratch_scope
from sparkcivic.sources import read_csv, read_parquet, read_text, write_csv, write_parquet


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkcivic.job")
    p.add_argument("question", choices=["prepare", "age-bands", "top-areas", "income", "nearest-station"])
    p.add_argument("--out", required=True)
    p.add_argument("--raw", action="append", default=[], metavar="NAME=PATH")
    for name in ("income", "census", "mo-codes", "stations"):
        p.add_argument(f"--{name}")
    p.add_argument("--crime", nargs="+", default=[])
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--mo-format", choices=["parquet", "csv", "text"], help="of --mo-codes; as --format if not given")
    p.add_argument("--write", choices=["csv", "parquet"], default="csv")
    p.add_argument("--how", choices=["native", "udf"], default="native")
    p.add_argument("--variant", choices=["dataframe", "sql", "rdd"], default="dataframe")
    p.add_argument("--mode", choices=["positive", "none", "bounded"], default="positive")
    p.add_argument("--sample", type=float, help="share of the incidents to look at")
    return p


def _table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return read_parquet(spark, path) if fmt == "parquet" else read_csv(spark, path)


def _codes(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "text":
        return city.mo_codes(read_text(spark, path))
    return read_csv(spark, path, schema=city.CODES) if fmt == "csv" else read_parquet(spark, path)


def answer(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.question == "income":
        return city.income_per_person(_table(spark, a.income, a.format), _table(spark, a.census, a.format), a.mode)
    crime = sample_by_key(city.read_crime(spark, a.crime, a.format), city.DR_NO, a.sample)
    if a.question == "age-bands":
        return city.age_bands(crime, a.how)
    if a.question == "top-areas":
        return city.top_areas(crime, a.variant)
    return city.nearest_station(crime, _codes(spark, a.mo_codes, a.mo_format or a.format), _table(spark, a.stations, a.format))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(argv)
    own = spark is None
    spark = spark or build_session()
    try:
        with scratch_scope(spark):
            if a.question == "prepare":
                result = city.prepare(spark, dict(x.split("=", 1) for x in a.raw), a.out)
                result.show(truncate=False)  # one row per source
                failed = result.where("not ok").count()
                if failed:
                    raise SystemExit(f"{failed} sources failed")
                return
            (write_csv if a.write == "csv" else write_parquet)(answer(spark, a), a.out)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main()
