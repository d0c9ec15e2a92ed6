"""Public feeds of registries: where a year's file lies, and how landed files become tables."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.operators.relational import each_column, union_by_name
from kinlink.sources.readers import csv_files

# The publishers' folders and file names.
IPEDS_URL = "https://nces.ed.gov/ipeds/datacenter/data/"
TIGER_URL = "https://www2.census.gov/geo/tiger/TIGER{year}/{layer}/"
EDGE_URL = "https://nces.ed.gov/programs/edge/data/"
EDGE_KINDS = {"public": "PUBLICSCH", "private": "PRIVATESCH", "postsecondary": "POSTSECSCH"}


@dataclass(frozen=True)
class Feed:
    url: str
    file: str

    @property
    def base(self) -> str:
        return self.file.removesuffix(".zip")


def ipeds_feed(table: str, year: int, suffix: str = "") -> Feed:
    """Names are in capitals from 2023 on."""
    name = f"{table}{year}{suffix}"
    file = (name.upper() if year > 2022 else name.lower()) + ".zip"
    return Feed(IPEDS_URL + file, file)


def tiger_feed(layer: str, year: int, state: int | str = "us") -> Feed:
    file = f"tl_{year}_{state if isinstance(state, str) else f'{state:02}'}_{layer.lower()}.zip"
    return Feed(TIGER_URL.format(year=year, layer=layer.upper()) + file, file)


def edge_feed(kind: str, year: int) -> Feed:
    """year is that of the autumn term; the file has both years of the school year."""
    if kind.lower() not in EDGE_KINDS:
        raise ValueError(f"no such kind of school: {kind}")
    file = f"EDGE_GEOCODE_{EDGE_KINDS[kind.lower()]}_{year % 100:02}{(year + 1) % 100:02}.zip"
    return Feed(EDGE_URL + file, file)


def state_codes(listing: list[str]) -> list[str]:
    """The two-digit state codes in a folder listing of one file per state."""
    return sorted({m.group(1) for x in listing if (m := re.search(r"tl_\d{4}_(\d{2})_", x))})


def hd_editions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The yearly directory files as one table: columns by name, blanks at the ends of texts removed, edition added."""
    return each_column(csv_files(spark, paths), lambda _, kind: kind == "string", F.trim)


def edge_edition(df: DataFrame, year: int) -> DataFrame:
    """A year's geocodes: M and N (missing, not applicable) in texts made null, edition added."""
    d = each_column(df, lambda _, kind: kind == "string", lambda c: F.when(~c.isin("M", "N"), c))
    return d.withColumn("edition", F.lit(year))


# The headings of the scraped lists, public and private, and the columns they become.
PUBLIC_HEADINGS = {
    "nces": "NCES School ID", "state_school_id": "State School ID", "lea": "NCES District ID", "state_district_id": "State District ID", "low_grade": "Low Grade", "high_grade": "High Grade",
    "nces_name": "School Name", "district": "District", "county_name": "County Name", "address": "Street Address", "city": "City", "state_abbr": "State", "zip": "ZIP", "type": "Type",
}
PRIVATE_HEADINGS = {
    "nces": "PSS_SCHOOL_ID", "nces_name": "PSS_INST", "low_grade": "LoGrade", "high_grade": "HiGrade", "address": "PSS_ADDRESS", "city": "PSS_CITY", "fips": "PSS_COUNTY_NO", "state_abbr": "PSS_STABB",
    "state_fips": "PSS_FIPS", "zip": "PSS_ZIP5", "county_name": "PSS_COUNTY_NAME",
}


def scraped_schools(public: DataFrame, private: DataFrame) -> DataFrame:
    """One table of html_files' rows (cells) of both lists; ids of private schools get four zeros before them."""
    def of(df: DataFrame, headings: dict[str, str], kind: str) -> DataFrame:
        return df.select(*[F.col("cells").getItem(h).alias(c) for c, h in headings.items()], F.lit(kind).alias("public_private"))

    p = of(private, PRIVATE_HEADINGS, "private").withColumn("nces", F.concat(F.lit("0000"), "nces"))
    return union_by_name(of(public, PUBLIC_HEADINGS, "public"), p)


# Columns of the layers' tables and what they are called.
LAYERS = {
    "county": {"state_fips": "statefp", "county_fips": "countyfp", "fips": "geoid", "county_name": "namelsad", "county_name_short": "name", "center_latitude": "intptlat", "center_longitude": "intptlon"},
    "state": {"state_fips": "statefp", "state_abbr": "stusps", "name": "name", "center_latitude": "intptlat", "center_longitude": "intptlon"},
    "school_district": {"state_fips": "statefp", "lea": "unsdlea", "name": "name", "center_latitude": "intptlat", "center_longitude": "intptlon"},
    "zcta": {"zcta": "zcta5ce20", "center_latitude": "intptlat20", "center_longitude": "intptlon20"},
}


def layer_table(df: DataFrame, layer: str) -> DataFrame:
    """A layer's table with plain names, its centre as numbers, edition and geometry."""
    cast = lambda c, src: F.col(src).cast("double") if c.startswith("center_") else F.col(src)
    return df.select(*[cast(c, src).alias(c) for c, src in LAYERS[layer].items()], "edition", "geom")
