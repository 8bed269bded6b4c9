"""Small landing documents of every data set."""

import json
import os

STAMP = 1714521600000       # 2024-05-01 00:00:00 UTC


def region(**extra):
    row = {
        "updated": STAMP, "cases": 1000, "todayCases": 5, "deaths": 20, "todayDeaths": 1, "recovered": 900,
        "todayRecovered": 3, "active": 80, "critical": 2, "casesPerOneMillion": 100.5, "deathsPerOneMillion": 2.0,
        "tests": 5000, "testsPerOneMillion": 500.25, "population": 10000000, "oneCasePerPeople": 10,
        "oneDeathPerPeople": 500, "oneTestPerPeople": 2, "activePerOneMillion": 8.0, "recoveredPerOneMillion": 90.0,
        "criticalPerOneMillion": 0.2}
    row.update(extra)
    return row


def country(name, number, **extra):
    return region(country=name, continent="Asia", countryInfo={
        "_id": number, "iso2": "XX", "iso3": "XXX", "lat": 1.5, "long": 2.5, "flag": "f.png"}, **extra)


DOCUMENTS = {
    "global": region(affectedCountries=231),
    "countries": [country("US", 1), country("peru ", 2, cases=0, deaths=0), country("US", 1, cases=2000),
                  country("Iran", 3, population=None, criticalPerOneMillion=None, cases=-4)],
    "continents": [region(continent=c, continentInfo={"lat": 1.0, "long": 2.0}, countries=["A", "B"])
                   for c in ("Asia", "Asia", "Europe")],
    "states": [{"state": s, "updated": STAMP, "cases": 10, "deaths": 1, "recovered": 2, "casesPerOneMillion": 3,
                "deathsPerOneMillion": 4, "population": p} for s, p in (("Ohio", 100), ("Guam", 0))],
    "vaccines": [{"country": "Peru", "timeline": {"4/29/24": 5, "4/30/24": 7}}],
    "historical": {
        "cases": {"4/27/24": 10, "4/28/24": 20, "4/30/24": 40}, "deaths": {"4/28/24": 1, "4/30/24": 1}},
}
COUNTRY_HISTORY = {
    "a": {"country": "Peru", "timeline": {"cases": {"4/29/24": 1, "4/30/24": 3}, "deaths": {"4/30/24": 1}}},
    "b": [{"country": "Chile", "timeline": {"cases": {"4/30/24": 9}}}],
}


def write(folder):
    for name, document in DOCUMENTS.items():
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/{name}_20240501.json", "w") as out:
            json.dump(document, out)
    os.makedirs(f"{folder}/country_historical")
    for name, document in COUNTRY_HISTORY.items():
        with open(f"{folder}/country_historical/{name}.json", "w") as out:
            json.dump(document, out)
    with open(f"{folder}/country_historical/broken.json", "w") as out:
        out.write('{"country": "Nowhere", "timeline": ')
    return folder
