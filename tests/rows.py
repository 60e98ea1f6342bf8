"""Hand-made titles, staging rows and pages."""

from marquee.operators.flatten import flatten
from marquee.schemas import NODE, PAGE, PAGE_RANGE, STAGING
from pyspark.sql import types as T


def genre(id, translation=None):
    return {"id": id, "translation": translation or id}


def offer(id, service, package_id=1, url="/u"):
    package = {"packageId": package_id, "clearName": service, "slug": service, "icon": "/i"}
    return {"id": id, "standardWebURL": url, "package": package}


def node(id, year=2000, popularity=1.0, kind="MOVIE", **more):
    content = {
        "title": f"T {id}",
        "shortDescription": more.get("text", "text"),
        "originalReleaseYear": year,
        "ageCertification": more.get("cert"),
        "runtime": more.get("runtime", 90),
        "fullPath": f"/{id}",
        "productionCountries": more.get("countries", ["US"]),
        "genres": more.get("genres", [genre("drm")]),
        "scoring": more.get(
            "scoring",
            {"imdbScore": 5.0, "imdbVotes": 10.0, "tmdbPopularity": popularity, "tmdbScore": 6.0},
        ),
    }
    return {
        "id": id,
        "objectType": kind,
        "content": content,
        "offers": more.get("offers", [offer(f"o-{id}", "Hulu")]),
        "totalSeasonCount": more.get("seasons"),
    }


def nodes(spark, *records):
    return spark.createDataFrame(list(records), NODE)


def staging(spark, *records):
    df = flatten(nodes(spark, *records))
    assert df.columns == STAGING.names
    return df


def page(page_no, records, sent=None, end=None, more=False, total=None, low=1991, high=2000,
         status=200, errors=None):
    data = {
        "popularTitles": {
            "totalCount": len(records) if total is None else total,
            "pageInfo": {"endCursor": end, "hasNextPage": more},
            "edges": [{"cursor": r["id"], "node": r} for r in records],
        }
    }
    return {
        "page_no": page_no, "cursor_sent": sent, "status": status,
        "data": data if status == 200 else None, "errors": errors, "min": low, "max": high,
    }


def error(message, code="E1", line=3, column=4):
    return {
        "message": message,
        "locations": [{"line": line, "column": column}],
        "extensions": {"code": code},
    }


def pages(spark, *records):
    return spark.createDataFrame(
        list(records), T.StructType([*PAGE.fields, *PAGE_RANGE.fields])
    )


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())
