"""Explicit schemas: landed pages, title records, staging rows, published tables.

Nothing is inferred from data. Inference costs an extra pass, and a column that is
absent or all null in one year range would change type or vanish.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


STRING, INT, BIGINT = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOLEAN = T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


GENRES = T.ArrayType(_struct(id=STRING, translation=STRING))
OFFERS = T.ArrayType(
    _struct(
        id=STRING,
        standardWebURL=STRING,
        package=_struct(packageId=INT, clearName=STRING, slug=STRING, icon=STRING),
    )
)

# One title as the catalogue API returns it.
NODE = _struct(
    id=STRING,
    objectType=STRING,
    content=_struct(
        title=STRING,
        shortDescription=STRING,
        originalReleaseYear=INT,
        ageCertification=STRING,
        runtime=BIGINT,
        fullPath=STRING,
        productionCountries=T.ArrayType(STRING),
        genres=GENRES,
        scoring=_struct(
            imdbScore=DOUBLE, imdbVotes=DOUBLE, tmdbPopularity=DOUBLE, tmdbScore=DOUBLE
        ),
    ),
    offers=OFFERS,
    totalSeasonCount=DOUBLE,
)


def _page(edge: T.StructType) -> T.StructType:
    return _struct(
        page_no=INT,
        cursor_sent=STRING,
        status=INT,
        data=_struct(
            popularTitles=_struct(
                totalCount=BIGINT,
                pageInfo=_struct(endCursor=STRING, hasNextPage=BOOLEAN),
                edges=T.ArrayType(edge),
            )
        ),
        errors=T.ArrayType(
            _struct(
                message=STRING,
                locations=T.ArrayType(_struct(line=INT, column=INT)),
                extensions=T.MapType(STRING, STRING),
            )
        ),
    )


# One landed response: an envelope written by the crawler around the response body.
# The requested year range comes from the directory names min=<year>/max=<year>.
PAGE = _page(_struct(cursor=STRING, node=NODE))
# The same without the titles: JSON sources prune no nested fields by themselves, so a
# reader that only counts edges has to ask for less.
PAGE_OUTLINE = _page(_struct(cursor=STRING))
PAGE_RANGE = _struct(min=INT, max=INT)

# A title flattened with "_", arrays left whole.
STAGING = _struct(
    id=STRING,
    objectType=STRING,
    content_title=STRING,
    content_shortDescription=STRING,
    content_originalReleaseYear=INT,
    content_ageCertification=STRING,
    content_runtime=BIGINT,
    content_fullPath=STRING,
    content_productionCountries=T.ArrayType(STRING),
    content_genres=GENRES,
    content_scoring_imdbScore=DOUBLE,
    content_scoring_imdbVotes=DOUBLE,
    content_scoring_tmdbPopularity=DOUBLE,
    content_scoring_tmdbScore=DOUBLE,
    offers=OFFERS,
    totalSeasonCount=DOUBLE,
)
STAGING_RANGE = _struct(year_min=INT, year_max=INT)

SERVICE_SELECTION = _struct(code=STRING, clear_name=STRING)
SERVICE_CATALOGUE = _struct(code=STRING, streaming_name=STRING, lcase_name=STRING)


@dataclass(frozen=True)
class TableContract:
    """A published table: catalogue name, folder below the root, exact columns."""

    name: str
    folder: str
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the contract columns in order, cast to the contract types.

        Under ANSI mode a value that does not fit raises instead of turning null.
        """
        return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])


# Names, folders and columns of the published tables.
# The misspelt names age_dertification, tmdb_popolarity and tmbd_score are part of the
# published contract.
FCT_TITLES = TableContract(
    "fct_titles",
    "titles",
    _struct(
        title_id=STRING,
        object_type=STRING,
        title=STRING,
        short_description=STRING,
        release_year=T.ShortType(),
        age_dertification=STRING,
        runtime=BIGINT,
        full_path=STRING,
        imdb_score=DOUBLE,
        imdb_votes=DOUBLE,
        tmdb_popolarity=DOUBLE,
        tmbd_score=DOUBLE,
        season_count=DOUBLE,
    ),
)
DIM_GENRES = TableContract("dim_genres", "genres", _struct(genre_id=STRING, name=STRING))
DIM_STREAMING_SERVICES = TableContract(
    "dim_streaming_services",
    "streaming_services",
    _struct(streaming_service_id=INT, clear_name=STRING, slug=STRING, icon=STRING),
)
DIM_TITLES_GENRES = TableContract(
    "dim_titles_genres", "titles_genres", _struct(title_id=STRING, genre_id=STRING)
)
DIM_TITLES_PRODUCTION_COUNTRIES = TableContract(
    "dim_titles_production_countries",
    "titles_production_countries",
    _struct(title_id=STRING, country_code=STRING),
)
DIM_TITLES_STREAMING_SERVICES = TableContract(
    "dim_titles_streaming_services",
    "titles_streaming_services",
    _struct(
        title_streaming_service_id=STRING,
        standard_web_url=STRING,
        title_id=STRING,
        streaming_service_id=INT,
    ),
)
TITLE_TABLES = (
    FCT_TITLES,
    DIM_GENRES,
    DIM_STREAMING_SERVICES,
    DIM_TITLES_GENRES,
    DIM_TITLES_PRODUCTION_COUNTRIES,
    DIM_TITLES_STREAMING_SERVICES,
)

_NAME = T.VarcharType(256)
DIM_COUNTRIES = TableContract(
    "dim_countries",
    "countries",
    _struct(name=_NAME, alpha2_code=_NAME, alpha3_code=_NAME, flag=_NAME),
)
