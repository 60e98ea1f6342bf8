import math

import pytest

from marquee.plans import normalize
from marquee.plans.normalize import JOBS
from marquee.schemas import TITLE_TABLES
from rows import bag, genre, node, offer, staging


def test_job_schemas_match_contracts(spark):
    df = staging(spark, node("a"))
    for contract, job in JOBS:
        out = job(df)
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in contract.schema
        ]
    assert [c for c, _ in JOBS] == list(TITLE_TABLES)


@pytest.mark.parametrize("empty", [None, []])
def test_titles_without_arrays_stay_facts_only(spark, empty):
    df = staging(spark, node("a", genres=empty, countries=empty, offers=empty))
    assert normalize.titles(df).count() == 1
    for _, job in JOBS[1:]:
        assert job(df).count() == 0


def test_null_elements_give_null_rows(spark):
    df = staging(spark, node("a", genres=[None], countries=[None, "US"], offers=[None]))
    assert bag(normalize.genres(df)) == [(None, None)]
    assert bag(normalize.titles_genres(df)) == [("a", None)]
    assert bag(normalize.titles_production_countries(df)) == [("a", "US"), ("a", None)]
    assert bag(normalize.streaming_services(df)) == [(None, None, None, None)]
    assert bag(normalize.titles_streaming_services(df)) == [(None, None, "a", None)]


def test_distinct_is_over_full_rows(spark):
    df = staging(
        spark,
        node("a", genres=[genre("d", "Drama"), genre("d", "Drama"), genre("d", "Drame")],
             countries=["US", "US"], offers=[offer("o", "Hulu"), offer("o", "Hulu")]),
        node("a", genres=[genre("d", "Drama")], countries=["US"], offers=[offer("o", "Max", 2)]),
    )
    assert bag(normalize.genres(df)) == [("d", "Drama"), ("d", "Drame")]
    assert bag(normalize.titles_genres(df)) == [("a", "d")]
    assert bag(normalize.titles_production_countries(df)) == [("a", "US")]
    assert normalize.titles_streaming_services(df).count() == 2
    assert normalize.streaming_services(df).count() == 2
    assert normalize.titles(df).count() == 1


def test_missing_numbers_become_zero_before_distinct(spark):
    def scoring(score):
        return {"imdbScore": score, "imdbVotes": None, "tmdbPopularity": math.nan, "tmdbScore": 1.0}

    df = staging(
        spark,
        node("a", scoring=scoring(None), year=None, runtime=None, text=None),
        node("a", scoring=scoring(0.0), year=0, runtime=0, text=None),
        node("a", scoring=scoring(math.nan), year=0, runtime=None, text=None),
    )
    (row,) = normalize.titles(df).collect()
    assert row.asDict() == {
        "title_id": "a", "object_type": "MOVIE", "title": "T a", "short_description": None,
        "release_year": 0, "age_dertification": None, "runtime": 0, "full_path": "/a",
        "imdb_score": 0.0, "imdb_votes": 0.0, "tmdb_popolarity": 0.0, "tmbd_score": 1.0,
        "season_count": 0.0,
    }


def test_year_that_does_not_fit_raises(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        normalize.titles(staging(spark, node("a", year=40000))).collect()


def test_null_scoring_struct(spark):
    (row,) = normalize.titles(staging(spark, node("a", scoring=None))).collect()
    assert (row.imdb_score, row.imdb_votes, row.tmdb_popolarity, row.tmbd_score) == (0, 0, 0, 0)


def test_arrays_spread_over_records_give_the_same_tables(spark):
    offers = [offer(f"o{i}", f"S{i % 3}", i % 3) for i in range(9)]
    whole = staging(spark, node("a", offers=offers))
    split = staging(spark, *[node("a", offers=offers[i::4]) for i in range(4)])
    for _, job in JOBS:
        assert bag(job(whole)) == bag(job(split))


def test_rows_that_can_not_repeat(spark):
    twice = [offer("1", "S", 1), offer("1", "S", 1)]
    alike = [offer("1", "S", 1), offer("1", "T", 2), None]
    drama = [genre("d"), genre("d", "Drame"), None, None]
    plain = staging(spark, node("a", offers=alike, genres=drama, countries=["US", "US", None]), node(None, offers=None))
    found = normalize.without_repeats(plain)
    assert found == list(normalize.OF_TITLES)
    offers_twice = staging(spark, node("a", offers=twice, genres=drama), node("b", offers=None))
    assert normalize.without_repeats(offers_twice) == [j for j in found if j is not normalize.titles_streaming_services]
    for several in (("a", "b", "a"), (None, None)):
        assert normalize.without_repeats(staging(spark, *[node(i) for i in several])) == []
    assert normalize.without_repeats(plain.where("false")) == found
    for df in (plain, offers_twice):
        for job in normalize.without_repeats(df):
            assert bag(job(df, once=True)) == bag(job(df))
