"""Declared schemas. Nothing is inferred from data."""

import re

from pyspark.sql import types as T


def struct(spec: str) -> T.StructType:
    """A schema from ``name type`` pairs; ``!`` after the type forbids NULL.

    Unlike Spark's DDL parser this needs no running session.
    """
    schema = T.StructType()
    for column in re.split(r",(?![0-9])", spec):
        name, kind = column.split()
        schema.add(name, kind.rstrip("!"), nullable=not kind.endswith("!"))
    return schema


ITEMS = struct("""
    item_id string!, type string!, title string!,
    description string, release_year integer, date_added date, runtime_minutes integer,
    season_count integer, episode_count integer, content_rating string, country string,
    original_language string, imdb_score decimal(3,1),
    is_netflix_original boolean!, content_warning boolean!,
    genre_primary string, genre_secondary string, catalog_status string!,
    seed_source string, created_at timestamp, updated_at timestamp
""")

USERS = struct("""
    user_id string!, age integer, gender string, occupation string,
    country string, preferred_language string, signup_date date,
    subscription_plan string!, account_status string!,
    email string, first_name string, last_name string, state_province string,
    city string, monthly_spend_hours decimal(6,2), primary_device string,
    seed_source string, created_at timestamp, updated_at timestamp
""")

RATINGS = struct("""
    user_id string!, item_id string!, rating integer!,
    rated_at timestamp!
""")

# Heartbeats and settled watches share one shape.
WATCHES = struct("""
    user_id string!, item_id string!, watched_seconds integer!,
    device_type string!, session_ended_at timestamp!
""")

LOAD_LOG = struct("seed_name string, item_count long, user_count long, loaded_at timestamp")

# Catalogue files. Every field is read as text; the normalisers do the typing.
TITLES_FILE = struct("""
    id string, title string, type string, description string, release_year string,
    age_certification string, runtime string, genres string,
    production_countries string, seasons string, imdb_id string, imdb_score string,
    imdb_votes string, tmdb_popularity string, tmdb_score string
""")

TITLE_LOOKUP_FILE = struct("""
    show_id string, type string, title string, director string, cast string,
    country string, date_added string, release_year string, rating string,
    duration string, listed_in string, description string
""")

MOVIES_FILE = struct("""
    movie_id string, title string, content_type string, genre_primary string,
    genre_secondary string, release_year string, duration_minutes string,
    rating string, language string, country_of_origin string, imdb_rating string,
    production_budget string, box_office_revenue string, number_of_seasons string,
    number_of_episodes string, is_netflix_original string, added_to_platform string,
    content_warning string
""")

USERS_FILE = struct("""
    user_id string, email string, first_name string, last_name string, age string,
    gender string, country string, state_province string, city string,
    subscription_plan string, subscription_start_date string, is_active string,
    monthly_spend_hours string, primary_device string, household_size string,
    created_at string
""")

USERS_DAT = struct("user_ref string, gender string, age string, occupation string, zip string")
