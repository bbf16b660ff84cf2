"""Declared schemas of the tables the engine reads and writes, as DDL strings."""

TITLES = (
    "headline string, source_url string, date string, source string, year int, month int, day int"
)

WEB_TITLES = (
    "gkg_date timestamp, source_url string, source_name string, headline string, year int, month int"
)

INVENTORY = (
    "source_url string, wayback_timestamp string, date string, headline_from_slug string, "
    "year int, month int, day int"
)

# The feed's columns in file order; the type of timestamp_utc varies (micro- or nanoseconds).
FEED_COLUMNS = [
    "timestamp_utc", "rp_story_id", "rp_entity_id", "entity_type", "entity_name", "country_code",
    "relevance", "event_sentiment_score", "event_relevance", "event_similarity_key",
    "event_similarity_days", "topic", "rp_group", "rp_type", "sub_type", "property", "fact_level",
    "category", "news_type", "rp_source_id", "source_name", "provider_id", "provider_story_id",
    "headline", "css",
]

NEWSWIRE_CROSSWALK = (
    "date date, nw_source_url string, nw_headline string, nw_source string, rp_story_id string, "
    "rp_entity_id string, rp_entity_name string, rp_headline string, rp_source_name string, "
    "fuzzy_score double"
)

WEB_CROSSWALK = (
    "date date, gdelt_source_url string, gdelt_headline string, gdelt_source_name string, "
    "rp_story_id string, rp_entity_id string, rp_entity_name string, rp_headline string, "
    "rp_source_name string, fuzzy_score double"
)

CONSTITUENTS = (
    "permno bigint, indno bigint, mbrstartdt date, mbrenddt date, mbrflg string, indfam bigint, "
    "comnam string, ticker string, ncusip string, namedt date, nameenddt date, siccd bigint, "
    "exchcd bigint"
)

NAMES_LOOKUP = "permno bigint, comnam string, ticker string, comnam_norm string"

LEDGER = "source string, day date, row_count bigint, schema_version int, input_version string, done_at timestamp"
