"""All registered queries; importing the modules registers them."""

from checks import ingest, matching, panel, reporting  # noqa: F401

FLAGSHIP = "fuzzy_match_newswire"
