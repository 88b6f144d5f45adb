"""SQL expressions about articles: region, address, record key. Arguments are SQL text."""

from __future__ import annotations

from valuelens.functions.text import case_of, one_of
from valuelens.schemas import BOOST_THRESHOLDS, COUNTRY_REGIONS, EU_COUNTRIES


def region_of(country: str) -> str:
    """One of seven regions; unknown and missing countries are ROW."""
    return (
        f"case when {one_of(country, COUNTRY_REGIONS)} then {country}"
        f" when {one_of(country, EU_COUNTRIES)} then 'EU' else 'ROW' end"
    )


def url_of(protocol: str, host: str, path: str) -> str:
    """The address of a page; NULL if any part is."""
    return f"concat({protocol}, '://', {host}, {path})"


def boost_id(region: str, url: str) -> str:
    # Spark breaks base64 text into lines of 76 characters; keys have none.
    encoded = f"translate(base64(encode({url}, 'UTF-8')), '\\r\\n', '')"
    return f"concat({region}, '_', {encoded})"


def threshold_of(region: str, thresholds: dict[str, float] = BOOST_THRESHOLDS) -> str:
    """Value per view an article of a region must reach; NULL for an unknown region."""
    return case_of(region, {name: f"{float(limit)}d" for name, limit in thresholds.items()})
