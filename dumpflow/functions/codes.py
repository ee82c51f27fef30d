"""Lookups from dump words to stored codes and categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dumpflow import fixed_values as fx
from dumpflow.functions.text import first_match, url_netloc


def _code_of(word: Column, codes: dict[str, int]) -> Column:
    out = F.lit(fx.UNKNOWN_CODE)
    for name, code in codes.items():
        out = F.when(word == name, F.lit(code)).otherwise(out)
    return out


def access_code(access_type: Column) -> Column:
    return _code_of(F.lower(access_type), fx.ACCESS_CODES)


def agent_name(file_name: Column) -> Column:
    """Agent group that a pageview file covers, told by its name."""
    name = F.lower(file_name)
    return (
        F.when(name.contains("-user"), "user")
        .when(name.contains("-spider"), "spider")
        .when(name.contains("-automated") | name.contains("-bot"), "automated")
        .otherwise("all")
    )


def agent_code(file_name: Column) -> Column:
    return _code_of(agent_name(file_name), fx.AGENT_CODES)


def navigation_type(raw_type: Column) -> Column:
    return F.when(raw_type.isin(*fx.NAVIGATION_TYPES), raw_type).otherwise("other")


def referer_category(nav_type: Column, source: Column, strict: bool = False) -> Column:
    """Where a click came from.

    External sources are judged by host. Dumps also write ready-made groups such
    as `other-google`; these are kept unless `strict` is set.
    """
    by_host = first_match(url_netloc(source), fx.REFERER_HOSTS, fx.REFERER_OTHER)
    external = by_host if strict else F.when(source.startswith("other-"), source).otherwise(by_host)
    return (
        F.when(nav_type == "link", F.lit(fx.REFERER_ARTICLE))
        .when(nav_type == "external", external)
        .otherwise(F.lit(fx.REFERER_EMPTY))
    )
