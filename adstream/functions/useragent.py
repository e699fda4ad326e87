"""User-agent attributes as native column expressions.

Rules are tried in order and the first match wins. All patterns keep to the
syntax Java and RE2 share.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (name, pattern), version in capture group 1.
BROWSER_RULES = (
    ("Edge", r"Edge/([\d.]+)"),
    ("Firefox", r"Firefox/([\d.]+)"),
    ("Chrome Mobile iOS", r"CriOS/([\d.]+)"),
    ("Chrome Mobile WebView", r"; wv\).*Chrome/([\d.]+)"),
    ("Chrome Mobile", r"Chrome/([\d.]+) Mobile"),
    ("Chrome", r"Chrome/([\d.]+)"),
    ("Android", r"Android.*Version/([\d.]+).*Safari"),
    ("Mobile Safari", r"Version/([\d.]+) Mobile.*Safari"),
    ("Safari", r"Version/([\d.]+).*Safari"),
)
# Fixed values: (name, pattern), version in capture group 1.
OS_RULES = (
    ("iOS", r"iPhone OS ([\d_]+)"),
    ("Android", r"Android ([\d.]+)"),
    ("Chrome OS", r"CrOS \S+ ([\d.]+)"),
    ("Mac OS X", r"Mac OS X ([\d_]*)"),
    ("Windows", r"Windows NT ([\d.]+)"),
    ("Ubuntu", r"Ubuntu()"),
    ("Chromecast", r"CrKey armv7l ([\d.]+)"),
)
# Patterns whose first non-empty capture is the device model.
MODEL_PATTERNS = (
    r"\((iPhone[\d,]*);",
    r"Android [\d.]+; (?:[a-z]{2}-[a-z]{2}; )?(.+?) Build/",
    r"\((Mac)intosh;",
    r"\((CrKey) ",
)
# Fixed values: (brand, pattern on the device model).
BRAND_RULES = (
    ("Apple", r"^(iPhone|Mac)"),
    ("Samsung", r"^SM-"),
    ("Google", r"^(Pixel|CrKey)"),
    ("Sony", r"^SGP"),
    ("Amazon", r"^AFT"),
    ("NVIDIA", r"^SHIELD"),
    ("Generic", r"."),
)

BROWSER_COLUMNS = (
    "Browser",
    "Browser_version",
    "Client_OS",
    "Client_OS_Ver",
    "Client_Device",
    "Client_Device_Brand",
    "Client_Device_Model",
)


def _first_rule(text: Column, rules) -> Column:
    """Position of the first rule that matches, counted from 0; NULL for none."""
    chain = F
    for i, (_, pattern) in enumerate(rules):
        chain = chain.when(text.rlike(pattern), i)
    return chain


def _item(values, position: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), position)


def first_browser(user_agent: Column) -> Column:
    return _first_rule(user_agent, BROWSER_RULES)


def first_os(user_agent: Column) -> Column:
    return _first_rule(user_agent, OS_RULES)


def rule_name(rules, position: Column) -> Column:
    return F.coalesce(_item([name for name, _ in rules], position), F.lit("Other"))


def rule_version(user_agent: Column, rules, position: Column) -> Column:
    """Version by the rule found before.

    The pattern is looked up instead of spelt out per rule: sixteen extractions
    in one projection make generated code too long for the JVM to compile.
    """
    pattern = _item([p for _, p in rules], position)
    found = F.call_function("regexp_extract", user_agent, pattern, F.lit(1))
    version = F.translate(found, "_", ".")
    return F.coalesce(version, F.lit(""))


def device_model(user_agent: Column) -> Column:
    captures = [F.regexp_extract(user_agent, p, 1) for p in MODEL_PATTERNS]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in captures])


def device_brand(model: Column) -> Column:
    return _item([name for name, _ in BRAND_RULES], _first_rule(model, BRAND_RULES))
