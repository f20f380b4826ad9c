"""Operating system, device, browser and mobile flag of a user agent.

Ordered rules, first match wins, evaluated as one CASE per column inside the scan stage: no worker outside the
JVM and no shuffle, so a popular agent costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern and family, most specific first.
OS_RULES = [
    ("Windows Phone", "Windows Phone"),
    ("Windows", "Windows"),
    ("iPhone|iPad|iPod", "iOS"),
    ("Android", "Android"),
    ("CrOS", "Chrome OS"),
    ("Mac OS X|Macintosh", "Mac OS X"),
    ("Ubuntu", "Ubuntu"),
    ("Linux", "Linux"),
]
DEVICE_RULES = [
    ("iPhone", "iPhone"),
    ("iPad", "iPad"),
    ("iPod", "iPod"),
    ("Windows Phone", "Generic Smartphone"),
    ("SM-|SAMSUNG|Samsung", "Samsung"),
    ("Pixel", "Pixel"),
    ("Android.*Mobile", "Generic Smartphone"),
    ("Android", "Generic Tablet"),
    ("Macintosh", "Mac"),
]
BROWSER_RULES = [
    ("Edg(e|A|iOS)?/", "Edge"),
    ("OPR/|Opera", "Opera"),
    ("SamsungBrowser/", "Samsung Internet"),
    ("FxiOS/", "Firefox iOS"),
    ("Firefox/.*Mobile|Mobile.*Firefox/", "Firefox Mobile"),
    ("Firefox/", "Firefox"),
    ("CriOS/", "Chrome Mobile iOS"),
    ("Chrome/.*Mobile", "Chrome Mobile"),
    ("Chrome/", "Chrome"),
    ("MSIE |Trident/", "IE"),
    ("(iPhone|iPad|iPod).*Safari/", "Mobile Safari"),
    ("Safari/", "Safari"),
]
MOBILE_PATTERN = "iPhone|iPod|Windows Phone|Android.*Mobile|Mobile.*Firefox/"
OTHER = "Other"


def _first_match(agent: Column, rules: list[tuple[str, str]]) -> Column:
    # logs write a blank inside the agent as "+"
    readable = F.replace(agent, F.lit("+"), F.lit(" "))
    family = F.when(agent.isNull(), "")
    for pattern, name in rules:
        family = family.when(readable.rlike(pattern), name)
    return family.otherwise(OTHER)


def agent_os(agent: Column) -> Column:
    return _first_match(agent, OS_RULES)


def agent_device(agent: Column) -> Column:
    return _first_match(agent, DEVICE_RULES)


def agent_browser(agent: Column) -> Column:
    return _first_match(agent, BROWSER_RULES)


def agent_is_mobile(agent: Column) -> Column:
    readable = F.replace(agent, F.lit("+"), F.lit(" "))
    return F.coalesce(readable.rlike(MOBILE_PATTERN), F.lit(False))
