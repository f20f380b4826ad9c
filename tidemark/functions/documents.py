"""JSON documents: named value lists as sent by a report client."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLICER = "struct<name:string,type:string,values:array<string>>"


def parse_slicers(text: Column, envelope: str) -> Column:
    """``{"<envelope>": [{name, type, values}, ...]}`` to an array of structs."""
    return F.from_json(text, f"`{envelope}` array<{SLICER}>").getField(envelope)


def slicer_values(slicers: Column, name: str) -> Column:
    """Values of the last slicer with this name, null when there is none."""
    return F.try_element_at(F.filter(slicers, lambda s: s["name"] == name), F.lit(-1))["values"]


def slicer_names(slicers: Column) -> Column:
    return F.transform(slicers, lambda s: s["name"])
