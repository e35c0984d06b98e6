"""Influenza type, subtype and reporting category, from test names and free text.

All patterns and tables are in ``codes``; an expression here is one ordered, first-match
``when`` chain evaluated in the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.functions import codes
from surveil.functions.nulls import is_true
from surveil.functions.text import matches, matches_any

FLU_TYPES = ("Flu A", "Flu B")


def _single_target(kind: str) -> Column:
    """A test for this type alone, or a comment that names the type."""
    alone = matches("test", codes.SINGLE_TARGET[kind], ci=True) & ~matches("test", codes.SINGLE_TARGET_EXCLUDES)
    return alone | matches("comments", codes.TYPE_IN_COMMENTS[kind], ci=True)


def _combined_panel(kind: str, panel: str) -> Column:
    """A combined panel whose result names the type, or result text or the local
    description of any test that names it."""
    by_result = matches("test", panel) & matches("result", codes.PANEL_RESULT[kind])
    by_text = matches("result_value", codes.PANEL_VALUE[kind], ci=True) | matches(
        "local_description", codes.PANEL_DESCRIPTION[kind], ci=True
    )
    return by_result | by_text


def flu_type(as_written: bool = True) -> Column:
    """Flu A, Flu B or Unknown. ``as_written=False`` reads "and" in a panel name as a word."""
    panel = codes.PANEL_AS_WRITTEN if as_written else codes.PANEL_INTENDED
    label = F
    for kind in FLU_TYPES:
        label = label.when(_single_target(kind), kind)
    for kind in FLU_TYPES:
        label = label.when(_combined_panel(kind, panel), kind)
    return label.otherwise("Unknown")


def flu_subtype() -> Column:
    label = F
    for name, pattern, cols in codes.SUBTYPES:
        label = label.when(matches_any(cols, pattern), name)
    texts = ("result", "result_value", "local_description")
    # The exclusion of invalid results belongs to the description alone, as in the rule text.
    unable = matches_any(texts[:2], "Unable", ci=True) | (
        matches(texts[2], "Unable", ci=True) & ~matches_any(texts, "invalid", ci=True)
    )
    return label.when(unable, codes.UNABLE_TO_SUBTYPE)


def report_category(as_written: bool = False, kind="flu_type", subtype="subtype") -> Column:
    """Reporting category of (type, subtype); combinations without one give null.

    A missing subtype is a key of its own. An untypable row counts as Influenza A as
    written; by default only when its own type is Flu A.
    """
    kind, subtype = F.col(kind), F.col(subtype)
    label = F
    for type_, sub, name in codes.CATEGORIES:
        label = label.when((kind == type_) & (subtype.isNull() if sub is None else subtype == sub), name)
    label = label.when(kind == "Coinfection", codes.CATEGORY_COINFECTION).when(kind == "Unknown", "Unknown")
    unable = is_true(subtype == codes.UNABLE_TO_SUBTYPE)
    if not as_written:
        unable = unable & (kind == "Flu A")
    return label.when(unable, codes.CATEGORY_UNABLE)
