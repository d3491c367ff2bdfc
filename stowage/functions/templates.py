"""Command templates with ``{{ NAME }}`` placeholders."""

import re

from pyspark.sql import Column, functions as F

_PLACEHOLDER = re.compile(r"\{\{\s*(\w+)\s*\}\}")


def render(template: str, values: dict[str, Column]) -> Column:
    """Fill a template from columns in one concatenation; unknown placeholders stay as written."""
    pieces, end = [], 0
    for hit in _PLACEHOLDER.finditer(template):
        if hit.group(1) in values:
            pieces += [F.lit(template[end:hit.start()]),
                       F.coalesce(values[hit.group(1)].cast("string"), F.lit(""))]
            end = hit.end()
    return F.concat(*pieces, F.lit(template[end:]))
