"""``${name}`` attribute templates resolved against a map column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_REF = re.compile(r"\$\{([^}]*)\}")


def template_parts(template: str) -> list[tuple[str, str]]:
    """Split a template once on the driver into ("lit", text) / ("attr", name) parts."""
    parts: list[tuple[str, str]] = []
    pos = 0
    for m in _REF.finditer(template):
        if m.start() > pos:
            parts.append(("lit", template[pos:m.start()]))
        parts.append(("attr", m.group(1).strip()))
        pos = m.end()
    if pos < len(template):
        parts.append(("lit", template[pos:]))
    return parts


def resolve_template(template: str | None, attributes: Column | str = "attributes") -> Column:
    """Fill each ``${name}`` from the row's attribute map; a missing name gives ``''``.

    The template is a constant of the job (like a processor property), so it
    is parsed once and becomes a plain ``concat`` — no per-row Python.
    """
    if template is None:
        return F.lit(None).cast("string")
    attrs = F.col(attributes) if isinstance(attributes, str) else attributes
    cols = []
    for kind, text in template_parts(template):
        if kind == "lit":
            cols.append(F.lit(text))
        else:
            cols.append(F.coalesce(attrs.getItem(text), F.lit("")))
    if not cols:
        return F.lit("")
    return F.concat(*cols)
