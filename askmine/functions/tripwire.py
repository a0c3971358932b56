"""The last check for personal data before a text is embedded: shapes of high precision."""

from __future__ import annotations

import re

from pyspark.sql import Column

#: The shapes, for Python and Java alike.
SHAPES = {
    "PHONE_NUMBER": r"(?<!\d)(?:\+?1[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]\d{4}(?!\d)",
    "EMAIL_ADDRESS": r"[\w.+-]+@(?![0-9A-Fa-f]{8}\.[0-9A-Fa-f]{8}\b)[\w-]+(?:\.[\w-]+)+",
    "URL": r"(?i)\bhttps?://\S+|\bwww\.\S+",
    "SOCIAL_HANDLE": r"(?<![\w@.<])@[A-Za-z][A-Za-z0-9_.]{1,29}",
}
_COMPILED = {entity: re.compile(shape) for entity, shape in SHAPES.items()}


def fires(text: Column, entity: str) -> Column:
    """Whether a shape occurs; native, with Unicode classes."""
    return text.rlike("(?U)" + SHAPES[entity])


def fires_any(text: Column) -> Column:
    found = None
    for entity in SHAPES:
        found = fires(text, entity) if found is None else found | fires(text, entity)
    return found


def hits(text: str | None) -> list[tuple[str, int, int]]:
    """(entity, start, end) in code points, by entity and then by place; never what was found."""
    return [(entity, m.start(), m.end()) for entity, shape in _COMPILED.items() for m in shape.finditer(text or "")]
