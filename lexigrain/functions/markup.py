"""Feature extraction from markup text by whitelisted patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col

# Patterns of the stroke-order markup format and of unsafe content.
PATH = r'<path\b[^>]*\bd="([^"]+)"[^>]*>'
ELEMENT = r'kvg:element="([^"]+)"'
MARKER = r'kvg:phon="([^"]+)"'
STROKE_LABEL = (
    r'<text transform="matrix\(1 0 0 1 (-?[0-9]+(?:\.[0-9]+)?) '
    r'(-?[0-9]+(?:\.[0-9]+)?)\)">([1-9][0-9]*)</text>'
)
UNSAFE = {
    "script": r"(?i)<script",
    "namespace": r"kvg:",
    "xlink": r"(?i)xlink",
    "handler": r"(?i)\son\w+=",
    "image": r"(?i)<image",
    "doctype": r"(?i)<!doctype",
}


def _all(c, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(as_col(c), F.lit(pattern), F.lit(group))


def stroke_count(svg, path: str = PATH) -> Column:
    """Number of stroke paths, NULL when there is none."""
    n = F.regexp_count(as_col(svg), F.lit(path))
    return F.when(n > 0, n)


def components(svg, key, element: str = ELEMENT, path: str = PATH) -> Column:
    """Distinct element names in order; the key comes first when it is not among them.

    NULL without a stroke path: such a markup has no features at all.
    """
    names = F.array_distinct(_all(svg, element, 1))
    key = as_col(key)
    named = F.when(F.array_contains(names, key), names).otherwise(F.concat(F.array(key), names))
    return F.when(stroke_count(svg, path).isNotNull(), named)


def first_marker(svg, key, marker: str = MARKER) -> Column:
    """The first marker that is neither empty nor the key itself."""
    key = as_col(key)
    return F.get(F.filter(_all(svg, marker, 1), lambda m: (m != "") & (m != key)), 0)


def strokes(svg, path: str = PATH) -> Column:
    return _all(svg, path, 1)


def stroke_labels(svg, label: str = STROKE_LABEL) -> Column:
    """Numeric labels in the strict form, as (x, y, n)."""
    return F.arrays_zip(
        _all(svg, label, 1).alias("x"), _all(svg, label, 2).alias("y"), _all(svg, label, 3).alias("n")
    )


def rebuilt(svg, path: str = PATH, label: str = STROKE_LABEL) -> Column:
    """Markup made of nothing but the whitelisted parts."""
    lines = F.transform(strokes(svg, path), lambda d: F.concat(F.lit('<path d="'), d, F.lit('"/>')))
    numbers = F.transform(
        stroke_labels(svg, label),
        lambda t: F.concat(
            F.lit('<text x="'), t["x"], F.lit('" y="'), t["y"], F.lit('">'), t["n"], F.lit("</text>")
        ),
    )
    return F.concat(
        F.lit('<svg xmlns="http://www.w3.org/2000/svg">'),
        F.array_join(lines, ""), F.array_join(numbers, ""), F.lit("</svg>"),
    )


def unsafe_hits(text, patterns: dict[str, str] = UNSAFE) -> Column:
    """Names of the unsafe patterns found in the text."""
    text = as_col(text)
    tests = [F.when(text.rlike(p), F.lit(name)) for name, p in patterns.items()]
    return F.filter(F.array(*tests), lambda hit: hit.isNotNull())


def references(text, pattern: str) -> Column:
    """Every referenced name, each once."""
    return F.array_distinct(_all(text, pattern, 1))
