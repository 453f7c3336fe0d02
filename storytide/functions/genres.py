"""Genre tags from semicolon-separated shelf and subject strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shelf too generic to be a tag, and the subject keywords with the
# tag they give, first match wins.
GENERIC_SHELF = "browsing: fiction"
SUBJECT_TAGS = (
    (("horror",), "horror"),
    (("fantasy",), "fantasy"),
    (("romance",), "romance"),
    (("mystery", "detective"), "mystery"),
    (("adventure",), "adventure"),
    (("children", "juvenile"), "children's literature"),
    (("historical",), "historical fiction"),
)


def _parts(text: str) -> str:
    pieces = f"split(lower(coalesce({text}, '')), ';')"
    return f"transform({pieces}, p -> regexp_replace(p, r'^\\s+|\\s+$', ''))"


def _subject_tag(subject: str) -> str:
    # A kind of fiction names itself; bare "fiction" says nothing.
    arms = [f"WHEN contains({subject}, 'fiction') AND {subject} <> 'fiction' THEN {subject}"]
    for keywords, tag in SUBJECT_TAGS:
        found = " OR ".join(f"contains({subject}, '{k}')" for k in keywords)
        arms.append(f'WHEN {found} THEN "{tag}"')
    return f"CASE {' '.join(arms)} END"


def genre_tags(bookshelves: str = "bookshelves", subjects: str = "subjects") -> Column:
    """Distinct tags of a book as an array; empty when nothing is known."""
    shelves = f"filter({_parts(bookshelves)}, s -> s <> '' AND s <> '{GENERIC_SHELF}')"
    topics = f"filter(transform({_parts(subjects)}, s -> {_subject_tag('s')}), t -> t IS NOT NULL)"
    return F.expr(f"array_union({shelves}, {topics})")


def jaccard(left: str, right: str) -> Column:
    """Shared over combined tags; 0 when either side has none."""
    shared, combined = f"size(array_intersect({left}, {right}))", f"size(array_union({left}, {right}))"
    return F.expr(f"CASE WHEN {shared} > 0 THEN {shared} / {combined} ELSE 0D END")
